"""Small tables for the tests of the training-data operators."""

WORDS = "the of and river stone light winter paper garden silver window letter mountain music thunder copper engine harbor meadow candle".split()


def text(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 + 12345
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(x >> 33) % len(WORDS)] + ("" if (x >> 20) % 3 else str((x >> 40) % 97)))
    return " ".join(out)


def edge_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = text(99, 6000)
    return [
        (1, text(1, 200), "en", "a"), (2, text(2, 90), None, "a"), (3, None, "en", None), (4, "", "de", "b"), (None, text(3, 60), "en", "a"), (None, None, None, None),
        (5, long, "en", "a"), (6, long, "en", "a"), (7, text(1, 200), "en", "b"), (7, text(1, 200), "en", "b"), (8, "  two   words  ", "en", "b"), (9, "x" * 5000, "en", "c"),
        (10, "\n\n \t", "en", "c"), (11, "çé 漢字 😀 ▁ <|endoftext|> end\n", "fr", "c"), (12, "one\ntwo\none\ntwo\n", "fr", "c"),
    ]


SCHEMA = "doc_id long, text string, lang string, source string"


def edge_docs(spark):
    """With extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.selectExpr("*", "'x' as q", "1 as kept", "2 as key", "3 as places", "4 as f", "'y' as row", "5 as doc", "6 as n", "7 as fp")


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
