"""Quality rules with adaptive thresholds. Native: DataFrame functions only.

Every document gets word statistics. For each (lang, source) a mergeable quantile sketch of each metric
is kept: a log-linear histogram whose buckets are exact below 2**SKETCH_BITS and at most 2**-SKETCH_BITS
wide relative to their value above. Sketches merge by adding counts, so Spark's partial aggregation
builds them, a hot source costs no more than any other, and the sketches of a language (or of all rows)
are sums of those of its sources.

The thresholds replace fixed cutoffs: fences REACH inter-quartile ranges beyond the quartiles of a group's
own sketch. No number in them has a metric's unit. Each group's fences are a mean of its own and those of
its language, weighted by its number of documents against PRIOR, and those of a language likewise a mean
with those of all rows: a small group leans on what surrounds it, a large one stands for itself, without a
size at which one turns into the other. A document joins its group's fences; one unusual value may be
chance, so it is rejected if VOTES of its metrics lie outside.

Null texts count as empty; null lang or source count as ''. Values on a fence lie inside. Extra columns are
kept, whatever their names. Repeated rows are judged alike. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut_lineage, let, write_down

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SKETCH_BITS = 6
#: Steps of the inter-quartile range from the quartiles to the fences, as a fraction: the usual 1.5.
REACH = (3, 2)
#: Documents that a group's surroundings count for.
PRIOR = 50
#: Metrics outside their fences that reject a document.
VOTES = 2
#: Fences are whole numbers in so many parts of a metric's unit, so that means are exact everywhere.
SCALE = 64
METRICS = ["symbols", "word_length", "dup_lines"]

#: Up to so many groups (some 100 bytes each) their fences are sent to all tasks, and no text is shuffled; with more, documents and fences meet by group.
BROADCAST_GROUPS = 20_000

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def _covered(w: Column, n: Column) -> Column:
    """Words covered by windows of WINDOW words that occur twice or more, compared as text."""
    keyed = F.array_sort(
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("k"), i.alias("i")))
    )

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["k"] == x["k"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(keyed, repeated), covered)


def _repeat_words(w: Column) -> Column:
    """Most texts repeat no window: equal windows have equal hashes, so a text whose hashes all differ needs no comparison of text."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < WINDOW + 1, F.lit(0)).when(~some, F.lit(0)).otherwise(_covered(w, n)).cast("long")


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct column `q` with FEATURES of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = lambda drop: F.length(F.translate(t, drop, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    word_counts = let(words_of(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("rep")))
    # a generated row is computed once; an alias would be computed again wherever the optimizer moves a condition on it
    word_chars, symbols = chars(SPACES).cast("long").alias("word_chars"), (F.length(t) - chars(SYMBOLS)).cast("long").alias("n_symbols")
    counted = docs.select("*", F.explode(F.array(F.struct(word_counts.alias("w"), line_counts.alias("l"), word_chars, symbols))).alias("q0"))
    c = F.col
    q = F.struct(c("q0.w.n").alias("n_words"), c("q0.word_chars"), c("q0.n_symbols"), c("q0.l.dup").alias("n_dup_lines"), c("q0.w.rep").alias("n_repeat_words"), c("q0.l.n").alias("n_lines"))
    return counted.withColumn("q", q).drop("q0")


def base_failed() -> Column:
    return (F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words"))


def metrics() -> dict[str, Column]:
    """Whole numbers, so that sums and comparisons are exact everywhere."""
    per = lambda a, b, f: F.when(F.col(b) > 0, F.floor(F.col(a) * f / F.col(b))).otherwise(F.lit(0)).cast("long")
    return {
        "symbols": per("q.n_symbols", "q.word_chars", 10000),
        "word_length": per("q.word_chars", "q.n_words", 100),
        "dup_lines": per("q.n_dup_lines", "q.n_lines", 10000),
    }


def bucket_low(v: Column) -> Column:
    """The lower end of the sketch's bucket that holds the whole number v >= 0."""
    shift = F.greatest(F.lit(0), F.length(F.bin(v)) - (SKETCH_BITS + 1))
    power = F.pow(F.lit(2), shift).cast("long")
    return F.when(v < 2 ** (SKETCH_BITS + 1), v).otherwise(F.floor(v / power) * power).cast("long")


def sketches(features: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, metric, low, n): counts of the documents that pass the base rules, by bucket."""
    pairs = F.array(*(F.struct(F.lit(k).alias("metric"), bucket_low(v).alias("low")) for k, v in metrics().items()))
    return (
        features.where(~base_failed())
        .select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"), F.explode(pairs).alias("m"))
        .groupBy("lang", "source", "m.metric", "m.low")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <metric>_lo, <metric>_hi) in 1/SCALE of a unit, for every group in the sketches."""
    levels = [["lang", "source"], ["lang"], []]
    marked = [
        sketch.groupBy(*keys, "metric", "low")
        .agg(F.sum("n").alias("n"))
        .select(*((F.col(k) if k in keys else F.lit("")).alias(k) for k in levels[0]), F.lit(i).alias("level"), "metric", "low", "n")
        for i, keys in enumerate(levels)
    ]
    by = Window.partitionBy("level", "lang", "source", "metric")
    running = reduce(DataFrame.unionByName, marked).select("*", F.sum("n").over(by.orderBy("low")).alias("cum"), F.sum("n").over(by).alias("total"))
    at = lambda p: F.min(F.when(F.col("cum") * 100 >= F.col("total") * p, F.col("low")))
    q = running.groupBy("level", "lang", "source", "metric", "total").agg(at(25).alias("q25"), at(75).alias("q75"))
    reach = F.expr(f"(q75 - q25) * {SCALE * REACH[0] // REACH[1]}")
    q = q.select("level", "lang", "source", "metric", "total", F.greatest(F.lit(0), F.col("q25") * SCALE - reach).alias("lo"), (F.col("q75") * SCALE + reach).alias("hi"))

    def blended(own: DataFrame, around: DataFrame, keys: list[str]) -> DataFrame:
        around = around.select(*keys, "metric", F.col("lo").alias("lo_"), F.col("hi").alias("hi_"))
        mean = lambda e: F.expr(f"(total * {e} + {PRIOR} * {e}_) div (total + {PRIOR})").alias(e)
        return own.join(around, [*keys, "metric"]).select("lang", "source", "metric", mean("lo"), mean("hi"))

    own, language, everything = (q.where(F.col("level") == i) for i in range(3))
    found = blended(own, blended(language, everything, []), ["lang"])
    return found.groupBy("lang", "source").agg(*(F.max(F.when(F.col("metric") == m, F.col(e))).alias(f"{m}_{e}") for m in METRICS for e in ("lo", "hi")))


def verdict() -> Column:
    """True where fewer than VOTES metrics lie outside their fences."""
    m = metrics()
    votes = [(~(m[k] * SCALE).between(F.col(f"f.{k}_lo"), F.col(f"f.{k}_hi"))).cast("int") for k in METRICS]
    return F.coalesce(reduce(Column.__add__, votes) < VOTES, F.lit(True))


def judge(features: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds base_failed and kept. `limits` has one row per group and is cheap to read again; beyond BROADCAST_GROUPS a hot group is split by Spark."""
    few = limits.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    limits = limits.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), F.struct(*(F.col(c) for c in limits.columns if c not in ("lang", "source"))).alias("f"))
    met = (F.coalesce(lang, F.lit("")) == F.col("f_lang")) & (F.coalesce(source, F.lit("")) == F.col("f_source"))
    joined = features.join(F.broadcast(limits) if few else limits, met, "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict()).drop("f_lang", "f_source", "f")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every document."""
    features = write_down(with_features(docs.select("doc_id", "lang", "source", "text")).drop("text"))
    judged = judge(features, cut_lineage(fences(sketches(features))))
    return judged.select("doc_id", *(F.col(f"q.{c}").alias(c) for c in FEATURES[:5]), "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Features are computed once and written down beside their documents; the sketches read the features
    of that table alone, and the filter reads it as a whole.
    """
    names = docs.columns
    taken = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), F.col("lang"), F.col("source"), F.col("text"))
    features = write_down(with_features(taken).drop("text"))
    return judge(features, cut_lineage(fences(sketches(features)))).where("kept").select("doc.*")
