"""Passages that occur before, against a plain search of windows of words."""

import random

from kgsync.llm import substring_dedup

from .helpers import SCHEMA


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def repeated(texts, n):
    """For each text, a flag for each word: in a sequence of n words that occurred before."""
    seen, out = set(), []
    for t in texts:
        w = t.split()
        flags = [False] * len(w)
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            if g in seen:
                flags[i : i + n] = [True] * n
            seen.add(g)
        out.append(flags)
    return out


def test_passages_of_a_repeated_line(spark):
    rng = random.Random(11)
    shapes = [(1, 60), (3, 20), (5, 12), (5, 60), (8, 8), (12, 5), (51, 1)] * 12
    texts = []
    for k, m in shapes:
        passage = "\n".join([words(rng, k)] * m)
        texts += [f"{words(rng, rng.randint(30, 90))}\n{passage}\n{words(rng, rng.randint(30, 90))}" for _ in range(2)]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], SCHEMA)
    left = {r.doc_id: r.text.split() for r in substring_dedup.documents(df).select("doc_id", "text").collect()}
    want = repeated(texts, 51)
    for i in range(1, len(texts), 2):
        passage = shapes[i // 2][0] * shapes[i // 2][1]
        assert sum(want[i]) == passage
        assert len(texts[i].split()) - len(left[i]) >= passage // 2, shapes[i // 2]


def test_what_goes_occurred_before_in_one_place(spark):
    """Short repeats from several documents, side by side, are no passage."""
    rng = random.Random(12)
    texts = []
    for _ in range(60):
        parts = [words(rng, 18) for _ in range(3)]
        texts += [f"{words(rng, 40)} {p} {words(rng, 40)}" for p in parts]
        texts.append(f"{words(rng, 40)} {' '.join(parts)} {words(rng, 40)}")
    assert not any(map(any, repeated(texts, substring_dedup.MIN_WORDS)))
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], SCHEMA)
    assert [r.text for r in substring_dedup.documents(df).select("doc_id", "text").orderBy("doc_id").collect()] == texts


def test_every_passage_of_51_words_is_caught_and_shorter_repeats_stay(spark):
    """Against a plain search of windows of words: passages of 51 words, and of one word less than a window needs."""
    rng = random.Random(13)
    long, short = ([words(rng, n) for _ in range(150)] for n in (51, substring_dedup.MIN_WORDS - 1))
    texts = [f"{words(rng, rng.randint(5, 90))} {p} {words(rng, rng.randint(5, 90))}" for p in long + short for _ in range(2)]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], SCHEMA)
    left = {r.doc_id: r.text for r in substring_dedup.documents(df).select("doc_id", "text").collect()}
    flags = repeated(texts, substring_dedup.MIN_WORDS)
    for i, t in enumerate(texts):
        gone = len(t.split()) - len(left[i].split())
        assert gone <= sum(flags[i])  # nothing but what occurred before as a whole
        assert (gone >= substring_dedup.MIN_WORDS) == (i < 300 and i % 2 == 1)
