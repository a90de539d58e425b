"""Small tables with the awkward rows every operator must bear."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, lang="en"):
    stock = {"en": "the and of river stone walks under bright morning table letter garden".split(),
             "de": "der die und nicht schön über straße fluss garten morgen brief tisch".split()}[lang]
    out = []
    while len(out) < n:
        line = [rng.choice(stock) + rng.choice(["", "", "s", "e", str(rng.randint(0, 9)) if rng.random() < 0.02 else ""])
                for _ in range(rng.randint(4, 12))]
        out += [*line[:-1], line[-1] + ".\n"]
    return " ".join(out[:n]).replace("\n ", "\n")


def rows(seed=3, n=60):
    """(doc_id, text, lang, source, n_chars): nulls in every column, empty and very long texts, exact and near copies,
    shared passages, repeated rows."""
    rng = random.Random(seed)
    out, texts = [], []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        text = prose(rng, rng.randint(20, 220), lang)
        if texts and rng.random() < 0.15:
            text, lang = rng.choice(texts)
        elif texts and rng.random() < 0.15:
            text, lang = rng.choice(texts)
            w = text.split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif texts and rng.random() < 0.2:
            w = rng.choice(texts)[0].split(" ")
            a = rng.randrange(max(1, len(w) - 30))
            text += "\n" + " ".join(w[a:a + 30])
        texts.append((text, lang))
        out.append([i * 7 % 1000, text, lang, f"src{i % 4}", len(text)])
    hot = prose(rng, 90)
    for i in range(25):  # a hot source with a group of copies
        out.append([1000 + i, hot if i % 2 else hot + f" tail{i}", "en", "src0", len(hot)])
    out += [
        [2000, None, None, None, None], [2001, "", "en", "src1", 0], [2002, " \t\n ", "de", None, 4],
        [2003, "word", None, "src2", 4], [2004, "ünïcödé ñandú 東京   tail\x0bend\x85more", "en", "src3", 20],
        [2005, prose(rng, 30_000), "en", "src1", None], [2006, "x" * 200_000, None, "src2", 200_000],
        [2007, "the cat sat on the mat " * 400, "en", "src3", None],
        [None, "a document without an id, but with words enough to pass for one of the others here", "en", "src0", 1],
        [None, None, None, None, None],
        [2008, "Doubled Row WITH the and of it in full", "en", "src1", 5],
        [2008, "Doubled Row WITH the and of it in full", "en", "src1", 5],
        [2009, "doubled row with the and of it in full", "en", "src1", 5],
    ]
    return [tuple(r) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def clashing(df):
    """The table with more columns, named as an operator might name its own."""
    from pyspark.sql import functions as F

    names = ["_t", "_w", "_h", "_c", "_row", "_key", "_n", "key", "node", "h", "kept", "size", "target", "name", "place",
             "bucket", "words", "n_words", "doc", "th", "lines", "at", "ids", "start", "keep_id", "rank", "class_id"]
    return df.select("*", *[F.lit(7).alias(n) for n in names])
