"""Operators on vectors, phrases and pages, against plain versions."""

import hashlib
import html
import math
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from starloom.llm import centroids, pages, phrases
from starloom.llm.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import SCHEMA, clashing, frame, rows


# ------------------------------------------------------------------------------------------------ centroids
def lloyd(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), c in zip(kept, at) if c == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    done = [(i, *near(v)) for i, v in kept]
    fit = lambda v: v if v is not None and v < 2**63 else None
    per = {j: sum(d for _, d, c in done if c == j) for j in range(len(centres))}
    big = {j for _, d, j in done if d >= 2**63}
    total = None if big else sum(per.values())
    return sorted((str(i), c, fit(d), None if c in big else fit(per[c]), fit(total),
                   hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, d, c in done)


def collected(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def vectors(n, seed=1, scale=1.0):
    rng = random.Random(seed)
    spots = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(5)]
    out = [(i, [float(np.float32(s + rng.gauss(0, scale / 3))) for s in spots[i % 5]]) for i in range(n)]
    return [(i, out[0][1] if i % 3 == 0 else e) for i, e in out]  # a third are copies of one vector


V = "vec_id long, embedding array<float>, label int"
AWKWARD = [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [float("nan")] * 64),
           (905, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (None, [0.25] * 64), (7, [0.125] * 64), (7, [0.125] * 64)]


@pytest.mark.parametrize("data", [vectors(150) + AWKWARD, vectors(5), [(1, [2.0] * 64)] * 12, AWKWARD[:6], [],
                                  vectors(20) + [(i, [float(np.float32(x)) for x in e]) for i, e in (
                                      (1000, [3e38] * 64), (1001, [-3e38, 1e20] * 32), (1002, [7e4] * 64))]],
                         ids=["mixed", "fewer than centroids", "copies", "none", "empty", "huge"])
def test_clusters_equal_lloyd(spark, data):
    df = spark.createDataFrame([(i, e, None) for i, e in data], V).repartition(3).withColumnRenamed("label", "cluster")
    assert collected(centroids.report(df)) == lloyd(data)


def test_bounds_hold_and_rule_out(spark):
    x = np.array([[math.floor(v * 1024) for v in e] for _, e in vectors(400, seed=4, scale=3.0)])
    seeds = [tuple(int(v) for v in r) for r in x[[0, 1, 2, 4, 5, 7, 8, 10]]]
    pivots = centroids.Pivots(seeds)
    cached = pivots.distances(x)
    exact = np.stack([centroids._squared(x, c) for c in seeds], axis=1)
    assert (pivots.bounds(cached, seeds) <= exact).all()
    found, best, checked = centroids.nearest(x, cached, seeds, pivots)
    assert (found == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert checked.mean() < 6  # of eight


# ------------------------------------------------------------------------------------------------ phrases
def collocations(docs, least=30, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = {(p[0], *p[i:i + k]) for p, g in cands.items() for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1)
            if 100 * g >= 80 * f[(p[0], *p[i:i + k])]}
    out = []
    for p, a in cands.items():
        if p not in gone:
            cuts = [(2000000 * a // (f[p[:k]] + f[(p[0], *p[k:])]), k) for k in range(2, len(p))]
            s, k = min(cuts)
            out.append((p[0], -s, -a, " ".join(p[1:]).encode(), f[p[:k]], f[(p[0], *p[k:])]))
    out.sort()
    rank, got = Counter(), []
    for lang, s, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -s))
    return got


def phrase_rows(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_phrases_equal_brute_force(spark):
    data = rows() + [(5000 + i, f"New York, new YORK city? the\tbig apple x{i % 3} the big apple", "en", None, None) for i in range(40)]
    want = collocations(data, 10)
    assert len(want) > 100
    assert phrase_rows(phrases.report(clashing(frame(spark, data)), 10)) == sorted(want)
    assert phrase_rows(phrases.report(frame(spark, data), 10, 7)) == sorted(collocations(data, 10, 7))


@pytest.mark.parametrize("data", [[], [(1, None, None, None, None)], [(1, "one", "en", None, None), (2, " .,; ", "", None, None)]])
def test_phrases_of_next_to_nothing(spark, data):
    assert phrases.report(spark.createDataFrame(data, SCHEMA), 1).collect() == []


def test_trie_bursts_and_spills(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)] + ["hot"] * 150
    text = " ".join(rng.choice(words) for _ in range(20_000)).encode()
    monkeypatch.setattr(phrases, "BURST", 50)
    monkeypatch.setattr(phrases, "SLICE", 9_000)
    for n in (1, 2, 3, 4):
        w = text.decode().split()
        want = Counter(" ".join(w[i:i + n]) for i in range(len(w) - n + 1))
        counter, got = phrases.Counter("en", n, None), Counter()
        batches = list(counter.add(text))
        kinds = {type(k).__name__ for k in counter.trie.kids}
        half = len(counter.trie.settle().first) // 2
        batches += counter.spill(half)
        assert counter.trie.size <= half
        batches += counter.spill(0)
        assert counter.trie.size == 0
        for b in batches:
            names = b.column("phrase").to_pylist()
            assert names == sorted(names, key=str.encode)
            got.update(dict(zip(names, b.column("n").to_pylist())))
        assert got == want
        assert n < 3 or "Node" in kinds


def test_words_start_anew_when_ids_run_out(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 500)
    text = " ".join(f"w{i} w{i + 1}" for i in range(2_000)).encode()
    w = text.decode().split()
    want = Counter(" ".join(w[i:i + 2]) for i in range(len(w) - 1))

    made = []
    monkeypatch.setattr(phrases, "WORDS_KEPT", 700)
    monkeypatch.setattr(phrases, "Words", lambda lang, make=phrases.Words: made.append(lang) or make(lang))
    counter, got = phrases.Counter("en", 2, None), Counter()
    for b in [*counter.add(text), *counter.spill(0)]:
        got.update(dict(zip(b.column("phrase").to_pylist(), b.column("n").to_pylist())))
    assert got == want and len(made) >= 3


# ------------------------------------------------------------------------------------------------ pages
P = "page_id long, url string, html string, text string, site long"


def page(article, nav="<nav>Home About</nav>", foot="<footer>bye</footer>"):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{nav}{article}{foot}</body></html>"


def texts(spark, data):
    df = spark.createDataFrame([(*r, None, None) for r in data], P).repartition(3)
    return {r.page_id: r.text for r in pages.report(df).collect()}


def test_templates_go_and_quotes_stay(spark):
    menu = "<div><a>Start</a> <a>World</a></div>"
    plain = [(i, f"https://A.example/{i}", page(f"{menu}<p>Story {i} of the day.</p><p>Same line.</p>" if i < 3 else f"{menu}<p>Story {i}.</p>", "", ""))
             for i in range(12)]
    share = [(100 + i, f"http://b.example:80/{i}", page(f"<article><h1>T{i}</h1><p>Text {i}</p><p>Tell your friends</p>"
              + ("<p>Quoted by many</p>" if i % 2 else "") + "</article>")) for i in range(24)]
    copies = [(200 + i, f"http://c.example/{i}", page("<p>One text</p><p>in copies</p>", f"<nav>{i}</nav>")) for i in range(30)]
    got = texts(spark, plain + share + copies)
    assert got[0] == "Story 0 of the day. Same line." and got[5] == "Story 5."
    assert got[100] == "T0 Text 0" and got[101] == "T1 Text 1 Quoted by many"
    assert {got[200 + i] for i in range(30)} == {"One text in copies"}


def test_markup(spark):
    data = [
        (1, None, None), (2, "http://x", ""), (3, "no url", "just text &amp; more"), (None, "http://x", "<p>null id"),
        (4, "http://x", page("<article><header><h1>T &lt; U</h1><p>by me</p></header><p>a<b>b</b>c<br>d\n e&nbsp;f<script>x</script></article>")),
        (5, "http://x", page("<div class='has-sidebar'><article class=post><p>main<div class='shareButtons'>s</div></article></div>"
                             "<section id=comments><article class=comment>c</article></section>")),
        (6, "http://x", "<body><form><p>whole page in a form</p></form>"), (7, "http://x", "<article>cut <p>off <a hre"),
        (8, "http://x", "<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>1 < 2</article>"),
        (9, "http://x", "<article>" + "<div>" * 50_000 + "deep"), (10, "http://x", "<article>a<!-- no > end"),
        (11, "http://x", "<article>" + "word " * 400_000), (12, "http://x", "<main><p>in main</p></main><div>out</div>"),
    ]
    got = texts(spark, data)
    assert got == {1: "", 2: "", 3: "just text & more", None: "null id", 4: "T < U abc d e f", 5: "main", 6: "whole page in a form",
                   7: "cut off", 8: "a b c d 1 < 2", 9: "deep", 10: "a", 11: ("word " * 400_000).strip(), 12: "in main"}


def test_pages_empty_table(spark):
    assert pages.report(spark.createDataFrame([], P)).collect() == []


def test_pages_of_the_given_table(spark):
    """There the main text is all that an article element holds, and nothing else."""
    want = {i: " ".join(html.unescape(re.sub("<[^>]*>", " ", re.search("(?s)<article>(.*?)</article>", h).group(1))).split())
            for i, h in duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall()}
    got = QUERIES["op13_site_templates"](spark, SF_SMALL).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
