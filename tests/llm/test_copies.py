"""Near duplicates and substring de-duplication against brute force, and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm import exact, lines, near, substring, wordhash
from tests.llm.data import SCHEMA, clashing, frame, prose, rows, words


def shingles(text):
    w = words(text)
    c = Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    return {k: 1 + np.log(v) for k, v in c.items()}


def jp(a, b):
    if not a or not b:
        return float(not a and not b)
    both = set(a) | set(b)
    out = 0.0
    for d in set(a) & set(b):
        out += 1 / sum(max(a.get(x, 0) / a[d], b.get(x, 0) / b[d]) for x in both)
    return out


def closed(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_word_hashes_equal_words():
    texts = [(t or "").encode() for _, t, *_ in rows()]
    w = wordhash.Words(texts)
    own = [x for t in texts for x in t.split()]
    assert [x for i in range(len(texts)) for x in w.text(i)] == own
    assert len(set(zip(own, w.hash.tolist(), strict=True))) == len(set(own)) == len(set(w.hash.tolist()))
    at, h = w.windows(5)
    seen = defaultdict(set)
    for i, x in zip(at.tolist(), h.tolist(), strict=True):
        seen[x].add(tuple(own[i:i + 5]))
    assert all(len(v) == 1 for v in seen.values())
    assert len(at) == sum(max(0, len(t.split()) - 4) for t in texts)
    alone = wordhash.Words([texts[3]])
    assert np.array_equal(alone.hash, w.hash[w.first[3]:w.first[4]])


def test_registers_agree_with_probability_jaccard():
    rng = random.Random(0)
    for _ in range(4):
        a = {rng.getrandbits(60): rng.choice([1.0, 1.7, 2.4]) for _ in range(rng.randint(5, 300))}
        b = {k: (v if rng.random() < 0.9 else 1.0) for k, v in a.items() if rng.random() < 0.85}
        b |= {rng.getrandbits(60): 1.0 for _ in range(rng.randint(1, 30))}
        doc = np.repeat([0, 1], [len(a), len(b)])
        h = np.array([*a, *b], dtype=np.uint64)
        r = near.sketch(doc, h, np.array([*a.values(), *b.values()]), 2, 4000)
        arrays = [(np.array(sorted(x), dtype=np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert near.probability_jaccard(*arrays) == pytest.approx(jp(a, b))
        assert (r[0] == r[1]).mean() == pytest.approx(jp(a, b), abs=0.04)


def test_sketch_does_not_depend_on_the_batch():
    texts = [t.encode() for _, t, *_ in rows() if t][:30]
    whole = near.sketch(*near.weighted(wordhash.Words(texts)), len(texts), 140)
    for i in (0, 7, 29):
        one = near.sketch(*near.weighted(wordhash.Words([texts[i]])), 1, 140)
        assert np.array_equal(one[0], whole[i])


def chain(n):
    """Copies that change step by step: neighbours are near, the ends are not."""
    w = prose(random.Random(12), 150).split(" ")
    out = []
    for i in range(n):
        out.append((7000 + i, " ".join(w), "en", "s", 1))
        w = [*w]
        w[i * 11 + 3] = f"step{i}"
    return out


def test_near_classes_match_brute_force(spark):
    data = rows() + chain(12)
    texts = [" ".join(words(t)) for _, t, *_ in data]
    sets = [shingles(t) for _, t, *_ in data]
    links = [(i, j) for i in range(len(data)) for j in range(i)
             if texts[i] == texts[j] or (min(len(sets[i]), len(sets[j])) * 2 > max(len(sets[i]), len(sets[j]))
                                         and jp(sets[i], sets[j]) >= near.THRESHOLD - 1e-9)]
    root = closed(len(data), links)
    members = defaultdict(list)
    for i, r in enumerate(root):
        members[r].append(i)
    want = Counter()
    for i, r in enumerate(root):
        ids = [data[j][0] for j in members[r]]
        name = min((x for x in ids if x is not None), default=None)
        want[(data[i][0], name, len(ids), len({texts[j] for j in members[r]}))] += 1
    got = near.report(clashing(frame(spark, data))).collect()
    assert Counter(tuple(r)[:4] for r in got) == want
    assert {r["class_id"] for r in got if r["doc_id"] and 7000 <= r["doc_id"] < 7012} == {7000}
    assert near.report(frame(spark, [])).count() == 0


def test_near_keeps_one_document_of_each_class(spark):
    df = clashing(frame(spark))
    kept = near.keep_documents(df)
    assert kept.columns == df.columns
    classes = near.classes(frame(spark)).select("root").distinct().count()
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert sum(ids.values()) == classes and all(v == 1 for k, v in ids.items() if k is not None)


def test_components_of_long_and_wide_graphs(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 90)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(5, 5)]
    rng.shuffle(edges)
    root = closed(400, edges)
    got = {r["node"]: r["root"] for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == root[i] for i in range(400))


def expected_substrings(data):
    docs = sorted(((d if d is not None else 2**63, words(t)) for d, t, *_ in data), key=lambda r: r[0])
    first, out = {}, []
    for d, w in docs:
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i:i + 13]), d)
    for d, w in docs:
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d if d != 2**63 else None, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def spliced(n=60):
    """Documents made of pieces of each other, cut and joined at odd places."""
    rng = random.Random(9)
    pool = [f"w{rng.randint(0, 25)}" for _ in range(400)]
    out = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(1, 8)):
            a = rng.randrange(380)
            w += pool[a:a + rng.randint(3, 40)]
            w += [f"own{i}"] * rng.choice([0, 0, 1, 14])
        out.append((6000 + rng.randint(0, 500), " ".join(w), "en", "s", 1))
    return out


@pytest.mark.parametrize("data", [rows(), spliced()], ids=["rows", "spliced"])
def test_substrings_match_brute_force(spark, data):
    got = substring.report(clashing(frame(spark, data))).collect()
    want = expected_substrings(data)
    assert sum(x[2] for x in want) > 200
    assert Counter(map(tuple, got)) == Counter(want)


def test_substrings_of_an_empty_table(spark):
    assert substring.report(frame(spark, [])).count() == 0


def test_texts_travel_compressed(spark):
    text = "one two three four five six seven " * 300
    docs = spark.createDataFrame([(1, text), (2, ""), (3, "é  \n x")], "doc long, text string")
    sent = {r["doc"]: bytes(r["text"]) for r in substring.packed(docs).collect()}
    assert {d: zlib.decompress(t).decode() for d, t in sent.items()} == {1: text, 2: "", 3: "é  \n x"} and len(sent[1]) < 500
    anchors = [r["anchor"] for r in substring.block_rows(docs).collect()]
    assert anchors and all(0 <= a < 2**48 for a in anchors)
    hits = spark.sql("select 1L as doc, array(5L) as same, array(7L) as mixed")
    opened = substring.first_parse(substring.packed(docs).join(hits, "doc", "left"))
    assert dict(opened.dtypes)["text"] == "binary"


def test_blocks_and_open_windows_are_shuffled_once(spark):
    docs = frame(spark, rows()).selectExpr("doc_id doc", "text")
    hits = substring.anchor_hits(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert hits.count("MapInArrow") == 1 and "Join" not in hits
    opened = spark.createDataFrame([(1, 5, [0], [7], [1]), (2, 6, [3], [7], [1]), (3, None, [4], [7], [1]), (4, 5, [9], [7], [1])],
                                   "row long, doc long, at array<int>, w1 array<long>, w2 array<smallint>")
    starts = substring.boundary_hits(opened)
    assert "Join" not in starts._jdf.queryExecution().optimizedPlan().toString()
    assert {r["row"]: r["starts"] for r in starts.collect()} == {2: [3], 3: [4]}


def kept_ids(rows_in, same):
    """Brute force: the class of each row under ``same`` (pairwise), closed."""
    links = [(i, j) for i in range(len(rows_in)) for j in range(i) if same(rows_in[i], rows_in[j])]
    root = closed(len(rows_in), links)
    members = defaultdict(list)
    for i, r in enumerate(root):
        members[r].append(rows_in[i]["doc_id"])
    return list(members.values())


def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force on its input, from rows to packed pieces."""
    import corpus_pipeline as cp
    from starloom.llm import mix
    from tests.llm.test_native import expected_quality, normal

    frame(spark, rows(3, 90)).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, sizes, out = docs.columns, [docs.count()], {}
    for i, (name, stage) in enumerate(cp.STAGES):
        before = docs.collect()
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"s{i}"))
        docs_after = spark.read.parquet(str(tmp_path / f"s{i}"))
        after = out[name] = docs_after.collect()
        ids = Counter(r["doc_id"] for r in after)
        if name == "quality_rules":
            assert ids and all(not expected_quality(r["text"])[5] for r in after)
            plain = [r["doc_id"] for r in before if r["text"] and not expected_quality(r["text"])[5]
                     and "x" * 50 not in r["text"] and len(words(r["text"])) > 15]
            assert set(plain) <= set(ids)
        elif name == "exact_dedup":
            assert ids == Counter(max(c, key=lambda x: (x is not None, x)) for c in kept_ids(
                before, lambda a, b: normal(a["text"]) == normal(b["text"])))
        elif name == "near_dedup":
            sets = {id(r): shingles(r["text"]) for r in before}
            assert ids == Counter(min(c, key=lambda x: (x is None, x)) for c in kept_ids(
                before, lambda a, b: words(a["text"]) == words(b["text"])
                or jp(sets[id(a)], sets[id(b)]) >= near.THRESHOLD - 1e-9))
        elif name == "mix_sources":
            assert mix.mixture(docs).agg({"taken": "sum"}).first()[0] == sum(len(words(r["text"])) for r in after)
        if name != "packing":
            assert docs_after.columns == columns
            docs = docs_after
            sizes.append(len(after))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    tokens = sum(r["length"] for r in out["packing"])
    assert sum(r["start"] == 0 for r in out["packing"]) == len(out["mix_sources"]) and tokens > len(out["mix_sources"])
    assert cp.run(spark, str(tmp_path)).agg({"length": "sum"}).first()[0] == tokens


def test_ids_of_any_type(spark):
    """Text ids and the largest long are ids like others; a null id comes last."""
    data = [r for r in rows(4, 30) if len(r[1] or "") < 5000]
    as_text = spark.createDataFrame([(None if d is None else f"{d:05d}", *r) for d, *r in data], "doc_id string, text string, lang string, "
                                    "source string, n_chars long").repartition(3)
    shown = lambda df: Counter((None if r["doc_id"] is None else int(r["doc_id"]), *tuple(r)[1:]) for r in df.collect())
    assert shown(substring.report(as_text)) == shown(substring.report(frame(spark, data)))
    assert shown(lines.deduplicated(as_text)) == shown(lines.deduplicated(frame(spark, data)))
    top = 2**63 - 1
    text = "one line of it\nanother line here\nand a third line too\n" + " ".join(f"w{i}" for i in range(20))
    got = substring.report(frame(spark, [(top, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text, "en", "s", 1)])).collect()
    assert {(r["doc_id"], r["n_removed"] > 0) for r in got} == {(top, True), (1, False), (None, True)}
    got = lines.deduplicated(frame(spark, [(top, text, "en", "s", 1), (1, text, "en", "s", 1)])).collect()
    assert {(r["doc_id"], r["n_removed"] > 0) for r in got} == {(top, True), (1, False)}


def test_the_row_kept_does_not_depend_on_order(spark):
    """Of rows equal in id and text the same one stays, however they are dealt out."""
    text = " ".join(f"word{i}" for i in range(40))
    data = [(5, text, lang, source, n) for lang in ("en", "de", None) for source in ("a", "b", None) for n in (1, 2, None)]
    seen = set()
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, SCHEMA).repartition(seed + 2)
        seen |= {("exact", tuple(r)) for r in exact.keep_documents(df).collect()}
        seen |= {("near", tuple(r)) for r in near.keep_documents(df).collect()}
    assert len(seen) == 2
