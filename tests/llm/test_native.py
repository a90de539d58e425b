"""Operators made of built-in expressions: quality rules, line and exact de-duplication, mixing."""

import hashlib
from collections import Counter, defaultdict

import pytest

from starloom.llm import exact, lines, mix, quality
from tests.llm.data import WORD, clashing, frame, rows, words


def expected_quality(text):
    t = text or ""
    w = words(t)
    ln = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(ln) - len(set(ln)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_quality_matches_brute_force(spark):
    got = Counter(tuple(r)[:-1] for r in quality.score(frame(spark)).collect())
    assert got == Counter((d, *expected_quality(t)) for d, t, *_ in rows())


def test_quality_rules_decide(spark):
    good = "the river runs under the bright stone and the morning is long " + "with letters of the garden"
    data = [(1, good, "en", "a", 1), (2, good.replace(" ", " # ", 8), "en", "a", 1),
            (3, " ".join(w + "!!" for w in good.split()), "en", "a", 1), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13", "en", "a", 1),
            (5, " ".join(f"zz{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(80)), "en", "a", 1),
            (6, "\n".join(f"- the reading item {chr(97 + i)} of these papers" for i in range(12)), "en", "a", 1),
            (7, "\n".join(f"the item {chr(97 + i)} of it..." for i in range(12)), "en", "a", 1)]
    out = quality.verdict(quality.measure(frame(spark, data))).select("doc_id", "broken_rules").collect()
    broken = {r[0]: r[1] for r in out}
    assert broken == {1: [], 2: ["symbols"], 3: ["exclamation"], 4: ["word_length", "letters"], 5: ["stop_words"],
                      6: ["bullets"], 7: ["ellipsis"]}


def test_quality_keeps_columns_and_bears_empty_tables(spark):
    df = clashing(frame(spark))
    kept = quality.keep_documents(df)
    assert kept.columns == df.columns
    want = Counter(r[0] for r in quality.score(frame(spark)).filter("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    assert quality.score(frame(spark, [])).count() == 0


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("bits", [128, 2])
def test_exact_groups_match_brute_force(spark, bits):
    """With identifiers of 2 bits nearly all chunks clash; the groups must not change."""
    groups = defaultdict(list)
    for d, t, *_ in rows():
        groups[normal(t)].append(d)
    want = Counter()
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, top, len(ids), i == top, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact.groups(frame(spark), bits).collect())) == want


def test_exact_chunks_rebuild_the_text(spark):
    out = frame(spark).select(exact.normalised().alias("t")).select("t", exact.chunks_of("t").alias("c")).collect()
    for t, c in out:
        assert "".join(c) == t and all(len(x) <= exact.MOST for x in c)
    assert max(len(c) for _, c in out) > 20


def test_exact_keeps_one_row_of_each_text(spark):
    df = clashing(frame(spark))
    kept = exact.keep_documents(df)
    assert kept.columns == df.columns
    got = Counter(normal(r["text"]) for r in kept.collect())
    assert got == Counter({normal(t): 1 for _, t, *_ in rows()})
    assert exact.groups(frame(spark, [])).count() == 0


def expected_lines(data):
    docs = sorted({(d, t or "") for d, t, *_ in data}, key=lambda r: (r[0] is None, r[0] or 0, 0))
    seen, out = {}, {}
    for d, t in docs:
        ln = t.split("\n")
        at = [i for i, x in enumerate(ln) if WORD.search(x)]
        gone = set()
        for k in range(len(at) - 2):
            w = tuple(ln[i] for i in at[k:k + 3])
            if seen.setdefault(w, (d, t, k)) != (d, t, k):
                gone |= {k, k + 1, k + 2}
        lost = {i for k in gone for i in range(at[k], at[k + 1] if k + 1 in gone else at[k] + 1)}
        out[(d, t)] = (len(at), len(gone), "\n".join(x for i, x in enumerate(ln) if i not in lost))
    return out


def test_lines_match_brute_force(spark):
    data = rows() + [(3000 + i, f"first {i}\nshared one\n\nshared two\nshared three\n \nshared four\nlast {i}\n", "en", "s", 1)
                     for i in range(9)] + [(3100, "a\nb\nc\na\nb\nc\na\nb\nc", "en", "s", 1)]
    want = expected_lines(data)
    got = lines.deduplicated(clashing(frame(spark, data))).collect()
    assert Counter((r[0], *r[1:]) for r in got) == Counter((d, *want[(d, t or "")]) for d, t, *_ in data)
    assert sum(r["n_removed"] for r in got) > 30
    assert lines.deduplicated(frame(spark, [])).count() == 0


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in free)
        target = {s: capped.get(s, left * weight[s] / w if s in free else 0) for s in order}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        capped |= {s: 3 * sizes[s] for s in over}


def test_mix_targets_and_words(spark):
    data = rows() + [(4000, "tiny source of few words", "en", "zz", 1), (4001, None, "en", "zzz", 1)]
    sizes = Counter()
    for _, t, _, s, _ in data:
        sizes[s] += len(words(t))
    want = expected_targets(sizes)
    source = {d: s for d, _, _, s, _ in data if d is not None}
    got = mix.mixture(clashing(frame(spark, data))).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(words(t))) for d, t, *_ in data)
    taken = Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        if r["doc_id"] is not None:
            s = source[r["doc_id"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
            taken[s] += r["taken"]
    for s in sizes:
        if s is not None and s != "src0":  # those two hold rows without an id as well
            assert taken[s] == int(want[s] + 1e-6)
    assert want["zz"] == 15 and mix.mixture(frame(spark, [])).count() == 0


def test_mix_is_stable_and_ordered(spark):
    a = mix.mixture(frame(spark)).orderBy("doc_id", "size", "taken", "position").collect()
    b = mix.mixture(frame(spark).repartition(5)).orderBy("doc_id", "size", "taken", "position").collect()
    assert a == b
    positions = [r["position"] for r in mix.mixture(frame(spark)).collect() if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_mix_positions_follow_the_schedule(spark):
    """In the first half of training a source takes the integral of its schedule over that half."""
    data = [(i, "one two three four", "en", "ab"[i % 2], 1) for i in range(4000)]
    rowsets = mix.placed(mix.sized(frame(spark, data)))
    out = rowsets.select("name", "target", mix.copies(rowsets).alias("c")).collect()
    early = Counter()
    for r in out:
        early[r["name"]] += sum(c["words"] for c in r["c"] if c["position"] < 0.5)
    target = {r["name"]: r["target"] for r in out}
    assert early["a"] / target["a"] == pytest.approx(0.625, abs=0.01)  # 1.5 falling to 0.5
    assert early["b"] / target["b"] == pytest.approx(0.375, abs=0.01)  # 0.5 rising to 1.5


def test_training_order_returns_documents(spark):
    df = clashing(frame(spark))
    out = mix.training_order(df)
    assert out.columns == df.columns
    got, want = Counter(), Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    for r in mix.mixture(frame(spark)).collect():
        want[r["doc_id"]] += r["taken"]
    assert got == Counter({k: v for k, v in want.items() if v})
