"""Packing and language identification: what they return against direct computation."""

import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from starloom.llm import langid, pack
from tests.llm.data import SCHEMA, clashing, frame, rows

VOCABULARY = public_tokenizers.path(pack.VOCABULARY)
PIECES = public_tokenizers.path(langid.VOCABULARY)


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer():
    texts = [t or "" for _, t, *_ in rows()]
    texts += ["a  b", " lead", "trail ", "x\n\ny", "x\n y", "x \ny", "tab\tx", "a b c", "it's we'll\n'tis", "\n", " ",
              "  ", "a\0b c", "1 22 333", "<|endoftext|> x", "é è\nñ", "　x y", "a\x1c b", "line\r\nline 2"]
    rng = np.random.default_rng(1)
    texts += ["".join(rng.choice(list("ab 1.\n\t'"), 40)) for _ in range(300)]
    for segment in (100_000, 7):
        encode = pack.Encoder(VOCABULARY, segment)
        for t, want in zip(texts, plain_ids(texts), strict=True):
            assert encode(t).tolist() == [*want, pack.END_ID]


def test_added_tokens_are_their_own_ids(spark):
    """The operator's encoder gives what the library gives as it is, also where texts are cut into segments."""
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x\n<|endoftext|>\n y", "  <|endoftext|>  y",
             "<|endoftext|", "a <|endoftext |> b", "one two three four <|endoftext|> five six seven " * 9, ""]
    want = [e.ids for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    for encode in (pack.encoder(VOCABULARY), pack.Encoder(VOCABULARY, 7, special=True)):
        assert [encode(t).tolist() for t in texts] == [[*w, pack.END_ID] for w in want]
    got = pack.pack(frame(spark, [(1, texts[0], "en", "s", 1)]), VOCABULARY).collect()
    assert sum(r["length"] for r in got) == 5 and {r["doc_tokens"] for r in got} == {5}


def test_hilbert_neighbours_touch():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    key = pack.hilbert(g, bits=3)
    assert sorted(key) == list(range(512))
    path = g[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_pack_cuts_and_fills(spark):
    data = rows()
    got = pack.pack(clashing(frame(spark, data)), VOCABULARY).collect()
    want = Counter()
    ids = defaultdict(list)
    for (d, *_), x in zip(data, plain_ids([t or "" for _, t, *_ in data]), strict=True):
        ids[d].append(x + [pack.END_ID])
        want[d] += len(x) + 1
    total, sequences = Counter(), defaultdict(list)
    for r in got:
        total[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append(r)
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], dtype="<u4")
                                                            .tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    assert total == want
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: no padding
    once = [d for d in ids if len(ids[d]) == 1]
    for d in once:
        at = 0
        for r in sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
    assert pack.pack(frame(spark, []), VOCABULARY).count() == 0


def test_pack_puts_like_documents_together(spark):
    """Neighbours along the curve share a language far more often than chance."""
    data = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate((t, lang) for _, t, lang, *_ in rows(5, 200)[:200])]
    key = {r["doc_id"]: r["key"] for r in pack.tokenized(frame(spark, data), VOCABULARY).collect()}
    order = sorted(data, key=lambda r: (key[r[0]], r[0]))
    same = np.mean([a[2] == b[2] for a, b in zip(order, order[1:], strict=False)])
    assert same > 0.75


def marginal(word, names, p):
    s = langid.MARK + word
    a = np.zeros((len(s) + 1, p.shape[1]))
    a[0] = 1
    for t in range(1, len(s) + 1):
        for n in range(1, t + 1):
            piece = s[t - n:t]
            if piece in names:
                a[t] += a[t - n] * p[names[piece]]
            elif n == 1:
                a[t] += a[t - n] * langid.UNKNOWN
    return np.log(a[-1])


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(PIECES)
    p = np.random.default_rng(0).random((pieces.n, 3)) * 1e-3
    names = {x: i for i, x in enumerate(pieces.names)}
    words = ["the", "schönheit", "a", "entlichkeitenverschwerung", "ñandú", "łódź", "x" * 35, "über", "東京"]
    got = langid.log_scores(words, pieces, langid.table(p))
    assert np.allclose(got, [marginal(w, names, p) for w in words])
    long = langid.log_scores(["ab" * 5000], pieces, langid.table(p))
    assert np.isfinite(long).all() and (long < -1000).all()


def test_expected_counts_are_the_gradient():
    """The expected uses of a piece are the derivative of the log probability by the log of the piece's."""
    pieces = langid.Pieces(PIECES)
    p = np.random.default_rng(2).random((pieces.n, 1)) * 1e-2
    uses = langid.expected(["stone"], np.ones((1, 1)), pieces, langid.table(p))
    for i in np.flatnonzero(uses[:, 0])[:12]:
        q = p.copy()
        q[i] *= 1 + 1e-6
        change = langid.log_scores(["stone"], pieces, langid.table(q)) - langid.log_scores(["stone"], pieces, langid.table(p))
        assert change[0, 0] / 1e-6 == pytest.approx(uses[i, 0], abs=1e-4)


def lettered(text):
    return any(unicodedata.category(c)[0] == "L" for c in text)


def test_words_are_letters_and_their_marks():
    assert langid.words_of("½ ② Ⅷ x² 3rd हिन्दी e\u0301té ⓐ") == ["x", "rd", "हिन्दी", "e\u0301té"]
    rng = np.random.default_rng(5)
    for _ in range(300):
        text = "".join(chr(c) for c in rng.integers(32, 0x3000, 6))
        assert bool(langid.words_of(text)) == lettered(text)


def test_long_pieces_and_long_words_teach():
    pieces = langid.Pieces(PIECES)
    longest = max((x for x in pieces.names if x[0] == langid.MARK), key=len)
    assert len(longest) == pieces.longest > 8
    p = np.full((pieces.n, 1), 1.0 / pieces.n)
    uses = langid.expected([longest[1:]], np.ones((1, 1)), pieces, langid.table(p))
    assert uses[pieces.names.index(longest), 0] > 0.9
    # a word of many parts uses what its parts use; the pieces in it make up its length
    word = "schönheit" * 700
    uses = langid.expected([word, "a"], np.array([[1.0], [0.0]]), pieces, langid.table(p))
    length = sum(u * len(x) for u, x in zip(uses[:, 0], pieces.names))
    assert length == pytest.approx(len(word) + 1, rel=1e-6)


def test_batches_without_a_letter(spark):
    """In training, over many small partitions, some of them without any letter; number-like signs are no letters."""
    data = [(i, "1 2 3 ½ Ⅷ ²" if i % 2 else "the river runs under the stone", "en", "s", 1) for i in range(60)]
    got = langid.report(spark.createDataFrame(data, SCHEMA).repartition(30), PIECES).collect()
    assert {(r["doc_id"] % 2, r["lang_pred"]) for r in got} == {(1, "und"), (0, "en")}
    empty = [(i, "", "en", "s", 1) for i in range(9)]
    assert {(r["lang_pred"], r["score"]) for r in langid.report(frame(spark, empty), PIECES).collect()} == {("und", 0.0)}


def test_language_of_held_out_documents(spark):
    data = rows(8, 300)
    truth = {d: lang for d, t, lang, *_ in data if lang and d is not None and len(t or "") > 60 and "x" * 50 not in t}
    got = langid.report(clashing(frame(spark, data)), PIECES).collect()
    assert len(got) == len(data)
    for r in got:
        crc = zlib.crc32(str(r["doc_id"]).encode()) % 3 if r["doc_id"] is not None else None
        assert r["held_out"] == (crc == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    und = {d for d, t, *_ in data if d is not None and not lettered(t or "")}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und" and r["doc_id"] is not None} == und


def test_language_without_training_data(spark):
    data = [(1, "some text", None, "s", 1), (None, "more text", "en", "s", 1)]
    assert [tuple(r)[2:] for r in langid.report(frame(spark, data), PIECES).collect()] == [("und", 0.0)] * 2
    assert langid.report(frame(spark, []), PIECES).count() == 0
