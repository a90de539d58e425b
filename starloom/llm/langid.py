"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word is a string of pieces, cut in any
way the vocabulary allows; its probability is the sum over all its segmentations, computed by the forward algorithm. A
text scores the product over its words (runs of letters and their combining marks, lower-cased, with a mark for the word's
beginning; digits and signs such as Roman numerals or fractions of their own are no letters) and the share of the language's documents. The highest score wins; ``score`` is its share of all languages' scores.

Learning: expectation maximisation. Words of a bounded sample of the labelled training documents (about ``FIT_DOCS`` a
language, by hash of the id) are counted per language by Spark; each round computes expected piece counts by
forward-backward in the tasks, sums them, and brings one number per piece and language to the driver. Shares of
documents are counted over all training documents. The language, source and id of a document play no part in its
prediction.

All words of a slice of documents are scored together: equal words once, all of one length class side by side, the
forward sums advancing one character at a time in numpy. Workers remember scores of words already seen.

Edge cases: a null text, or one without letters, is ``und`` with score 0; without any labelled training document all
are; a null id is never learned from and not held out; repeated rows count as often as they occur; very long texts are
scored whole and teach whole (sums are rescaled, so they can't underflow; learning takes memory in proportion to the longest
word of the sample); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, slices
from starloom.sources.store import materialize

VOCABULARY = "piece_bpe_32k.model"
FIT_DOCS, ROUNDS = 3000, 3
SMOOTHING, UNKNOWN = 0.05, 1e-8
MARK = "▁"
#: A letter (of any script), and the letters and combining marks that follow; digits and number-like signs are none.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
SLICE_CHARS, REMEMBERED = 4_000_000, 400_000

U = np.uint64


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


# ------------------------------------------------------------------------------------------------ pieces
def _mixed(cp: np.ndarray) -> np.ndarray:
    x = (cp.astype(U) + U(0x9E3779B97F4A7C15)) * U(0xBF58476D1CE4E5B9)
    return (x ^ (x >> U(29))) * U(0x94D049BB133111EB)


def _factor(i: int) -> np.uint64:
    return U(pow(0xD1342543DE82EF95, i + 1, 2**64))


class Pieces:
    """The vocabulary's pieces of letters and marks, the longest of ``longest`` characters, found by hash. Number ``n`` (one
    more than the last piece) stands for a single character that is no piece, ``n + 1`` for no piece at all."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(i) for i in range(model.get_piece_size())}
        self.names = sorted(p for p in names if regex.fullmatch(rf"{MARK}?[\p{{L}}\p{{M}}]+", p) and p == p.lower()) + [MARK]
        self.n, self.longest = len(self.names), max(map(len, self.names))
        keys = np.array([self.key(p) for p in self.names], dtype=U)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(keys >> U(44)).astype(np.int64)] = True

    @staticmethod
    def key(piece: str) -> int:
        x = _mixed(np.frombuffer(piece.encode("utf-32-le"), dtype="<u4"))
        return int((x * np.array([_factor(i) for i in range(len(x))], dtype=U)).sum(dtype=U))

    def at(self, chars: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """For words as rows of characters: per piece length l, an array (word, start) of piece numbers."""
        mixed, out = _mixed(chars), []
        h = np.zeros(chars.shape, dtype=U)
        width = chars.shape[1]
        for step in range(min(self.longest, width)):
            h = h[:, :width - step] + mixed[:, step:] * _factor(step)
            inside = np.arange(width - step) + step < length[:, None]
            ids = np.full(h.shape, self.n + 1, dtype=np.int32)
            r, c = np.nonzero(self.maybe[(h >> U(44)).astype(np.int64)] & inside)
            found = h[r, c]
            i = np.minimum(np.searchsorted(self.keys, found), self.n - 1)
            hit = self.keys[i] == found
            ids[r[hit], c[hit]] = self.order[i[hit]]
            if step == 0:
                ids[inside & (ids > self.n)] = self.n
            out.append(ids)
        return out


def matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters (word, position), with the mark first, and lengths."""
    length = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    width = int(length.max())
    flat = "".join(MARK + w + "\0" * (width - len(w) - 1) for w in words)
    return np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), width), length


def classes(words: list[str], cells: int = 2_000_000) -> Iterator[np.ndarray]:
    """Indices of the words in groups of like length whose matrix stays small."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, cells // (int(length[order[at]]) + 2))
        own = order[at:at + n]
        own = own[length[own] <= max(8, 2 * length[own[0]] + 2)]
        yield own
        at += len(own)


def table(probabilities: np.ndarray) -> np.ndarray:
    """Rows for the two numbers beside the pieces: a single unknown character, and no piece."""
    k = probabilities.shape[1]
    return np.concatenate([probabilities, np.full((1, k), UNKNOWN), np.zeros((1, k))])


def _used(ids: list[np.ndarray], none: int) -> list[np.ndarray]:
    """For each piece length, the starts at which any word has a piece."""
    return [(x < none).any(axis=0) for x in ids]


def _eased(recent: list[np.ndarray], scale: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The recent sums, all that later ones depend on, divided by their largest, and the logarithm of what was divided by."""
    top = np.max(recent, axis=0)
    top = np.where(top > 0, top, 1.0)
    return [x / top for x in recent], scale + np.log(top)


def _forward(ids: list[np.ndarray], width: int, p: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(t, sums, log scale) after t characters: the summed probability of all segmentations of the first t."""
    n, k = len(ids[0]), p.shape[1]
    recent, used = [np.ones((n, k))], _used(ids, len(p) - 1)
    scale = np.zeros((n, k))
    for t in range(1, width + 1):
        now = np.zeros((n, k))
        for step in range(min(len(ids), t)):
            start = t - step - 1
            if start >= len(used[step]) or not used[step][start]:
                continue
            col = ids[step][:, start]
            on = np.flatnonzero(col <= len(p) - 2)
            now[on] += recent[-1 - step][on] * p[col[on]]
        recent.append(now)
        if len(recent) > len(ids):
            recent.pop(0)
        if t % 8 == 0:
            recent, scale = _eased(recent, scale)
        yield t, recent[-1], scale


def log_scores(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, (word, language)."""
    out = np.zeros((len(words), p.shape[1]))
    for own in classes(words):
        chars, length = matrix([words[i] for i in own])
        for t, sums, scale in _forward(pieces.at(chars, length), chars.shape[1], p):
            done = np.flatnonzero(length == t)
            if len(done):
                out[own[done]] = np.log(np.maximum(sums[done], 1e-300)) + scale[done]
    return out


def expected(words: list[str], counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, (piece, language), when word i occurs counts[i, language] times: forward
    and backward sums, in logarithms of their scale per word."""
    total = np.zeros((len(p), p.shape[1]))
    for own in classes(words):
        chars, length = matrix([words[i] for i in own])
        ids, width, n = pieces.at(chars, length), chars.shape[1], len(own)
        k, weight, used = p.shape[1], counts[own], _used(ids, len(p) - 1)
        alpha, up = np.ones((width + 1, n, k)), np.zeros((width + 1, n, k))
        for t, sums, scale in _forward(ids, width, p):
            alpha[t], up[t] = sums, scale
        # the same from the words' ends; a word begins to count where it ends
        recent, scale = [], np.zeros((n, k))
        beta, down = np.zeros((width + 1, n, k)), np.zeros((width + 1, n, k))
        for s in range(width, -1, -1):
            now = np.zeros((n, k))
            now[length == s] = 1
            for step in range(min(len(ids), width - s)):
                if used[step][s]:
                    col = ids[step][:, s]
                    on = np.flatnonzero(col <= len(p) - 2)
                    now[on] += recent[-1 - step][on] * p[col[on]]
            recent.append(now)
            if len(recent) > len(ids):
                recent.pop(0)
            beta[s], down[s] = now, scale
            if s % 8 == 0:
                recent, scale = _eased(recent, scale)
        z = np.log(np.maximum(beta[0], 1e-300)) + down[0]
        for s in range(width):
            for step in range(min(len(ids), width - s)):
                if used[step][s]:
                    col = ids[step][:, s]
                    on = np.flatnonzero(col <= len(p) - 2)
                    e = s + step + 1
                    share = alpha[s, on] * p[col[on]] * beta[e, on] * np.exp(up[s, on] + down[e, on] - z[on])
                    np.add.at(total, col[on], share * weight[on])
    return total[:pieces.n]


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


# ------------------------------------------------------------------------------------------------ learning
def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def training(docs: DataFrame) -> DataFrame:
    return docs.filter((remainder() != 1) & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string"))


def word_counts(sample: DataFrame) -> DataFrame:
    """(lang, word, n) of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counted.update((lang, w) for w in words_of(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counted], pa.string()), pa.array([k[1] for k in counted], pa.string()),
                 pa.array(counted.values(), pa.int64())], names=["lang", "word", "n"])

    rows = map_arrow(sample.filter("text is not null").select("lang", "text"), run, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """The languages, in code point order, the piece probabilities (piece, language) and the log shares."""

    def __init__(self, langs: list[str], probabilities: np.ndarray, prior: np.ndarray):
        self.langs, self.probabilities, self.prior = langs, probabilities, prior


def fit(docs: DataFrame, path: str, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model | None:
    """Learn from the training documents; None if there are none."""
    train = training(docs)
    shares = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return None
    langs = sorted(shares)
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("fit")), 1) / F.lit(float(2**63))
    chosen = F.lit(False)
    for lang in langs:
        chosen = chosen | ((F.col("lang") == lang) & (place < fit_docs / shares[lang]))
    counts = materialize(word_counts(train.filter(chosen)))
    n = pieces_of(path).n
    p = np.full((n, len(langs)), 1.0 / n)
    for _ in range(rounds):
        now = table(p)

        def expect(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            pieces = pieces_of(path)
            total = np.zeros((pieces.n, len(langs)))
            for rows in batches:
                words, inverse = np.unique(rows["word"].to_numpy(dtype=object), return_inverse=True)
                weight = np.zeros((len(words), len(langs)))
                np.add.at(weight, (inverse, rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()),
                          rows["n"].to_numpy(dtype=float))
                if len(words):
                    total += expected(list(words), weight, pieces, now)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": total[piece, lang]})

        sums = (counts.mapInPandas(expect, "piece int, lang int, uses double")
                .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).collect())
        uses = np.full((n, len(langs)), SMOOTHING)
        for r in sorted(sums):
            uses[r["piece"], r["lang"]] += r["uses"]
        p = uses / uses.sum(axis=0)
    prior = np.log(np.array([shares[x] for x in langs], dtype=float) / sum(shares.values()))
    return Model(langs, p, prior)


# ------------------------------------------------------------------------------------------------ prediction
class Scorer:
    """Scores texts with a model; remembers the scores of words."""

    def __init__(self, model: Model, pieces: Pieces):
        self.model, self.pieces, self.p = model, pieces, table(model.probabilities)
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, words
            self.scores = self.scores[:0]
        if new:
            start = len(self.known)
            self.known.update(zip(new, range(start, start + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, log_scores(new, self.pieces, self.p)])
        return self.scores[np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))]

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        each = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        codes, words = pd.factorize(np.array([w for own in each for w in own], dtype=object))
        total = np.tile(self.model.prior, (len(texts), 1))
        if len(words):
            np.add.at(total, np.repeat(np.arange(len(texts)), sizes), self.word_scores(list(words))[codes])
        best = total.argmax(axis=1)
        top = total[np.arange(len(texts)), best]
        share = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
        return ([self.model.langs[b] if n else "und" for b, n in zip(best, sizes, strict=True)],
                [float(s) if n else 0.0 for s, n in zip(share, sizes, strict=True)])


def report(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, pieces_of(path)) if model else None
        for batch in batches:
            langs, scores = [], []
            for texts in slices([t or "" for t in batch.column(2).to_pylist()], len, SLICE_CHARS):
                a, b = scorer(texts) if scorer else (["und"] * len(texts), [0.0] * len(texts))
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string"))
    return map_arrow(rows, run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
