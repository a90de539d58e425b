"""Personal data: fixed patterns, and a character-level BiLSTM-CRF trained on what they label.

The patterns find e-mail and IP addresses, card and phone numbers in every text; those spans always stay. Windows around
them (and around other digits, as counter-examples) with one tag per character are the labelled spans the model learns
from; variants such as numbers without a country code and written-out @ signs are added while training. The model then
tags every window of ``WIDTH`` characters that holds a digit, an @ sign or the word 'at' (or 'ät', in any case), by which an @ sign is
written out: ``plausible`` accepts no span without one of them (a test measures what decoding all windows would add).
Windows overlap by half and are decoded by Viterbi; a character that two windows tag gets the tag of the window in whose
middle it lies more, and equal neighbouring tags merge into spans over the whole text. A span is added if it overlaps
no span found by pattern, ends at word borders and has the form of its kind (digits, check sum, dots).

Scale: one pass collects labelled windows, of which at most ``PER_KIND`` a kind (by hash) go to the driver for training;
the model (some 40 KB) travels with the tasks of the second pass. No shuffle of texts.

Edge cases: a null or empty text has no spans; very long texts are scanned whole; without labelled windows (an empty
table, no digits) there is no model and the patterns' spans are all; repeated rows and null ids get rows of their own.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import crf
from starloom.llm.common import map_arrow, slices

KINDS = ("email", "ip", "card", "phone")
TAGS = "OEeIiCcPp"  # none, then the first and the further characters of each kind
WIDTH, STEP = 64, 32
#: Training: windows of each kind (and without any) at most, passes over them.
PER_KIND, EPOCHS = 120, 16

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: An @ sign written out, in the forms that ``plausible`` accepts, and a dot.
AT, DOT = r"\b(?:at|ät)\b", r"\b(?:dot|punkt)\b"
POSSIBLE = re.compile(rf"[0-9@]|{AT}", re.IGNORECASE)


# ------------------------------------------------------------------------------------------------ patterns
def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part is the whole run of its characters before an @ sign, back to the match before at most; found from
    the @ sign, a long run without one costs nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at) if a < at else None
        if m:
            end = m.end()
            yield a, end
        at = text.find("@", m.end() if m else at + 1)


def good_ip(s: str) -> bool:
    parts = [x.lstrip("0") or "0" for x in s.split(".")]
    return all(len(x) <= 3 and int(x) <= 255 for x in parts)


def good_card(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d)


def good_phone(s: str) -> bool:
    return 10 <= len(_digits(s)) <= 15


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The patterns' (kind, start, end), and the matches that failed their check."""
    good, bad = [("email", a, b) for a, b in emails(text)], []
    for kind, pattern, ok in (("ip", IP, good_ip), ("card", CARD, good_card), ("phone", PHONE, good_phone)):
        for m in pattern.finditer(text):
            (good if ok(m[0]) else bad).append((kind, *m.span()))
    return good, bad


def joined(spans: list[tuple[str, int, int]], kinds=KINDS) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


# ------------------------------------------------------------------------------------------------ windows
_IDS = np.full(0x110000, 98, dtype=np.int16)
_IDS[128:] = 97
_IDS[32:127] = np.arange(1, 96)
_IDS[10] = 96
_IDS[0] = 0
N_CHARS = 99


def char_ids(texts: list[str]) -> np.ndarray:
    """Windows as rows of character ids; shorter ones end with padding (0)."""
    flat = np.frombuffer("".join(t.ljust(WIDTH, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _IDS[flat].reshape(len(texts), WIDTH)


def window_starts(text: str) -> list[int]:
    """The starts, in steps of half a window, of the windows that can hold what a span needs (``POSSIBLE``)."""
    out: list[int] = []
    for m in POSSIBLE.finditer(text):
        own = m.start() // STEP * STEP
        for s in (own - STEP, own):
            if s >= 0 and (not out or s > out[-1]):
                out.append(s)
    return out


class Cover:
    """The union of spans; tells whether a stretch overlaps one."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(s[1:] for s in spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)  # the first that ends behind a
        return i < len(self.starts) and self.starts[i] < b


def tags_of(n: int, spans: list[tuple[str, int, int]]) -> list[str]:
    tags = ["O"] * n
    for kind, a, b in spans:
        first = TAGS[1 + 2 * KINDS.index(kind)]
        tags[a:b] = [first] + [first.lower()] * (b - a - 1)
    return tags


def labelled_windows(text: str) -> Iterator[tuple[str, str, str]]:
    """(kind, window, tags): a window around each span, its place in the window by a hash, and windows without a span
    (kind none)."""
    spans, _ = base_spans(text)
    spans.sort(key=lambda s: (s[1], s[0] != "phone"))
    apart, reach = [], 0  # the spans that overlap none before
    for s in spans:
        if s[1] >= reach:
            apart.append(s)
        reach = max(reach, s[2])
    starts, ends = [s[1] for s in apart], [s[2] for s in apart]
    for kind, a, b in apart:
        shift = int.from_bytes(hashlib.md5(text[a:b].encode("utf-8", "replace")).digest()[:2]) % max(1, WIDTH - min(WIDTH, b - a))
        s = max(0, a - shift)
        near = apart[bisect_right(ends, s):bisect_left(starts, s + WIDTH)]
        inside = [(k, max(x, s) - s, min(y, s + WIDTH) - s) for k, x, y in near]
        window = text[s:s + WIDTH]
        yield kind, window, "".join(tags_of(len(window), inside))
    covered = Cover(spans)
    for s in window_starts(text):
        if not covered.meets(s, s + WIDTH):
            window = text[s:s + WIDTH]
            yield "none", window, "O" * len(window)


def variants(window: str, tags: str) -> Iterator[tuple[str, str]]:
    """The window itself, and with its spans written in other ways."""
    yield window, tags
    pick = hashlib.md5(window.encode("utf-8", "replace")).digest()[0]
    sign = (" (at) ", " [at] ", " AT ", "(AT)")[pick % 4]
    for pattern, new in ((r"\+[0-9]+ ", ""), ("@", " at "), ("@", sign), (r"(?<=[0-9])-(?=[0-9])", "."),
                         (r"@|(?<=[A-Za-z])\.(?=[A-Za-z])", None)):
        w, t, at = "", "", 0
        written = new
        for m in re.finditer(pattern, window):
            if written is None:
                new = " at " if m[0] == "@" else " dot "
            tag = tags[m.start()]
            if tag == "O":
                continue
            w += window[at:m.start()] + new
            t += tags[at:m.start()] + tag.lower() * len(new)
            at = m.end()
            if not new and at < len(tags):  # the span begins after what was left out
                tags = tags[:at] + tag + tags[at + 1:]
        if at:
            yield (w + window[at:])[:WIDTH], (t + tags[at:])[:WIDTH]


def fit(rows: list[tuple[str, str]], epochs: int = EPOCHS) -> crf.Model | None:
    """A model trained on (window, tags) rows."""
    pairs = [p for w, t in rows for p in variants(w, t)]
    if not pairs:
        return None
    x = char_ids([w for w, _ in pairs])
    y = np.array([[TAGS.index(c) for c in t.ljust(WIDTH, "O")] for _, t in pairs])
    model = crf.new_model(N_CHARS, len(TAGS))
    # a tag inside a span never follows one of another kind
    for j in range(2, len(TAGS), 2):
        for i in range(len(TAGS)):
            if i not in (j, j - 1):
                model["A"][i, j] = -4
    crf.train(model, x, y, epochs, batch=64, rate=0.02)
    return model


# ------------------------------------------------------------------------------------------------ decoding
def reconciled(length: int, starts: list[int], tags: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of a text from its windows' tags: each character takes the tag of the window it is deepest in."""
    depth = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])
    best, deep = np.zeros(length + WIDTH, np.int8), np.full(length + WIDTH, -1)
    for s, row in zip(starts, tags, strict=True):
        deeper = depth > deep[s:s + WIDTH]
        best[s:s + WIDTH][deeper] = row[deeper]
        deep[s:s + WIDTH][deeper] = depth[deeper]
    out, at = [], np.flatnonzero(best[:length])
    for i in at.tolist():
        kind = KINDS[(best[i] - 1) // 2]
        if out and out[-1][0] == kind and out[-1][2] == i and best[i] % 2 == 0:
            out[-1] = (kind, out[-1][1], i + 1)
        else:
            out.append((kind, i, i + 1))
    return out


def plausible(kind: str, s: str) -> bool:
    if kind == "email":
        low = s.lower()
        return bool(re.search(f"@|{AT}", low) and re.search(rf"\.|{DOT}", low) and re.search(r"[^\W\d_]", re.sub(f"{AT}|{DOT}", "", low)))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", s)) and good_ip(s)
    if kind == "card":
        return good_card(s) and not re.search(r"[^0-9 .-]", s)
    return good_phone(s) and not re.search(r"[^0-9 ().+-]", s)


def added(text: str, spans: list[tuple[str, int, int]], base: list, failed: list) -> list[tuple[str, int, int]]:
    """Of the model's spans, those that may be added."""
    out, taken = [], Cover(base)
    spoilt = {kind: Cover([s for s in failed if s[0] == kind and (kind != "card" or s[2] - s[1] >= 14)]) for kind in KINDS}
    for kind, a, b in spans:
        while a < b and text[a] in " .,;:":
            a += 1
        while b > a and text[b - 1] in " .,;:":
            b -= 1
        free = not taken.meets(a, b) and not spoilt[kind].meets(a, b)
        border = not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())
        if b > a and free and border and plausible(kind, text[a:b]):
            out.append((kind, a, b))
    return out


def found_in(texts: list[str], model: crf.Model | None) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text; the windows of all texts are decoded together."""
    base = [base_spans(t) if t else ([], []) for t in texts]
    where = [(i, s) for i, t in enumerate(texts) if t and model is not None for s in window_starts(t)]
    tags = [crf.decode(model, char_ids([texts[i][s:s + WIDTH] for i, s in where[k:k + 256]]))
            for k in range(0, len(where), 256)]
    flat = np.concatenate(tags) if tags else np.empty((0, WIDTH), np.int8)
    bounds = np.searchsorted([i for i, _ in where], np.arange(len(texts) + 1)) if where else np.zeros(len(texts) + 1, int)
    out = []
    for i, t in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        more = added(t, reconciled(len(t), [s for _, s in where[a:b]], flat[a:b]), *base[i]) if b > a else []
        out.append((base[i][0], more))
    return out


# ------------------------------------------------------------------------------------------------ Spark
def _possible(docs: DataFrame) -> DataFrame:
    """The texts that hold what ``POSSIBLE`` finds (or a bit more: letters beyond ASCII don't join to 'at' here); the
    others, which can hold no span, are null."""
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.when(text.rlike("(?i)[0-9@]|(?<![A-Za-z0-9_])(?:a|ä|Ä)t(?![A-Za-z0-9_])"), text).alias("text"))


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """A bounded sample of labelled windows: at most ``PER_KIND`` of each kind, the smallest by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for t in batch.column(1) if t.is_valid for r in labelled_windows(t.as_py())]
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["kind", "window", "tags"])

    found = map_arrow(_possible(docs).filter("text is not null"), run, "kind string, window string, tags string")
    # first of every part of a kind, so that no task gets all map tasks' windows of a kind
    order = [F.xxhash64("window"), F.col("window"), F.col("tags")]
    parts = Window.partitionBy("kind", F.pmod(F.xxhash64("tags", "window"), F.lit(64))).orderBy(*order)
    rows = found.withColumn("n", F.row_number().over(parts)).filter(F.col("n") <= PER_KIND)
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("kind").orderBy(*order))).filter(F.col("n") <= PER_KIND)
    return sorted((r["window"], r["tags"]) for r in rows.collect())


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (by pattern), base_sha256, spans (all)."""
    model = fit(training_rows(docs))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for texts in slices(batch.column(1).to_pylist(), lambda t: len(t or ""), 4_000_000):
                for base, more in found_in(texts, model):
                    text = joined(base)
                    rows.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(text.encode()).hexdigest(),
                                 joined(base + more)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return map_arrow(_possible(docs), run, f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, "
                                           "base_sha256 string, spans string")
