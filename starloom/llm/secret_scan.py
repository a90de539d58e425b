"""Secret scan through layers of encoding.

The text itself is scanned first. Then a worklist unwraps what it holds: percent-encoded and Unicode-escaped lines and
base64 tokens (also of compressed bytes) become layers of their own, are scanned with the same patterns and unwrapped
again, until nothing new turns up. Escapes inside escapes (``%2525...``, also of several kinds, or with escaped digits) are
unwrapped a layer at a time ``LITERAL`` times; what is nested deeper is followed to its end in one pass, character by
character, so that depth costs nothing and has no limit. A layer whose text was seen before at the same place isn't queued again, so encodings
that decode to each other or to themselves end, while an equal token elsewhere is a layer again. Every layer knows for each of its characters which characters of the original text it
came from; a finding is reported at that place.

One pass over the documents, no shuffle. Edge cases: a null text counts as empty; very long texts are scanned whole;
repeated rows and null ids get their own rows; an empty table gives an empty result. Archives are unpacked member after
member and scanned in overlapping chunks, so memory doesn't grow with what they hold. Unpacking of one document stops
after ``MAX_UNPACKED`` bytes in total, the guard against archives that unpack without end; then, or if a chunk's border
may cut something longer than the overlap, the row's ``truncated`` is true.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
KEYWORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
MAX_UNPACKED = 4_000_000_000
#: So many layers of escapes are scanned one by one.
LITERAL = 3
PIECE, CHUNK, OVERLAP = 1 << 20, 64_000_000, 1 << 20

URL = re.compile(r"%[0-9A-Fa-f]{2}")
UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: An end of line, perhaps written as an escape, with what quoting, comments and source code put around it.
BREAK = re.compile(r"""["',;]?[ \t\\]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t>#*|"']*""")
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{BREAK.pattern}[A-Za-z0-9+/_-]++)+={{0,2}}")
#: What can hold a secret among bytes that are no text as a whole; the shortest secret has 16 characters, and no
#: encoding of one has fewer.
READABLE = re.compile(
    rb"(?:[\t-\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){16,}")
CONTROL = bytes([*range(9), *range(14, 32), 127])
#: Bytes that may be part of one long token or pattern.
UNBROKEN = re.compile(rb"[A-Za-z0-9+/_=\s-]*")
PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\0")


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches that are long enough."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A decoded text; character i came from characters ``start[i]`` to ``end[i]`` - 1 of the original text."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None, escapes: int = 0):
        self.text, self.start, self.end, self.escapes = text, start, end, escapes

    def place(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a:b].min()), int(self.end[a:b].max()))

    def child(self, text: str, a: np.ndarray, b: np.ndarray, escapes: int = 0) -> Layer:
        """A layer whose character i was made of this layer's characters a[i] to b[i] - 1, ``escapes`` more deep in escapes."""
        if self.start is not None:
            a, b = self.start[a], self.end[b - 1]
        return Layer(text, a, b, self.escapes + escapes)

    def mark(self) -> bytes:
        """Equal for layers of the same text made of the same characters of the original."""
        own = hashlib.sha1(self.text.encode("utf-8", "replace"))
        for place in (self.start, self.end):
            if place is not None:  # one number for all characters is hashed once
                own.update((place if place.strides[0] else place[:1]).astype("<i8").tobytes())
        return own.digest()


def _lines(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """The lines in which the pattern occurs."""
    at = 0
    while m := pattern.search(text, at):
        a = text.rfind("\n", 0, m.start()) + 1
        b = text.find("\n", m.end())
        b = len(text) if b < 0 else b
        yield a, b
        at = b


def _spliced(layer: Layer, a: int, b: int, pattern: re.Pattern, decode) -> Layer | None:
    """The part a..b of the layer with each match (or run of matches) replaced by what it decodes to."""
    chars, lo, hi, at = [], [], [], a
    for m in pattern.finditer(layer.text, a, b):
        new = decode(m)
        if new is None:
            continue
        for text, s, e, each in ((layer.text[at:m.start()], at, m.start(), True), (new, m.start(), m.end(), False)):
            chars.append(text)
            lo.append(np.arange(s, e) if each else np.full(len(text), s))
            hi.append(np.arange(s + 1, e + 1) if each else np.full(len(text), e))
        at = m.end()
    if not chars:
        return None
    chars.append(layer.text[at:b])
    lo.append(np.arange(at, b))
    hi.append(np.arange(at + 1, b + 1))
    return layer.child("".join(chars), np.concatenate(lo), np.concatenate(hi), 1)


def _percent(m: re.Match) -> str | None:
    try:
        return bytes.fromhex(m[0].replace("%", "")).decode()
    except UnicodeDecodeError:
        return None


def _escape(m: re.Match) -> str | None:
    n = int(m[4]) if m[4] else int(m[1] or m[2] or m[3], 16)
    return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else None


def _settled(layer: Layer, a: int, b: int) -> Layer | None:
    """The part a..b of the layer with all escapes of ASCII characters followed to their end: every character read, or
    made by an escape, may complete another escape with those before it. Each step takes characters away, so the time is
    in proportion to the length. (Escapes of other characters can't nest; they are left to ``_spliced``.)"""
    chars: list[str] = []
    lo: list[int] = []
    hi: list[int] = []
    changed = False
    for i, c in enumerate(layer.text[a:b], a):
        start, end = i, i + 1
        while True:
            chars.append(c)
            lo.append(start)
            hi.append(end)
            m = _tail(chars)
            code = _code(m) if m else None
            if code is None or code > 127:
                break
            n, c, changed = len(m[0]), chr(code), True
            start, end = lo[-n], hi[-1]
            del chars[-n:], lo[-n:], hi[-n:]
    return layer.child("".join(chars), np.array(lo), np.array(hi), 1) if changed else None


#: An escape at the end of a text, and the characters an escape can end with.
ENDING = re.compile(r"(?:%([0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});)\Z")
_LAST = frozenset("0123456789abcdefABCDEF;")


ESCAPE = re.compile(f"{URL.pattern}|{UNICODE.pattern}")


def _tail(chars: list[str]) -> re.Match | None:
    return ENDING.search("".join(chars[-10:])) if chars[-1] in _LAST else None


def _code(m: re.Match) -> int:
    return int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)


URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")


def _stream(data: bytes):
    """A decompressor for the gzip, zlib, bzip2 or xz stream that the bytes begin with; None if there is none."""
    if data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and int.from_bytes(data[:2]) % 31 == 0):
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\0" else None


class Members:
    """The content, in pieces, of the streams that come one after the other from ``first`` on in ``data``; ``end`` is
    where the last one ended, ``cut`` whether the data ended before it."""

    def __init__(self, data: bytes, first: int):
        self.data, self.end, self.cut = data, first, False

    def __iter__(self) -> Iterator[bytes]:
        while (stream := _stream(self.data[self.end:self.end + 6])) is not None:
            at, rest = self.end, b""
            try:
                while not stream.eof:
                    if not rest and getattr(stream, "needs_input", True):
                        rest = self.data[at:at + PIECE]
                        at += len(rest)
                    given = len(rest)
                    out = stream.decompress(rest, PIECE)
                    rest = getattr(stream, "unconsumed_tail", b"")
                    if out:
                        yield out
                    elif not given:
                        self.cut, self.end = True, len(self.data)
                        return
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return  # damaged: what came before it was given
            self.end = at - len(stream.unused_data)


def _as_text(data: bytes) -> str | None:
    """The text, if the bytes look like one: UTF-8, hardly any control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = len(data) - len(data.translate(None, CONTROL))
    return text if text and odd * 20 <= len(text) else None


def _could_be_base64(t: str) -> bool:
    """Encoded text mixes cases or digits; a lower-case, upper-case or capitalised word isn't taken for it."""
    return not (t.isalpha() and (t[1:].islower() or t.isupper()))


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Base64 wrapped over lines: the spans of its lines' characters."""
    for m in WRAPPED.finditer(text):
        spans, at = [], m.start()
        for x in BREAK.finditer(text, *m.span()):
            spans.append((at, x.start()))
            at = x.end()
        spans.append((at, m.end()))
        own: list[tuple[int, int]] = []
        for a, b in [*spans, (0, 0)]:
            alone = b - a >= 16 and _complete(_decoded(text[a:b].rstrip("=").replace("-", "+").replace("_", "/")))
            if alone or a == b:  # a line that is an archive by itself isn't part of its neighbours' token
                if len(own) > 1 and any(y - x >= 16 for x, y in own):
                    yield own
                own = []
            else:
                own.append((a, b))


def _decoded(body: str) -> bytes:
    body = body[:len(body) - 1] if len(body) % 4 == 1 else body
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _placed(layer: Layer, text: str, first: int, at: np.ndarray) -> Layer:
    """A layer of bytes from number ``first`` on, decoded from the characters ``at``: three bytes come from four."""
    sizes = np.ones(len(text), np.int64) if text.isascii() else np.fromiter(
        (len(c.encode()) for c in text), dtype=np.int64, count=len(text))
    last = first + np.cumsum(sizes)
    return layer.child(text, at[(last - sizes) * 4 // 3], at[np.minimum(-(-last * 4 // 3), len(at)) - 1] + 1)


def _complete(data: bytes) -> bool:
    """Whether the bytes are archives one after the other and nothing else (not told of those that ``MAX_UNPACKED`` stops)."""
    if not PACKED.match(data):
        return False
    members, limit = Members(data, 0), MAX_UNPACKED
    for piece in members:
        limit -= len(piece)
        if limit < 0:
            return False
    return members.end == len(data) and not members.cut


class Unwrapper:
    """The worklist of one document."""

    def __init__(self, text: str):
        self.queue = [Layer(text)]
        self.seen = {self.queue[0].mark()}
        self.budget, self.truncated = MAX_UNPACKED, False
        self.layers = 0

    def push(self, layer: Layer | None) -> None:
        if layer is None or not layer.text:
            return
        mark = layer.mark()
        if mark not in self.seen:
            self.seen.add(mark)
            self.queue.append(layer)

    def unwrap(self, layer: Layer) -> None:
        text = layer.text
        done: list[tuple[int, int]] = []  # lines followed to their end
        if layer.escapes >= LITERAL:
            for a, b in _lines(text, ESCAPE):
                settled = _settled(layer, a, b)
                if settled is not None:
                    self.push(settled)
                    done.append((a, b))
        for present, pattern, run, decode in (("%" in text, URL, URL_RUN, _percent),
                                              ("\\" in text or "&#" in text, UNICODE, UNICODE, _escape)):
            own = set(done)
            for a, b in _lines(text, pattern) if present else ():
                if (a, b) not in own:
                    self.push(_spliced(layer, a, b, run, decode))
        whole = 0  # the end of the last run of lines that decoded as one token
        runs = _runs(text) if BASE64.search(text) else iter(())
        run = next(runs, None)
        for m in BASE64.finditer(text):
            while run and run[0][0] < m.end():
                if self.base64_layers(layer, run):
                    whole = run[-1][1]
                run = next(runs, None)
            if m.start() >= whole and _could_be_base64(m[0]):
                self.base64_layers(layer, [m.span()])

    def base64_layers(self, layer: Layer, spans: list[tuple[int, int]]) -> bool:
        """Push what a token (the spans, joined) decodes to; whether it decodes as a whole. If it doesn't, it has other
        characters before or after it, so the readable parts and archives at each of the four alignments are pushed."""
        body = "".join(layer.text[a:b] for a, b in spans).rstrip("=").replace("-", "+").replace("_", "/")
        at = np.concatenate([np.arange(a, b) for a, b in spans])[:len(body)]
        for k in range(4):
            data = _decoded(body[k:])
            if k == 0:
                text = _as_text(data)
                if text:
                    self.push(_placed(layer, text, 0, at))
                if text and not PACKED.match(data):
                    return True
                if not text and PACKED.match(data) and _complete(data):
                    self.queue.append(self.archives(layer, data, at))
                    return True
            if k or not text:
                for m in READABLE.finditer(data):
                    self.push(_placed(layer, m[0].decode(), m.start(), at[k:]))
            if PACKED.search(data):
                self.queue.append(self.archives(layer, data, at[k:]))
        return False

    def archives(self, layer: Layer, data: bytes, at: np.ndarray | None) -> Iterator[None]:
        """Push what the archives in the bytes hold, a chunk a step. ``at``: the layer's characters that the bytes were
        decoded from; None: all of the bytes come from the layer's one place."""
        first = 0
        while m := PACKED.search(data, first):
            members = Members(data, m.start())
            buffer, fresh = bytearray(), False
            for piece in members:
                self.budget -= len(piece)
                buffer += piece
                fresh = True
                if len(buffer) >= CHUNK:
                    self.chunk(layer, bytes(buffer), m.start(), len(data), at)
                    yield
                    buffer, fresh = buffer[-OVERLAP:], False
                    # a token or an archive inside that is longer than the overlap may have been cut
                    self.truncated |= UNBROKEN.fullmatch(buffer) is not None or _as_text(bytes(buffer)) is None
                if self.budget <= 0:
                    self.truncated = True
                    return
            if fresh:
                self.chunk(layer, bytes(buffer), m.start(), members.end if members.end > m.start() else len(data), at)
                yield
            first = max(m.start() + 1, members.end)

    def chunk(self, layer: Layer, data: bytes, first: int, end: int, at: np.ndarray | None) -> None:
        """Push the text of unpacked bytes, which come from the bytes ``first`` to ``end`` - 1."""
        if at is None:
            a, b = layer.place(0, 1)
        else:
            a, b = layer.place(int(at[first * 4 // 3]), int(at[min(-(-end * 4 // 3), len(at)) - 1]) + 1)
        mark = hashlib.sha1(data + b"%d %d" % (a, b)).digest()
        if mark in self.seen:
            return
        self.seen.add(mark)
        text = _as_text(data) or "\n\n".join(m[0].decode() for m in READABLE.finditer(data))
        own = Layer(text or "-", np.broadcast_to(np.int64(a), len(text) or 1), np.broadcast_to(np.int64(b), len(text) or 1))
        if text:
            self.push(own)
        if PACKED.search(data):
            self.queue.append(self.archives(own, data, None))

    def run(self) -> list[tuple[str, int, int]]:
        found = []
        while self.queue:
            layer = self.queue.pop()
            if not isinstance(layer, Layer):  # an archive: its next chunk, and then what that holds
                under = len(self.queue)
                if next(layer, self) is not self:
                    self.queue.insert(under, layer)
                continue
            if self.layers:
                found += [(k, *layer.place(a, b)) for k, a, b in scan(layer.text)]
            self.layers += 1
            self.unwrap(layer)
        return found


def examined(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, bool]:
    """(spans in the text itself, spans of secrets inside its layers, number of layers, truncated). A layer's finding that lies
    within one of the same kind already found isn't repeated."""
    base = scan(text)
    work = Unwrapper(text)
    kept: list[tuple[str, int, int]] = []
    reach: dict[str, int] = {}  # the furthest end, by kind, of the spans that begin here or before
    spans = {(a, -b, k, True) for k, a, b in work.run()} | {(a, -b, k, False) for k, a, b in base}
    for a, end, k, layered in sorted(spans):
        if layered and -end > reach.get(k, -1):
            kept.append((k, a, -end))
        reach[k] = max(reach.get(k, -1), -end)
    return base, kept, work.layers - 1, work.truncated


def findings(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    return examined(text)[:3]


def joined(spans: list[tuple[str, int, int]], kinds=KINDS) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex (in the text itself), base_sha256, spans (all), n_layers,
    truncated."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_layers", "truncated"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(1):
                base, more, layers, truncated = examined(cell.as_py() or "")
                rows.append((*(sum(k == s[0] for s in base) for k in KINDS),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), layers, truncated))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return map_arrow(
        docs.select("doc_id", F.col("text").cast("string")), run,
        f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, "
        "truncated boolean")
