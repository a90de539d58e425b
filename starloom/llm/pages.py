"""Main text of web pages by removal of site templates.

1. Every page is parsed into a tree, tolerant of missing and misplaced tags. Each element's subtree gets a hash of its tags
   and text.
2. Spark counts, per host, on how many pages with different main text a subtree stands. Subtrees on many pages of a host are
   its template: menus, notices, share bars, whatever their markup. In pages that mark their article or main part, where
   only its inside is read, a passage that many articles quote is no template, so more is asked there (``ARTICLE``) than in
   pages without such a mark (``BODY``): so many pages, and so many percent of the host's.
3. Template subtrees are deleted, as is what its own markup says is no main text (``nav``, ``footer``, ``form``, ``script``;
   classes such as ``cookie-notice``). What is left of the article, or else of the page's body, is read out block by block.

Scale: copies of a page on a host count once, and all counts are of (host, subtree, text) triples spread by all three, with
partial sums before the last shuffle. A page gets back the list of its own template subtrees, by an equi join on (host,
subtree) with the frequent side salted ``SALT`` times, so that a menu on a third of all pages is no single task's. No host's
subtrees are ever gathered. Pages cross the network once, to meet their lists, unless those are few.

Edge cases: null html is empty (text ''); a null ``url`` has the empty host; repeated rows get a row each, with equal texts; a null
``page_id`` is kept; markup cut off in the middle, unclosed elements and elements nested 100,000 deep are read to the end in linear
time; an unclosed comment, script or tag reaches to the end of the page, as in browsers; an empty table gives an empty result;
other columns are ignored. An element that holds the article, and the article itself, is never deleted.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow
from starloom.sources.store import materialize

#: A template subtree stands on so many pages of a host, and on so many percent of them.
ARTICLE, BODY = (20, 75), (5, 50)
SALT = 16

# Fixed values of HTML: elements without content, with raw content, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section
select summary table tbody td tfoot th thead title tr ul""".split())
#: An opening tag closes an open one of these, unless one of the elements on the right stands between them.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)), "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("optgroup", "option"), ("select",)),
}
#: A block closes an open paragraph.
ENDS_P = BLOCK - frozenset("br caption dd dt html head body title option td th tr tbody thead tfoot".split())
#: Elements that are no main text whatever they hold.
OFF = frozenset("""head script style noscript template nav footer aside form button select textarea input iframe object embed applet
svg math canvas audio video map menu dialog noembed noframes frameset search fieldset title datalist""".split())
#: Words in a class, an id or a role that say the same.
OFF_WORDS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored promo promotion promos
nav navbar navigation navi menu menus menubar submenu topbar toolbar breadcrumb breadcrumbs pagination pager paging sidebar sidebars
aside complementary footer foot contentinfo masthead banner skyscraper cookie cookies consent gdpr notice notices notification popup modal
overlay lightbox interstitial paywall comment comments commentlist disqus respond reply replies discussion feedback share sharing shares
social follow related recommended recommendations teaser teasers outbrain taboola newsletter subscribe subscription signup login search
searchbox widget widgets skip copyright legal disclaimer tagcloud tags hidden""".split())
#: A class that begins with one of these says something else.
_ABOUT = frozenset("no non not has have with without is".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][^\s=/>"']*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


def _says_off(attributes: str) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id", "role"):
            for one in value.split():
                words = [w.lower() for w in _WORD.findall(one)]
                if words and words[0] not in _ABOUT and not OFF_WORDS.isdisjoint(words):
                    return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            return True
    return False


def _says_main(attributes: str) -> bool:
    return any(m.group(1).lower() in ("role", "itemprop") and (m.group(2) or m.group(3) or m.group(4) or "").lower() in ("main", "articlebody")
               for m in _ATTRIBUTE.finditer(attributes))


class Page:
    """A page as a tree in arrays, nodes in page order: ``tag``, ``parent``, ``off`` (no main text by its own markup), ``main`` (marked as
    the main part) and ``hash`` (64 bits of the subtree's tags and text; 0 if it holds no text). ``parts`` has the runs of text as
    (node, text), and (node, None) where a block begins or ends. Node 0 is the page."""

    def __init__(self, source: str):
        self.tag, self.parent, self.off, self.main, self.hash = ["#"], [-1], [False], [False], [0]
        self.parts: list[tuple[int, str | None]] = []
        self._open, self._at = [0], {"#": [0]}  # open nodes, and for each tag their depths
        self._held: list[list[bytes] | None] = [[]]
        self._read(source)
        while self._open:
            self._pop()
        self._choose()

    # -------------------------------------------------------------------------------------------- building
    def _push(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.parts.append((self._open[-1], None))
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.off.append(tag not in ("html", "body") and (tag in OFF or bool(attributes) and _says_off(attributes)))
        self.main.append(tag in ("article", "main") or bool(attributes) and _says_main(attributes))
        self.hash.append(0)
        self._held.append([])
        self._at.setdefault(tag, []).append(len(self._open))
        self._open.append(len(self.tag) - 1)

    def _pop(self) -> None:
        node = self._open.pop()
        tag, held = self.tag[node], self._held[node]
        self._at[tag].pop()
        self._held[node] = None
        if held:
            h = blake2b(tag.encode("utf-8", "surrogatepass") + b"\x01" + b"\x00".join(held), digest_size=8).digest()
            self.hash[node] = int.from_bytes(h, "little", signed=True) or 1
            if node:
                self._held[self.parent[node]].append(b"\x02" + h)
        if tag in BLOCK:
            self.parts.append((self.parent[node], None))

    def _text(self, text: str) -> None:
        node = self._open[-1]
        self.parts.append((node, text))
        plain = " ".join(text.split())
        if plain:
            self._held[node].append(plain.encode("utf-8", "surrogatepass"))

    def _depth(self, names: tuple[str, ...] | frozenset) -> int:
        """The depth of the innermost open element of these names, or 0."""
        return max((at[-1] for n in names if (at := self._at.get(n))), default=0)

    def _close(self, names: tuple[str, ...], walls: tuple[str, ...]) -> None:
        """Close the outermost open element of these names inside the walls, with all it holds."""
        wall, found = self._depth(walls), 0
        for n in names:
            at = self._at.get(n, [])
            i = bisect_right(at, wall)
            if i < len(at):
                found = min(found or at[i], at[i])
        while found and len(self._open) > found:
            self._pop()

    def _end(self, name: str) -> None:
        at = self._at.get(name)
        if name == "br":
            self._push("br", "")
            self._pop()
        elif at and (name in BLOCK or at[-1] > self._depth(BLOCK)):  # an inline end tag doesn't close a block
            while len(self._open) > at[-1] + 1:
                self._pop()
            self._pop()

    def _read(self, s: str) -> None:
        at = 0
        while True:
            lt = s.find("<", at)
            text = s[at:lt] if lt >= 0 else s[at:]
            if text:
                self._text(html.unescape(text))
            if lt < 0:
                return
            after = s[lt + 1:lt + 2]
            named = s[lt + 2:lt + 3] if after == "/" else after
            if after in ("!", "?") or (after == "/" and not (named.isascii() and named.isalpha())):  # comments and the like
                comment = s.startswith("<!--", lt) and not s.startswith(("<!-->", "<!--->"), lt)
                end = s.find("-->", lt + 4) if comment else s.find(">", lt)
                if end < 0:
                    return
                at = end + (3 if comment else 1)
            elif not (named.isascii() and named.isalpha()):
                self._text("<")
                at = lt + 1
            else:
                m = _TAG.match(s, lt)
                if m is None:
                    return  # the page's end cuts the tag off
                at, name = m.end(), m.group(2).lower()
                if m.group(1):
                    self._end(name)
                    continue
                if name in ENDS_P and self._at.get("p"):
                    self._close(("p",), ("table", "button", "object"))
                if name in CLOSES:
                    self._close(*CLOSES[name])
                self._push(name, m.group(3))
                if name in VOID:
                    self._pop()
                elif name in RAW:
                    end = _RAW_END[name].search(s, at)
                    self._pop()
                    close = s.find(">", end.end()) if end else -1
                    if close < 0:
                        return
                    at = close + 1

    # -------------------------------------------------------------------------------------------- reading
    def _choose(self) -> None:
        """``roots``: the nodes whose inside is read; ``marked``: whether they are marked as the main part; ``gone``: what isn't read
        of them by its own markup."""
        n, parent = len(self.tag), self.parent
        under = [False] * n  # in something that is off
        for i in range(1, n):
            under[i] = self.off[i] or under[parent[i]]
        articles = [i for i in range(n) if self.tag[i] == "article" and not self.off[i]]
        found = ([i for i in articles if not under[i]] or [i for i in range(n) if self.main[i] and not under[i]] or articles
                 or [i for i in range(n) if self.main[i] and not self.off[i]])
        inside, roots = [False] * n, set(found)
        for i in range(1, n):
            inside[i] = inside[parent[i]] or parent[i] in roots
        tops = [i for i in found if not inside[i]]
        holder = list(range(n))  # the root that a node is in, else the page
        for i in range(1, n):
            holder[i] = i if i in roots and not inside[i] else holder[parent[i]]
        titled = {holder[i] for i in range(n) if self.tag[i] == "h1"}
        self.marked = bool(tops)
        self.roots = frozenset([i for i in tops if i in titled] or tops or [0])
        self._settle(under_forms=False)
        if not self.marked and not any(not self.gone[i] and t and not t.isspace() for i, t in self.parts):
            self._settle(under_forms=True)

    def _settle(self, under_forms: bool) -> None:
        n, parent = len(self.tag), self.parent
        self.gone = [True] * n
        heads = [0] * n  # 1 in a header, 2 in a heading of it
        for i in range(n):
            if i in self.roots:
                self.gone[i] = False
                continue
            p = parent[i]
            if p < 0 or self.gone[p] and heads[p] != 1:
                continue
            off = self.off[i] and not (under_forms and self.tag[i] in ("form", "fieldset"))
            if self.tag[i] == "header" or (heads[p] == 1 and self.tag[i] not in _HEADINGS):
                heads[i], off = 1 if self.marked and not off else 0, True  # of an article's header its headings stay
            self.gone[i] = off

    def subtrees(self) -> set[int]:
        """The hashes of the subtrees that are read and hold text, without the roots."""
        return {h for i, h in enumerate(self.hash) if h and not self.gone[i] and i not in self.roots and self.tag[i] not in ("html", "body")}

    def text(self, template: frozenset[int] = frozenset()) -> str:
        """The main text, without the subtrees whose hash is in ``template``."""
        gone = self.gone
        if template:
            gone = list(gone)
            for i, h in enumerate(self.hash):
                if i and not gone[i] and i not in self.roots:
                    out = h in template and self.tag[i] not in ("html", "body")
                    gone[i] = out or (gone[self.parent[i]] and not self.gone[self.parent[i]])
        blocks, now = [], []
        for node, text in [*self.parts, (0, None)]:
            if text is None:
                if now:
                    blocks.append(" ".join("".join(now).split()))
                    now = []
            elif not gone[node]:
                now.append(text)
        return " ".join(b for b in blocks if b)

    def identity(self) -> int:
        """64 bits of the main text, by which copies of a page count once."""
        return int.from_bytes(blake2b(self.text().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host() -> Column:
    """The host of ``url`` in small letters, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def _keyed(pages: DataFrame) -> DataFrame:
    source = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", "url", F.xxhash64(host()).alias("site"), F.xxhash64(source).alias("k1"),
                        F.xxhash64(F.lit(1), source).alias("k2"), source.alias("html"))


def subtrees(keyed: DataFrame) -> DataFrame:
    """(site, k1, k2, marked, body, subtree): the subtrees that each page's main text is made of."""
    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for site, k1, k2, source in zip(*(b.column(c).to_pylist() for c in ("site", "k1", "k2", "html")), strict=True):
                page = Page(source)
                body = page.identity()
                out += [(site, k1, k2, page.marked, body, h) for h in page.subtrees()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                                 names=["site", "k1", "k2", "marked", "body", "subtree"])

    return map_arrow(keyed.select("site", "k1", "k2", "html"), run, "site long, k1 long, k2 long, marked boolean, body long, subtree long")


def templates(found: DataFrame, article: tuple[int, int] = ARTICLE, body: tuple[int, int] = BODY) -> DataFrame:
    """(site, subtree, everywhere): the subtrees on many pages of a site; ``everywhere`` also goes for marked articles."""
    texts = found.select("site", "body").distinct().groupBy("site").agg(F.count("*").alias("pages"))
    n = found.select("site", "subtree", "body").distinct().groupBy("site", "subtree").agg(F.count("*").alias("n"))
    enough = lambda limit: (F.col("n") >= limit[0]) & (F.col("n") * 100 >= limit[1] * F.col("pages"))
    rows = n.filter(F.col("n") >= min(article[0], body[0])).join(texts, "site")
    return rows.filter(enough(article) | enough(body)).select("site", "subtree", enough(article).alias("everywhere"), enough(body).alias("open"))


def deletions(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """(site, k1, k2, template): the template subtrees of each page that has some."""
    salted = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = found.withColumn("salt", F.pmod(F.col("k1"), F.lit(SALT)).cast("int")).join(salted, ["site", "subtree", "salt"])
    rows = rows.filter((F.col("marked") & F.col("everywhere")) | (~F.col("marked") & F.col("open")))
    return rows.groupBy("site", "k1", "k2").agg(F.collect_set("subtree").alias("template"))


def extracted(pages: DataFrame, article: tuple[int, int] = ARTICLE, body: tuple[int, int] = BODY) -> DataFrame:
    """(page_id, url, text) of every page."""
    keyed = _keyed(pages)
    found = materialize(subtrees(keyed))
    # written first: by its size Spark decides whether the pages must be shuffled to meet their lists
    lists = materialize(deletions(found, templates(found, article, body)))
    rows = keyed.join(lists, ["site", "k1", "k2"], "left").select("page_id", "url", "html", "template")

    def run(batches):
        for b in batches:
            texts = [Page(source).text(frozenset(t or ())).encode("utf-8", "replace")
                     for source, t in zip(b.column("html").to_pylist(), b.column("template").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return map_arrow(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return extracted(pages).withColumn("n_chars", F.length("text").cast("long"))
