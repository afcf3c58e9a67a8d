"""Operator 9: main text of web pages by removal of site templates.

A lenient tokenizer walks a page once with a stack (implied end tags, void
elements, raw text elements, unclosed tags).  Every block element gets a Merkle
hash of its tag, marks and content.  Pass 1 emits one row per distinct block
subtree of a page, keyed by host, subtree hash and page body; Spark counts the
distinct bodies of a host that hold it, so copies of one page count once (partial
aggregates, so a hot host is no hot task).  Subtrees in ``MIN_PAGES`` bodies and
in ``MIN_SHARE`` of the host's are its template; on a host of few bodies half of
them will do (``SMALL_SHARE``), two at least.  Pass 2 walks each page again
and deletes them, together with the elements whose tag, role or class says menu,
header, footer, sidebar, notice, advert, form, script, style or reader comments.
If an ``article`` or ``main`` is left, its text is the result, else all text that
is left.

Copies of an article are no template.  Subtrees inside or around an ``article``
or ``main`` are never deleted.  On other pages a subtree with over half of the
text (that of elements marked as no main text does not count) is content however
often it recurs, and what lies in it is deleted only if it is template without
the bodies that hold the copy.  Only a subtree in ``MOST`` of a host's bodies, next
to which the page keeps text of its own (``OWN`` of the subtree's), is template
at that size too.  An article in no element of its own, or with at most half of
the page's text, cannot be told from template and is judged by the counts alone.

The template keys are broadcast while they are at most ``MAX_SHARED`` (checked);
beyond that every page gets its own keys by a join on the page's hash.

Character references are decoded once, white space inside a block becomes one
space, blocks are trimmed and joined in page order by a blank line.

Defined results: null or empty html, or nothing but template: empty text, 0
characters; a url without a host counts as the host ''; rows with null or equal
ids each get their own result; repeated rows count as one page; extra columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.session import cut, settings

MIN_PAGES = 8
MIN_SHARE = 0.2
SMALL_SHARE = 0.5  # on hosts of under MIN_PAGES / SMALL_SHARE bodies
MOST, OWN = 0.8, 0.25
MAX_SHARED = 2_000_000  # keys of 25 bytes

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_COMMENT_END = re.compile("--!?>")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split())
# an opening tag of the key's set ends an open element of the key's name
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table article main body html div section".split())

DROP_TAGS = frozenset(
    "nav footer aside form script style noscript template svg iframe button select textarea dialog head title menu "
    "object canvas audio video math map".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DEPTH = 512  # open elements; deeper ones follow each other instead of nesting
DROP_NAMES = (
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe sidebar widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer masthead topbar comment comments disqus replies respond share "
    "sharing social related recommended toolbar pagination pager skip-link").split()
_DROP_WHOLE = frozenset(DROP_NAMES)
#: words that say where or how a part stands, not what it is
PLACE_NAMES = frozenset(
    "area article articles aside bar block body bottom box button buttons center col column container content desktop fixed "
    "floating form global group icons image inline inner item items left link links list local main middle mobile outer page "
    "panel post posts primary rail region right section secondary site slot sticky stories the thread top unit wrap wrapper"
    .split())


def _names_boilerplate(token: str) -> bool:
    """A class is a drop name, or drop names and words of place joined by - and _: ``site-footer``
    and ``ad_slot_2`` are, ``market-share`` and ``related-work`` are not."""
    if token in _DROP_WHOLE:
        return True
    parts = [p for p in re.split("[-_]+", token) if p and not p.isdigit()]
    return any(p in _DROP_WHOLE for p in parts) and all(p in _DROP_WHOLE or p in PLACE_NAMES for p in parts)


def _dropped(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether the element's tag, role or class marks it as no main text."""
    if tag in DROP_TAGS or (tag == "header" and not in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "role" and value in DROP_ROLES):
            return True
        if name in ("class", "id") and tag not in ("html", "body"):
            for token in value.split():
                if token in _DROP_WHOLE or (tag not in ("article", "main") and _names_boilerplate(token)):
                    return True
    return False


def _marks(attrs: str) -> str:
    return " ".join(f"{n.lower()}={a or b or c}" for n, a, b, c in _ATTR.findall(attrs)
                    if n.lower() in ("class", "id", "role")) if "=" in attrs else ""


#: subtree keys in order, the bodies that hold them, those beyond the host's least number (< 0: no template), in MOST bodies
_KEYS = [("key", np.int64), ("n", np.int64), ("spare", np.int64), ("most", np.bool_)]
NO_TEMPLATE = np.zeros(0, _KEYS)


def _tokens(source: str):
    """(start, end, tag name or '', whether it closes, attributes) of the markup of a page, in
    order; a comment or declaration has no name. One pass: a quoted attribute value may hold
    ``>``; where a quote stays open the tag ends at the first ``>``; a ``<`` that no ``>``
    follows, or that starts no markup, is text."""
    last = source.rfind(">")
    at = source.find("<")
    while 0 <= at:
        stop, name, closing, attrs = -1, "", source.startswith("</", at), ""
        word = _NAME.match(source, at + 1 + closing)
        if source.startswith("<!--", at):
            end = _COMMENT_END.search(source, at + 4)
            stop = end.end() if end else len(source)
        elif at > last:
            return
        elif word:
            name, first = word.group().lower(), word.end()
            mark = _STOP.search(source, first)
            while mark and mark.group() != ">":
                quote = source.find(mark.group(), mark.end())
                mark = _STOP.search(source, quote + 1) if quote >= 0 else None
            stop = mark.end() if mark else source.find(">", first) + 1
            attrs = source[first:stop - 1] if stop > 0 else ""
        elif source[at + 1:at + 2] in ("!", "?", "/"):
            stop = source.find(">", at + 2) + 1
        if stop > 0:
            yield at, stop, name, closing, attrs
        at = source.find("<", stop if stop > 0 else at + 1)


class Frame:
    __slots__ = ("tag", "marks", "parts", "size", "at", "drop", "main", "holds")

    def __init__(self, tag: str, marks: str, at: int, drop: bool, main: bool):
        self.tag, self.marks, self.at, self.drop, self.main = tag, marks, at, drop, main
        self.parts: list[bytes] = []
        self.size, self.holds = 0, False


class Page:
    """One walk over a page: block texts, and the subtree keys of its blocks."""

    def __init__(self, host: str):
        self.host = host.encode()
        self.blocks: list[tuple[str, bool]] = []  # text, inside an article or main
        self.run: list[str] = []
        self.keys: dict[int, int] = {}  # subtree key -> characters
        self.places: list[tuple[int, int, int, int]] = []  # subtree key, block range, characters
        self.total = 0  # characters outside elements marked as no main text
        self.stack = [Frame("", "", 0, False, False)]

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            self.run.clear()
            if text:
                self.blocks.append((text, self.stack[-1].main))

    def text(self, data: str) -> None:
        top = self.stack[-1]
        bare = data.strip()
        if bare:
            top.parts.append(bare.encode("utf-8", "replace"))
        if not top.drop:
            top.size += len(bare)
            self.total += len(bare)
            self.run.append(entities.unescape(data))  # a reference never spans two text nodes

    def open(self, tag: str, attrs: str) -> None:
        if tag in ENDS_P and any(f.tag == "p" for f in self.stack[-3:]):
            self.close("p", ENDS_P | {""})
        if tag in SIBLINGS:
            for name in SIBLINGS[tag]:
                self.close(name, SCOPES)
        top = self.stack[-1]
        if tag == "br" or tag == "hr" or tag in VOID:
            if tag == "hr":
                self.flush()
            elif not top.drop:
                self.run.append(" " if tag == "br" else "")
            return
        main = top.main or tag in ("article", "main")
        drop = top.drop or _dropped(tag, attrs, top.main)
        if tag not in INLINE:
            self.flush()
        if main and not top.main:
            for f in self.stack:
                f.holds = True
        while len(self.stack) > DEPTH:
            self.pop()
        self.stack.append(Frame(tag, _marks(attrs), len(self.blocks), drop, main))

    def close(self, tag: str, scope=frozenset()) -> None:
        """Close the nearest open ``tag`` (not across an element of ``scope``)."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self.pop()
                return
            if self.stack[k].tag in scope:
                return

    def pop(self) -> None:
        f = self.stack[-1]
        if f.tag not in INLINE:
            self.flush()
        self.stack.pop()
        up = self.stack[-1]
        digest = blake2b(b"\0".join([f.tag.encode(), f.marks.encode(), *f.parts]), digest_size=16).digest()
        up.parts.append(digest)
        up.size += f.size
        if f.size and f.tag not in INLINE and not f.main and not f.holds and f.tag not in ("html", "body", "head"):
            key = int.from_bytes(blake2b(self.host + b"\0" + digest, digest_size=8).digest(), "big", signed=True)
            self.keys[key] = f.size
            self.places.append((key, f.at, len(self.blocks), f.size))

    def walk(self, source: str) -> "Page":
        at = 0
        for start, stop, name, closing, attrs in _tokens(source):
            if start < at:  # inside a raw text element
                continue
            if start > at:
                self.text(source[at:start])
            at = stop
            if not name:
                continue
            if closing:
                if name == "br":
                    self.open("br", "")
                elif name not in ("body", "html"):
                    self.close(name, frozenset() if name in SCOPES or name in ENDS_P else frozenset(("article", "main")))
                continue
            self.open(name, attrs)
            if name in RAW and not attrs.rstrip().endswith("/"):
                last = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(source, at)
                body = source[at:last.start() if last else len(source)]
                if body.strip():
                    self.stack[-1].parts.append(body.strip().encode("utf-8", "replace"))
                at = last.end() if last else len(source)
                self.close(name)
        if at < len(source):
            self.text(source[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()
        return self

    def body(self) -> int:
        """Hash of all elements and texts of the page."""
        return int.from_bytes(blake2b(b"\0".join(self.stack[0].parts), digest_size=8).digest(), "big", signed=True)

    def main_text(self, template: np.ndarray = NO_TEMPLATE) -> str:
        """What is left of the page after template subtrees are cut; see ``template_keys``."""
        gone = np.zeros(len(self.blocks), bool)
        if len(template) and self.places:
            key, lo, hi, size = np.array(self.places, np.int64).T
            at = np.minimum(np.searchsorted(template["key"], key), len(template) - 1)
            found = np.flatnonzero((template["key"][at] == key) & (hi > lo))
            n, spare, most = (template[c][at] for c in ("n", "spare", "most"))
            small = found[(2 * size[found] <= self.total) & (spare[found] >= 0)].tolist()
            content = np.zeros(len(gone), np.int64)  # bodies that hold the content around a block

            def cut_small() -> np.ndarray:
                out = np.zeros(len(gone), bool)
                for k in small:
                    if spare[k] >= content[lo[k]:hi[k]].min():
                        out[lo[k]:hi[k]] = True
                return out
            length = np.array([len(t) for t, _ in self.blocks], np.int64)
            whole = None
            for k in found[2 * size[found] > self.total][::-1].tolist():  # they are nested: from the outermost
                if most[k] and spare[k] >= content[lo[k]:hi[k]].max():
                    own = length * ~cut_small()
                    if own[:lo[k]].sum() + own[hi[k]:].sum() >= OWN * size[k]:
                        whole = k
                        break
                content[lo[k]:hi[k]] = np.maximum(content[lo[k]:hi[k]], n[k])
            gone = cut_small()
            if whole is not None:
                gone[lo[whole]:hi[whole]] = True
        left = [(t, m) for (t, m), g in zip(self.blocks, gone.tolist()) if not g]
        return "\n\n".join(t for t, m in left if m) or "\n\n".join(t for t, _ in left)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _subtrees(batches):
    for b in batches:
        keys, hosts, bodies, large = [], [], [], []
        for url, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            host = host_of(url)
            page = Page(host).walk(source or "")
            keys += [None, *page.keys]  # the row without a key counts the page itself
            large += [False, *(2 * size > page.total for size in page.keys.values())]
            hosts += [host] * (len(page.keys) + 1)
            bodies += [page.body()] * (len(page.keys) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hosts, pa.string()), pa.array(bodies, pa.int64()),
                                          pa.array(large, pa.bool_())], ["key", "host", "body", "large"])


def template_keys(pages: DataFrame) -> DataFrame:
    """(key, n, spare, most): subtrees that recur across many page bodies of their host, and those
    that recur at all and are over half of a page (``spare`` < 0 if they are no template)."""
    seen = cut(pages.mapInArrow(_subtrees, "key long, host string, body long, large boolean")
               .groupBy("host", "key", "body").agg(F.max("large").alias("large"))
               .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"), F.max("large").alias("large"))
               .where("key is null or n > 1"))
    sizes = seen.where("key is null").select("host", F.col("n").alias("pages"))
    few = F.greatest(F.lit(2), F.least(F.lit(MIN_PAGES), F.ceil(F.col("pages") * SMALL_SHARE)))
    least = F.greatest(few, F.ceil(F.col("pages") * MIN_SHARE))
    return seen.where("key is not null").join(sizes, "host") \
        .select("key", "n", (F.col("n") - least).cast("long").alias("spare"),
                (F.col("n") >= F.col("pages") * MOST).alias("most"), "large") \
        .where("spare >= 0 or large").select("key", "n", "spare", "most")


def _sorted(rows) -> np.ndarray:
    return np.sort(np.array([(r["key"], r["n"], r["spare"], r["most"]) for r in rows], _KEYS), order="key")


def _extract(template=None):
    """Texts of pages; ``template`` or, without it, a column of each page's own keys."""
    def run(batches):
        for b in batches:
            own = [_sorted(k or ()) for k in b.column(3).to_pylist()] if template is None else [template.value] * b.num_rows
            texts = [Page(host_of(u)).walk(s or "").main_text(k)
                     for u, s, k in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), own)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])
    return run


def extract(pages: DataFrame, max_shared: int = MAX_SHARED) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, n_chars for every row."""
    spark = pages.sparkSession
    settings(spark, 500)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    narrow = pages.select("url", "html")
    keys = cut(template_keys(narrow))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    if keys.count() <= max_shared:
        held = _sorted(keys.collect())  # at most max_shared keys of 25 bytes
        rows = pages.mapInArrow(_extract(spark.sparkContext.broadcast(held)), schema)
    else:
        mark = F.xxhash64("url", "html").alias("mark")

        def paired(batches):
            for b in batches:
                marks, own = [], []
                for m, u, s in zip(*(b.column(k).to_pylist() for k in range(3))):
                    found = Page(host_of(u)).walk(s or "").keys
                    marks += [m] * len(found)
                    own += found
                yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(own, pa.int64())], ["mark", "key"])

        pairs = cut(narrow.select(mark, "url", "html").mapInArrow(paired, "mark long, key long").distinct())
        hits = cut(pairs.join(keys, "key").groupBy("mark").agg(F.collect_list(F.struct("key", "n", "spare", "most")).alias("keys")))
        rows = pages.withColumn("mark", F.xxhash64("url", "html")).join(hits, "mark", "left") \
            .select("page_id", "url", "html", "keys").mapInArrow(_extract(), schema)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
