"""Main text of web pages: site templates are found by counting equal element subtrees per host.

Every block element outside the article, and every container inside it, is hashed with all it holds.  Spark counts, per
host, the different pages that hold a subtree; those on a share of them, which is higher inside articles, are template
and are deleted where they stand, together with elements that are never main text by their tag (menus, forms, scripts)
or by their class, id or role (adverts, notices, reader comments).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BROADCAST_IDS, kept
from .text import slices

#: A subtree on this many different pages of a host, and on this percentage of them, is template.
TEMPLATE_PAGES, TEMPLATE_PERCENT = 5, 5
#: The percentage for containers inside articles, where a quotation may stand on several pages.
INSIDE_PERCENT = 30
#: Bytes of subtree hashes that are broadcast to where pages are read; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr
    ul""".split()
)
#: Elements that can be template inside an article; paragraphs, headings, items and quotations alone are not.
CONTAINER = frozenset(
    "article aside center details div dl fieldset figure footer form header nav ol section table ul".split()
)
#: Elements whose content is not main text.
NEVER = frozenset(
    """script style noscript template head title nav footer aside form button select textarea iframe object svg math
    canvas audio video dialog menu map datalist""".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: Words in a class, id or role of what is not main text.
HINTS = frozenset(
    """ad ads advert adverts advertisement advertisements advertising banner banners sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices alert popup modal overlay sidebar nav navbar navigation menu menus
    breadcrumb breadcrumbs footer comment comments discussion replies disqus share sharing social related recommended
    newsletter subscribe subscription widget widgets toolbar pagination pager complementary contentinfo search""".split()
)
_CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "thead", "tbody", "tfoot")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s"'/])hidden(?:[\s=/]|$)""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def _hint(tag: str, attributes: str) -> int:
    """How strongly class, id and role tell against an element: 2 by a whole name, 1 by a word in one, else 0."""
    if not attributes or tag in ("html", "body", "main"):
        return 0
    names = [n for _, value in _NAMED.findall(attributes) for n in value.lower().strip("\"'").split()]
    if not HINTS.isdisjoint(names):
        return 2
    return int(any(not HINTS.isdisjoint(_WORD.findall(n)) for n in names))


def _masthead(tag: str, attributes: str) -> bool:
    """A header by its tag or by a word of its class, id or role."""
    return tag == "header" or any("header" in _WORD.findall(value.lower()) for _, value in _NAMED.findall(attributes or ""))


class _Page:
    """One pass over a page: the text blocks that stay, and the hashes of subtrees that can be template.

    A hash is odd for a subtree inside the article and even for others.  An element that a hint tells against loses its
    text unless it holds an article, or, if only a word of a longer name is the hint, more than half of the text: such
    names stand on wrappers (``right-sidebar``) as well.
    """

    def __init__(self, source: str, template: frozenset[int], hashing: bool = True):
        # Blocks with the numbers of the hinted elements around them.
        self.blocks: list[tuple[str, tuple[int, ...]]] = []
        self.main: list[tuple[str, tuple[int, ...]]] | None = None
        self.weak: list[bool] = []
        self.holds_main: set[int] = set()
        self.open: Counter[str] = Counter()
        self.hashes: set[int] = set()
        self.template, self.hashing = template, hashing
        self.buffer: list[str] = []
        # Open elements: tag, dropped, blocks before it, what its hash is made of, in the article, hinted elements.
        self.stack: list[tuple[str, bool, int, list[bytes], bool, tuple[int, ...]]] = [("", False, 0, [], False, ())]
        at = 0
        find = _MARKUP.search
        while at < len(source):
            m = find(source, at)
            if m is None:
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else len(source)
        if at < len(source):
            self._text(source[at:])
        while len(self.stack) > 1:
            self._close()
        self._flush()

    def text(self) -> str:
        blocks = self.blocks if self.main is None else self.main
        blocks = [(b, hints) for b, hints in blocks if all(self.weak[h] or h in self.holds_main for h in hints)]
        size, most = Counter(), sum(len(block) for block, _ in blocks)
        for block, hints in blocks:
            for h in hints:
                size[h] += len(block)
        gone = {h for h in size if h not in self.holds_main and size[h] * 2 <= most}
        return "\n".join(block for block, hints in blocks if gone.isdisjoint(hints))

    def _text(self, raw: str):
        frame = self.stack[-1]
        if self.hashing:
            frame[3].append(" ".join(raw.split()).encode("utf-8", "replace"))
        if not frame[1]:
            self.buffer.append(html.unescape(raw) if "&" in raw else raw)

    def _flush(self):
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.blocks.append((text, self.stack[-1][5]))
            self.buffer = []

    def _start(self, tag: str, attributes: str):
        if tag in BLOCK:
            self._flush()
            for i in range(len(self.stack) - 1 if self.open["p"] else 0, 0, -1):
                if self.stack[i][0] == "p":
                    while len(self.stack) > i:
                        self._close()
                    break
                if self.stack[i][0] in BLOCK:
                    break
            if tag in _CLOSED_BY:
                same, bounds = _CLOSED_BY[tag]
                there = any(self.open[t] for t in same.split())
                for i in range(len(self.stack) - 1 if there else 0, 0, -1):
                    if self.stack[i][0] in bounds:
                        break
                    if self.stack[i][0] in same.split():
                        while len(self.stack) > i:
                            self._close()
                        break
        if tag in VOID:
            return
        parent = self.stack[-1]
        in_main = parent[4] or tag in ("article", "main")
        hidden = bool(attributes) and tag not in ("html", "body", "main") and bool(_HIDDEN.search(attributes))
        masthead = not in_main and tag not in ("html", "body") and _masthead(tag, attributes)
        dropped = parent[1] or tag in NEVER or hidden or masthead
        hints = parent[5]
        if not dropped and in_main and not parent[4]:
            self._flush()
            self.holds_main.update(hints)
        hint = 0 if dropped else _hint(tag, attributes)
        if tag == "article":
            # A comment inside an article may be one itself.
            hint = 2 if hint == 2 and parent[4] else 0
        if hint:
            # What was read before the element is not inside it.
            self._flush()
            hints = (*hints, len(self.weak))
            self.weak.append(hint == 1)
        self.open[tag] += 1
        self.stack.append((tag, dropped, len(self.blocks), [tag.encode()], in_main, hints))

    def _end(self, tag: str):
        for i in range(len(self.stack) - 1 if self.open[tag] else 0, 0, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._close()
                return
        if tag in BLOCK:
            self._flush()

    def _close(self):
        tag, dropped, before, parts, in_main, hints = self.stack[-1]
        if tag in BLOCK or hints != self.stack[-2][5]:
            self._flush()
        self.stack.pop()
        self.open[tag] -= 1
        parent = self.stack[-1]
        if self.hashing:
            digest = blake2b(b"\x00".join(parts), digest_size=8).digest()
            # What is outside does not depend on the articles in it.
            if parent[4] or not in_main:
                parent[3].append(digest)
            can_be = tag in CONTAINER if in_main else tag in BLOCK and tag not in ("html", "body")
            if can_be and len(self.blocks) > before:
                number = _number(digest) & ~1 | in_main
                self.hashes.add(number)
                if number in self.template:
                    del self.blocks[before:]
        if in_main and not dropped and not parent[4]:
            self.main = (self.main or []) + self.blocks[before:]


def _subtrees(batches):
    """Tasks: key, host, a hash of the text and the distinct subtree hashes of every page."""
    for batch in batches:
        for piece in slices(batch, "html"):
            hosts, contents, hashes = [], [], []
            for url, source in zip(piece.column("url").to_pylist(), piece.column("html").to_pylist()):
                page = _Page(source or "", frozenset())
                hosts.append(host_of(url))
                contents.append(_number(blake2b(page.text().encode("utf-8", "replace"), digest_size=8).digest()))
                hashes.append(sorted(page.hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"),
                    pa.array(hosts, pa.string()),
                    pa.array(contents, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["key", "host", "content", "hashes"],
            )


def _extract(batches):
    for batch in batches:
        for piece in slices(batch, "html"):
            texts = [
                _Page(source or "", frozenset(template or ()), bool(template)).text()
                for source, template in zip(piece.column("html").to_pylist(), piece.column("template").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def main_text(
    pages: DataFrame,
    template_pages: int = TEMPLATE_PAGES,
    template_percent: int = TEMPLATE_PERCENT,
    inside_percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """``pages`` (``url, html``) with ``text`` for ``html``: blocks of the main text, joined by line ends, and ``n_chars``.

    The main text is what ``article`` or ``main`` elements hold, or the whole body where there is none, without the
    elements named by ``NEVER``, mastheads, those that ``HINTS`` tell against (but no wrapper of an article or, by a part
    of a name, of most of the text) and, outside articles, without subtrees that at least ``template_pages``
    different pages of the host hold, and ``template_percent`` percent of them; inside articles the same goes for
    subtrees of a ``CONTAINER`` and ``inside_percent`` percent.  Pages of a host with equal texts (before
    subtrees go) count as one.  White space in a block is one space, a ``br`` ends a block, character references are decoded.

    Null or empty html, and pages without main text, give an empty text.  A null or malformed url is a host of its
    own.  Unclosed and stray tags are closed or passed over; repeated rows count as one page and give equal texts.
    Columns named ``text`` or ``n_chars`` are replaced; no rows give no rows.
    """
    key = F.xxhash64("url", "html")
    source = pages.select(key.alias("key"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = source.mapInArrow(_subtrees, "key long, host string, content long, hashes array<long>")
    found = kept(found, "subtrees")
    different = found.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    different = kept(different.where(F.col("pages") >= template_pages), "host_pages")
    few = different.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    holds = found.select("host", "content", F.explode("hashes").alias("hash")).distinct()
    holds = holds.groupBy("host", "hash").count().where(F.col("count") >= template_pages)
    template = holds.join(F.broadcast(different) if few else different, "host")
    share = F.when(F.col("hash").bitwiseAND(1) == 1, inside_percent).otherwise(template_percent)
    template = template.where(F.col("count") * 100 >= F.col("pages") * share)
    template = kept(template.select("host", "hash"), "templates")
    each = found.select("key", "host", F.explode("hashes").alias("hash"))
    of_page = each.distinct().join(template, ["host", "hash"]).groupBy("key").agg(F.collect_list("hash").alias("template"))
    of_page = kept(of_page, "page_templates")
    size = of_page.agg(F.sum(8 * F.size("template") + 64)).first()[0] or 0
    old = [c for c in pages.columns if c not in ("text", "n_chars", "html")]
    rows = pages.select(F.struct(*old).alias("row"), F.col("html").cast("string").alias("html"), key.alias("key"))
    rows = rows.join(F.broadcast(of_page) if size <= BROADCAST_BYTES else of_page, "key", "left")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string"
    out = rows.select("row", "html", "template").mapInArrow(_extract, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in old], "text", F.char_length("text").cast("long").alias("n_chars"))
