"""Main text of web pages, without what a site repeats on its pages.

1. Every page is parsed once; each element's subtree (tag, class, text and children) is hashed together
   with the page's host. Pages of a host whose text is the same, boilerplate and what is outside the article
   aside, are copies and count once; Spark counts the different pages that hold each hash.
2. Subtrees on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the host's pages, or on
   ``MANY_PAGES`` pages of a host of any size, are site templates. Pages are parsed again; templates, elements that are never article text (menus,
   forms, scripts, comments and the like, by tag, role or class) and everything
   outside ``<article>``, or else ``<main>``, if there is one, are left out. Inside the
   article, running text (paragraphs, headings, quotes, list items, table cells), what it stands in and what
   it holds is never a template, since passages may recur for good reasons; a list of nothing but
   links is no running text. On pages without an article it is a template only on ``MOST`` of the host's pages.

Null or empty html gives empty text; unclosed, misnested and truncated markup is read as far as it
goes; pages with null urls share the empty host; repeated rows are each extracted.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table
from tracklake.llm.url_filter import host_of

MIN_PAGES = 5
MIN_SHARE = 0.02
#: Pages that are enough on a host of any size.
MANY_PAGES = 1000
#: Share of the host's pages that makes running text a template where no article is marked.
MOST = 0.5
#: Template hashes that a broadcast may hold: 16 MB.
BROADCAST_HASHES = 2_000_000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>|<[a-zA-Z!?/][^>]*+\Z""",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_words = lambda s: frozenset(s.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style title textarea noscript iframe xmp noembed noframes")
INLINE = _words("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr")
#: Tags, roles and class or id words of what is not article text.
DROP_TAGS = _words("aside button canvas datalist dialog embed fieldset footer form head iframe input menu nav noembed noframes noscript object option script search select style svg template textarea title")
DROP_ROLES = _words("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form")
DROP_NAMES = _words(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets "
    "header masthead topbar footer foot comments comment commentlist replies disqus discussion respond share sharing social related recommended login searchbox search pagination pager toolbar skip"
)
ARTICLE_NAMES = _words("article post entry story content title main body")
TEXT_TAGS = _words("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th figcaption address article main body html")
#: Elements whose text is running text.
PROSE_TAGS = TEXT_TAGS - _words("article main body html")
#: An open element that a start tag closes, up to the named limits.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "option": ("option", "select")}
CLOSES = {k: (_words(a), _words(b)) for k, (a, b) in CLOSES.items()}


#: First words of class names that say what a page has, lacks or does, not what the element is.
STATES = _words("has no with without not is hide hides show shows non un")
#: Words of class names for the form of an element; what stands before them says what it holds.
FORMS = _words(
    "area aside bar bars block blocks body bottom box boxes btn button buttons card center col column container content desktop div el element entry first full group head heading "
    "holder icons id inner item items label large last layer left level line link links list main mobile nav outer panel primary right row secondary section slot small space "
    "strip tab tabs text title top unit units ul view wrap wrapper zone"
)


def _named(value: str) -> frozenset[str]:
    """What each class or id name says the element is: its last word that isn't a mere form.

    ``cookie-notice`` is a notice and ``sidebar-left`` a sidebar, but ``share-prices`` are prices, and ``no-sidebar`` names nothing.
    """
    found = set()
    for name in value.split():
        words = [w for w in re.sub(r"[^a-z0-9]+", " ", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()).split() if not w.isdigit()]
        if len(words) > 1 and words[0] in STATES:
            continue
        while len(words) > 1 and words[-1] in FORMS:
            words.pop()
        found.update(words[-1:])
    return frozenset(found)


def _boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in DROP_TAGS or (tag == "header" and not in_article):
        return True
    if "hidden" in attrs or attrs.get("role", "").lower() in DROP_ROLES or attrs.get("aria-hidden") == "true":
        return True
    if tag in ("article", "main", "body", "html") or not (attrs.get("class") or attrs.get("id")):
        return tag == "article" and bool(_named(attrs.get("class", "")) & {"comment", "teaser", "related"})
    value = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    bad = _named(value) & DROP_NAMES
    return bool(bad - {"header"}) or bool(bad and not _words(re.sub(r"[^a-z0-9]+", " ", value.lower())) & ARTICLE_NAMES)


class Page:
    """Elements and text blocks of one page; an element is known by its number."""

    def __init__(self, html: str, host: str):
        self.host = blake2b(host.encode(), digest_size=16).digest()
        self.parent, self.tag, self.drop, self.digest = [-1], [""], [False], [b""]
        self.blocks: list[tuple[int, str]] = []  # the innermost block element, and the text
        self.says = [False]  # text of its own that is no link
        self._stack, self._parts, self._text = [0], [[]], []
        self._articles = 0
        self._read(html)

    def _flush(self) -> None:
        if self._text:
            text = _SPACE.sub(" ", "".join(self._text)).strip()
            self._text = []
            if text:
                at = next(e for e in reversed(self._stack) if self.tag[e] not in INLINE)
                self.blocks.append((at, text))

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag not in INLINE:
            self._flush()
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.drop.append(_boilerplate(tag, attrs, self._articles > 0))
        self.digest.append(b"")
        self.says.append(False)
        self._stack.append(len(self.tag) - 1)
        self._parts.append([f"{tag}.{attrs.get('class', '')}".encode("utf-8", "replace")])
        self._articles += tag == "article"

    def _close(self) -> None:
        e, parts = self._stack.pop(), self._parts.pop()
        if self.tag[e] not in INLINE:
            if self._text:
                self._stack.append(e)
                self._flush()
                self._stack.pop()
        self._articles -= self.tag[e] == "article"
        self.digest[e] = blake2b(b"\0".join(parts), digest_size=8, key=self.host).digest()
        self._parts[-1].append(self.digest[e])

    def _up_to(self, tags: frozenset[str], limits: frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[depth]]
            if tag in tags:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in limits:
                return

    def _close_paragraph(self) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[depth]]
            if tag == "p":
                while len(self._stack) > depth:
                    self._close()
                return
            if tag not in INLINE:
                return

    def _say(self, text: str) -> None:
        if text:
            if self.drop[self._stack[-1]] is False or text.strip():
                self._parts[-1].append(_SPACE.sub(" ", text).encode("utf-8", "replace"))
            if text.strip() and not any(self.tag[e] == "a" for e in self._stack):
                self.says[self._stack[-1]] = True
            self._text.append(entities.unescape(text))

    def _read(self, html: str) -> None:
        at, match = 0, _TOKEN.search(html)
        while match:
            self._say(html[at : match.start()])
            at = match.end()
            closing, tag, rest = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
            if tag is None:
                if match[0].startswith("<![CDATA["):
                    self._say(match[0][9:].removesuffix("]]>"))
            elif closing:
                tag = tag.lower()
                if tag == "br":
                    self._text.append(" ")
                elif tag not in VOID:
                    self._up_to(frozenset((tag,)), frozenset() if tag not in INLINE else frozenset(("p", "td", "th", "article", "main", "body")))
            else:
                tag = tag.lower()
                if tag in ("br", "wbr", "img"):
                    self._text.append(" " if tag == "br" else "")
                elif tag in VOID:
                    if tag == "hr":
                        self._close_paragraph()
                        self._flush()
                else:
                    if tag in CLOSES:
                        self._up_to(*CLOSES[tag])
                    elif tag not in INLINE:
                        self._close_paragraph()
                    attrs = {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")) for m in _ATTR.finditer(rest)} if rest.strip() else {}
                    self._open(tag, attrs)
                    if tag in RAW:
                        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                        stop = end.start() if end else len(html)
                        self._parts[-1].append(html[at:stop].encode("utf-8", "replace"))
                        at = stop
                        if not end:
                            break
            match = _TOKEN.search(html, at)
        else:
            self._say(html[at:])
        while len(self._stack) > 1:
            self._close()
        self._flush()

    def hashes(self) -> set[int]:
        """Hashes of the subtrees that could be a template."""
        return {int.from_bytes(d, "little", signed=True) for d, t in zip(self.digest, self.tag, strict=True) if d and t not in INLINE and t not in ("html", "body", "head", "br")}

    def _outline(self) -> tuple[list[bool], list[bool], bool]:
        """Per element: dropped by itself or an element around it, within the article; and if there is an article."""
        n = len(self.tag)
        gone, within = [False] * n, [False] * n
        root = next((r for r in ("article", "main") if any(t == r and not self.drop[i] for i, t in enumerate(self.tag))), None)
        drop = self.drop
        for e in range(1, n):
            gone[e] = gone[self.parent[e]] or drop[e]
        roots = [e for e in range(1, n) if self.tag[e] == root and not drop[e]]
        if roots and all(gone[e] for e in roots):  # a name around the article itself can't mean that it is none
            drop, at = list(drop), self.parent[roots[0]]
            while at > 0:
                drop[at] = drop[at] and self.tag[at] in DROP_TAGS
                at = self.parent[at]
        for e in range(1, n):
            p = self.parent[e]
            gone[e] = gone[p] or drop[e]
            within[e] = within[p] or self.tag[e] == root
        return gone, within, root is not None

    def _running(self, gone: list[bool], within: list[bool], rooted: bool) -> list[bool]:
        """Per element: it is or holds running text, or is part of it."""
        n = len(self.tag)
        says, holds = [says and not gone[e] for e, says in enumerate(self.says)], [False] * n
        for e in range(n - 1, 0, -1):
            p = self.parent[e]
            holds[e] = holds[e] or (says[e] and self.tag[e] in PROSE_TAGS)
            says[p], holds[p] = says[p] or says[e], holds[p] or holds[e]
        inside = [False] * n
        for e in range(1, n):
            p = self.parent[e]
            inside[e] = (inside[p] or self.tag[p] in PROSE_TAGS) and (within[p] or not rooted)
        return [a or b for a, b in zip(holds, inside, strict=True)]

    def body(self) -> bytes:
        """A hash of the page's text without boilerplate and what is outside the article; equal for copies."""
        gone, within, rooted = self._outline()
        text = "\n".join(text for e, text in self.blocks if not gone[e] and (within[e] or not rooted))
        return blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()

    def text(self, templates: frozenset[int], everywhere: frozenset[int]) -> str:
        """The main text; ``everywhere`` are the templates on most pages of the host."""
        gone, within, rooted = self._outline()
        running = self._running(gone, within, rooted)
        for e in range(1, len(self.tag)):
            gone[e] = gone[e] or gone[self.parent[e]]
            if gone[e] or self.tag[e] in INLINE or self.tag[e] in ("html", "body"):
                continue
            h = int.from_bytes(self.digest[e], "little", signed=True)
            if h not in templates or (within[e] and (running[e] or self.tag[e] in TEXT_TAGS)):
                continue
            gone[e] = rooted or not running[e] or h in everywhere
        return "\n".join(text for e, text in self.blocks if not gone[e] and (within[e] or not rooted))


def _hosted(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    yield from ((host.as_py() or "", page.as_py() or "") for host, page in zip(batch.column("host"), batch.column("html"), strict=True))


def _host_key(host: str) -> int:
    return int.from_bytes(blake2b(host.encode(), digest_size=8).digest(), "little", signed=True)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[tuple[int, bytes], bytes] = {}
        for host, html in _hosted(batch):
            page = Page(html, host)
            of, subtrees = (_host_key(host), page.body()), np.array(sorted(page.hashes()), np.int64).tobytes()
            held[of] = max(held.get(of, b""), subtrees)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int64()), pa.array([b for _, b in held], pa.binary()), pa.array(held.values(), pa.binary())], names=["host", "body", "subtrees"])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[tuple[int, int], int] = {}
        for key, subtrees in zip(batch.column("host").to_pylist(), batch.column("subtrees").to_pylist(), strict=True):
            for h in [*np.frombuffer(subtrees, np.int64).tolist(), key]:
                seen[key, h] = seen.get((key, h), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.int64()), pa.array([h for _, h in seen], pa.int64()), pa.array(seen.values(), pa.int64())], names=["host", "subtree", "pages"])


def _of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(i, h) for i, (host, page) in zip(batch.column("page_id").to_pylist(), _hosted(batch), strict=True) for h in Page(page, host).hashes()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([h for _, h in pairs], pa.int64())], names=["page_id", "subtree"])


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = [frozenset(found.tolist()) for found in shared.value] if shared else None
        for batch in batches:
            own = None if common else [[frozenset(found or ()) for found in both] for both in zip(batch.column("templates").to_pylist(), batch.column("everywhere").to_pylist(), strict=True)]
            texts = [Page(page, host).text(*(common or own[i])) for i, (host, page) in enumerate(_hosted(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(spark: SparkSession, pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, broadcast_hashes: int = BROADCAST_HASHES, many_pages: int = MANY_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    stage = Stage(spark, "html")
    pages = exact(pages, "page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    bodies = pages.mapInArrow(_bodies, "host long, body binary, subtrees binary").groupBy("host", "body").agg(F.max("subtrees").alias("subtrees"))
    counted = bodies.mapInArrow(_subtrees, "host long, subtree long, pages long").groupBy("host", "subtree").agg(F.sum("pages").alias("pages"))
    counted = stage(counted.where((F.col("pages") >= min_pages) | (F.col("host") == F.col("subtree"))), "counts")
    hosts = counted.where("host = subtree").select("host", F.col("pages").alias("all_pages"))
    enough = F.greatest(F.lit(min_pages), F.least(F.col("all_pages") * min_share, F.lit(many_pages)))
    templates = stage(counted.where("host <> subtree").join(hosts, "host").where(F.col("pages") >= enough).groupBy("subtree").agg(F.max(F.col("pages") >= F.col("all_pages") * MOST).alias("most")), "templates")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    if templates.count() <= broadcast_hashes:
        found = templates.collect()
        shared = spark.sparkContext.broadcast([np.array([r["subtree"] for r in found if r["most"] or not most], np.int64) for most in (False, True)])
        return pages.mapInArrow(_extract(shared), schema)
    each = pages.mapInArrow(_of_pages, "page_id long, subtree long").join(templates, "subtree").groupBy("page_id").agg(F.collect_set("subtree").alias("templates"), F.collect_set(F.when(F.col("most"), F.col("subtree"))).alias("everywhere"))
    return pages.join(each, "page_id", "left").mapInArrow(_extract(None), schema)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, table(spark, sf_dir, "pages"))
