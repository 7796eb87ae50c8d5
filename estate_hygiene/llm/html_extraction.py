"""HTML extraction by template deduction over equivalence classes.

A page is a run of tokens: tags with the path of elements around them, and the text blocks. The occurrence vector of a
token says how often each page of a host has it; it is folded to a sum of page hashes weighted by the count, which adds
up over tasks, so a host with a third of all pages is a few rows for each task and block of text that its pages repeat.
Tokens of a host with the same vector are one equivalence class. A class is valid if it has at least two tokens, which hold on two pages
and on half of the host's at least; the valid classes are the host's template. Their tags make a class valid and thereby
the text blocks that come and go with them.

Copies of one article are no template. An article is known by its first heading, or by its whole text if it has none, and
a text block inside one is template only if two different articles at least have it.

A page's slots lie between the template's tags. Text that is itself template is no slot's. Slots inside navigation,
headers, footers, asides, forms and scripts, by element, are left out. An element is marked by a name in its class, id
or role whose last word says so, words of layout aside: ``ad-slot`` and ``reader-comments`` are marks, ``related-work``
and ``has-sidebar`` are none. Comments, adverts, notices and sidebars (``CERTAIN``) are left out on every page; elements
with other marks, as for sharing or related pages, if the host's template has the marked tag, so on a host that does not
have it on half of its pages, or has one page, they stay. A marked element that is or holds an article or main element never
goes for its name, unless that lies in another article or among the comments below one. Of the rest those in the article
are taken where a page has an article or main element with text, otherwise all.

Markup. A quote opens an attribute's value only behind an equals sign and where it is closed later on; pages are read in
one pass whatever they leave open, and nesting of any depth costs the same for each tag.

Text. Character references are decoded, white space in a block is one space, blocks are joined by a line feed.

Rows: a null html or one without text gives an empty text. A null url is a host of its own name. Repeated rows count as
pages of their own, and a page_id may be null. Other columns are passed on; one named text or n_chars is replaced.
"""

from __future__ import annotations

import hashlib
import html as html_entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate_hygiene.functions.names import free_name
from estate_hygiene.llm.annotate import annotated, texts_of
from estate_hygiene.llm.blocks import packed, table, unpacked
from estate_hygiene.llm.workspace import stored

RAW = frozenset("script style textarea title noscript template iframe svg".split())
TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
TAG_END = re.compile(r">|=\s*([\"'])")
ROLE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
BLOCK = frozenset(
    "html body main article section nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset hr center hgroup dialog menu".split()
)
#: Elements kept on the path; paragraphs and inline elements are often left open.
NESTED = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 hr".split()) | frozenset("head button select".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "tr": ("tr", ("table",)), "td": ("td", ("tr",)), "th": ("th", ("tr",)), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",))}
LEFT_OUT = frozenset("head nav footer aside form button select menu dialog".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side nav navbar navigation menu "
    "breadcrumb breadcrumbs footer cookie cookies consent notice notices gdpr newsletter subscribe subscription popup modal overlay "
    "share sharing social related recommended comment comments commentlist respond replies disqus login signup search pagination "
    "pager toolbar complementary contentinfo alert".split()
)
#: Marks that say by themselves that an element is no part of the main text.
CERTAIN = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo sidebar cookie cookies consent notice notices gdpr "
    "comment comments commentlist respond replies disqus".split()
)
#: Last words of a name that only say how it is laid out, and first ones that say what a page has or lacks.
LAYOUT = frozenset(
    "area container wrapper wrap inner outer box block section list links link buttons button bar slot unit left right top bottom "
    "panel group row column col items item posts articles stories form thread text message".split()
)
STATES = frozenset("no not has have with without is show hide hidden".split())
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OCCURRENCE_SCHEMA = "host string, token long, depth long, pages long, vector long, least long, most long"
#: Of the 64 bits of a page's hash. They are summed as decimals, exact for any number of pages.
VECTOR_BITS = 40


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(url.isNull(), F.lit("(null)")).otherwise(found)


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _marks(attributes: str) -> set[str]:
    """The listed words that name the element."""
    found = set()
    for groups in ROLE.findall(attributes):
        for name in "".join(groups[1:]).lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            while words and words[-1] in LAYOUT:
                words.pop()
            if words and words[0] not in STATES and words[-1] in MARKS:
                found.add(words[-1])
    return found


def markup(source: str) -> Iterator[tuple[str, bool, str]]:
    """The tags and texts of a page in one pass: (name, whether it ends, attributes), or ("", False, text).

    Comments, declarations and the contents of RAW elements are passed over.
    """
    at, size = 0, len(source)
    closed = {">": True, '"': True, "'": True}  # whether there may be another one

    def find(what: str, start: int) -> int:
        found = source.find(what, start) if closed[what] else -1
        closed[what] = found >= 0
        return found

    def tag_end(start: int) -> int:
        while True:
            if find(">", start) < 0:
                return -1
            m = TAG_END.search(source, start)
            if m.group(1) is None:
                return m.start()
            quote = find(m.group(1), m.end())
            start = m.end() if quote < 0 else quote + 1

    while at < size:
        if source[at] != "<":
            end = source.find("<", at)
            end = size if end < 0 else end
            yield "", False, source[at:end]
            at = end
        elif source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = size if end < 0 else end + 3
        elif source[at + 1 : at + 2] in ("!", "?") or (source[at + 1 : at + 2] == "/" and not TAG.match(source, at)):
            end = find(">", at)
            at = size if end < 0 else end + 1
        else:
            m = TAG.match(source, at)
            end = tag_end(m.end()) if m else -1
            if end < 0:
                yield "", False, "<"
                at += 1
                continue
            name, ends, attributes = m.group(2).lower(), bool(m.group(1)), source[m.end() : end]
            at = end + 1
            if name not in RAW:
                yield name, ends, attributes
            elif not ends and not attributes.endswith("/"):
                close = _raw_end(name).search(source, at)
                at = close.end() if close else size


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>", re.IGNORECASE)


@dataclass(frozen=True, slots=True)
class Open:
    """An element on the path: its name, whether it is left out, its mark's number, the path to and with it as a hash, and
    the marked elements around it and itself."""

    name: str
    out: bool
    mark: int | None
    path: str
    marked: tuple[int, ...]


class Page:
    """A walk over a page: its tokens, and its blocks of text with where they stand."""

    def __init__(self, source: str):
        self.stack: list[Open] = []
        self.opened: Counter[str] = Counter()
        self.marked: list[int] = []  # the token of each marked element
        self.certain: set[int] = set()  # marked elements that go by themselves
        self.kept: set[int] = set()  # marked elements that hold the article
        self.comments: set[int] = set()  # those of comments below an article
        self.left_out = self.article = 0
        self.tokens: list[tuple[int, int]] = []
        self.own: set[int] = set()  # tokens of text inside the article
        self.blocks: list[tuple[str, bool, int, tuple[int, ...]]] = []
        self._below = False
        self._heading = False
        self._title: str | None = None
        self._text: list[str] = []
        for name, ends, rest in markup(source):
            if name:
                self._tag(name, ends, rest)
            else:
                self._text.append(rest)
        self._flush()

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(html_entities.unescape("".join(self._text)).split())
        self._text = []
        if not text:
            return
        within = self.stack[-1].marked if self.stack else ()
        own = self.article > 0 and self.kept.issuperset(within)
        token = _hash("own" if own else "text", self.path(), text)
        self.tokens.append((token, len(self.stack)))
        if own:
            self.own.add(token)
            if self._heading and not self.left_out and self._title is None:
                self._title = text
        if not self.left_out:
            self.blocks.append((text, self.article > 0, token, within))

    def path(self) -> str:
        return self.stack[-1].path if self.stack else ""

    def _tag(self, name: str, end: bool, attributes: str) -> None:
        if name == "br":
            self._text.append(" ")
            return
        if name not in BLOCK and name not in NESTED:
            return
        self._flush()
        self._heading = name in HEADINGS and not end
        if name in NESTED:
            self.tokens.append((_hash("end" if end else "start", self.path(), name), len(self.stack)))
            if end:
                self._close(name)
            elif not attributes.rstrip().endswith("/"):
                self._open(name, attributes)

    def _open(self, name: str, attributes: str) -> None:
        if name in CLOSES and (self.opened[name] or self.opened[CLOSES[name][0]]):
            other, within = CLOSES[name]
            for around in reversed(self.stack):
                if around.name in within:
                    break
                if around.name in (name, other):
                    self._close(around.name)
                    break
        out = name in LEFT_OUT or (name == "header" and not self.article)
        marks = _marks(attributes) if name not in ("html", "body") else ()
        mark = None
        if marks:
            mark = len(self.marked)
            named = (self.path(), name, *sorted(marks))
            # A tag of its own at both ends, so that marked elements are a class by themselves.
            self.marked.append(_hash("marked", *named))
            self.tokens += [(self.marked[-1], len(self.stack)), (_hash("marked end", *named), len(self.stack))]
            if not CERTAIN.isdisjoint(marks):
                self.certain.add(mark)
            if self._below and name not in ARTICLE and not COMMENTS.isdisjoint(marks):
                self.comments.add(mark)
        marked = (self.stack[-1].marked if self.stack else ()) + (() if mark is None else (mark,))
        self.stack.append(Open(name, out, mark, f"{_hash(self.path(), name):x}", marked))
        self.opened[name] += 1
        self.left_out += out
        if name in ARTICLE:
            self._keep(name)
        self.article += name in ARTICLE

    def _keep(self, name: str) -> None:
        """Keeps the marked elements that hold the article just opened, up to one that it lies in."""
        for k, around in enumerate(reversed(self.stack)):
            if k and around.name == "article":
                break
            if around.mark is not None and around.mark not in self.comments:
                self.kept.add(around.mark)
        self._below |= name == "article"

    def _close(self, name: str) -> None:
        if not self.opened[name]:
            return
        while True:
            gone = self.stack.pop()
            self.opened[gone.name] -= 1
            self.left_out -= gone.out
            self.article -= gone.name in ARTICLE
            if gone.name == name:
                return

    def named(self) -> int:
        """What tells the page's article from others."""
        return _hash("title", self._title) if self._title is not None else _hash("texts", *[text for text, inside, *_ in self.blocks if inside])

    def text(self, template: frozenset[int] | set[int]) -> str:
        """The blocks of the remaining slots."""
        gone = {k for k, token in enumerate(self.marked) if (k in self.certain or token in template) and k not in self.kept}
        blocks = [b for b in self.blocks if gone.isdisjoint(b[3])]
        inside = any(b[1] for b in blocks)
        return "\n".join(text for text, in_article, token, _ in blocks if (in_article or not inside) and token not in template)


def _occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token: pages that have it, its occurrence vector as a sum, and for text of articles the least and the
    greatest name of one that has it; partial sums of each batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, int, int], list] = {}
            for host, source, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                walked = Page(source or "")
                article = walked.named()
                for (token, depth), n in Counter(walked.tokens).items():
                    own = total.setdefault((host, token, depth), [0, 0, None, None])
                    own[0] += 1
                    own[1] += _hash(str(page), str(n)) & ((1 << VECTOR_BITS) - 1)
                    if token in walked.own:
                        own[2] = article if own[2] is None else min(own[2], article)
                        own[3] = article if own[3] is None else max(own[3], article)
                total.setdefault((host, 0, -1), [0, 0, None, None])[0] += 1
            keys, values = list(total), list(total.values())
            yield table(OCCURRENCE_SCHEMA, {
                "host": [k[0] for k in keys], "token": [k[1] for k in keys], "depth": [k[2] for k in keys],
                "pages": [v[0] for v in values], "vector": [v[1] for v in values], "least": [v[2] for v in values], "most": [v[3] for v in values],
            })

    page = F.xxhash64("page_id", "url", "html")
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"), page.alias("page")).mapInArrow(count, OCCURRENCE_SCHEMA)
    return rows.groupBy("host", "token", "depth").agg(
        F.sum("pages").alias("pages"), F.sum(F.col("vector").cast("decimal(20,0)")).alias("vector"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def templates(pages: DataFrame) -> DataFrame:
    """Per host the tokens of its valid classes: host, template."""
    counted = _occurrences(pages)
    several = (F.col("pages") >= 2) & (F.col("least").isNull() | (F.col("least") != F.col("most")))
    found = stored(counted.where((F.col("depth") == -1) | several).drop("least", "most"), "occurrences")
    hosts = found.where(F.col("depth") == -1).select("host", F.col("pages").alias("of"))
    tokens = found.where(F.col("depth") >= 0).join(hosts, "host").where(2 * F.col("pages") >= F.col("of"))
    valid = tokens.groupBy("host", "pages", "vector").agg(F.collect_list("token").alias("tokens")).where(F.size("tokens") >= 2)
    return valid.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("template"))


def with_main_text(pages: DataFrame) -> DataFrame:
    """Rows of ``pages`` (page_id, url, html and any others, which stay) with text and n_chars in place of html.

    Pages meet their host's template in a shuffle, for which each is packed small.
    """
    pages = pages.withColumn("html", F.col("html").cast("string"))
    host, page, template, known_host = (free_name(pages, n) for n in ("host", "page", "template", "known_host"))
    sent = annotated(pages.withColumn(host, host_of(F.col("url"))), lambda: _packed_pages(page), f"{page} binary").drop("html")
    # Stored, the templates come to the join by a shuffle of their own, which lets Spark split a large host's pages.
    known = stored(templates(pages), "templates").withColumnsRenamed({"host": known_host, "template": template})
    joined = sent.join(known, F.col(host) == F.col(known_host), "left").drop(known_host)
    return annotated(joined, lambda: _texts(page, template), "text string, n_chars long").drop(host, template, page)


def _packed_pages(page: str) -> Callable[[pa.RecordBatch], dict[str, list]]:
    return lambda batch: {page: [packed(source) for source in texts_of(batch, "html")]}


def _texts(page: str, template: str) -> Callable[[pa.RecordBatch], dict[str, list]]:
    def texts(batch: pa.RecordBatch) -> dict[str, list]:
        rows = zip(batch.column(page).to_pylist(), batch.column(template).to_pylist(), strict=True)
        found = [Page(unpacked(source).decode()).text(set(tokens or ())) for source, tokens in rows]
        return {"text": found, "n_chars": [len(t) for t in found]}

    return texts
