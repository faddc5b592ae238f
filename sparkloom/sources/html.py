"""HTML pages as rows: links, declared metadata, main text. Fetchers are injected, so tests need no network."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from sparkloom.functions.urls import resolve
from sparkloom.sources import content

#: Limits of fetched documents.
HTML_BYTES, ROBOTS_BYTES, REDIRECTS = 4 << 20, 512 << 10, 4
#: JSON-LD types that are preferred as an article.
ARTICLES = ("article", "blogposting", "newsarticle", "report", "scholarlyarticle", "techarticle")
#: Where each field of a page's metadata is looked for, in order: JSON-LD, meta tags, the page itself.
PRECEDENCE = {
    "title": [("ld", ("headline", "name")), ("meta", ("og:title", "twitter:title")), ("page", ("title",))],
    "published_at": [("ld", ("datePublished",)), ("meta", ("article:published_time", "datepublished", "publishdate", "date", "dc.date", "dcterms.date"))],
    "modified_at": [("ld", ("dateModified",)), ("meta", ("article:modified_time", "og:updated_time", "datemodified"))],
    "language": [("page", ("lang",)), ("ld", ("inLanguage",)), ("meta", ("content-language", "language", "og:locale"))],
    "declared_canonical_url": [("page", ("canonical",))],
    "site_name": [("meta", ("og:site_name",))],
    "description": [("ld", ("description",)), ("meta", ("description", "og:description"))],
}
AUTHOR_KEYS = ("author", "article:author", "byl")
EXTRACTOR = {"name": "sparkloom-text", "version": "2"}
_BLOCKS = {"p", "td", "th", "dt", "dd", "figcaption", "div", "section", "article", "main", "ul", "ol", "table", "blockquote", "pre", "br", "body"}


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := next((v for k, v in attrs if k == "href" and v), None)):
            self.found.append(href)


def links_of(html: str | None) -> list[str]:
    """The first non-empty href of each anchor, in order."""
    parser = _Links()
    parser.feed(html or "")
    return parser.found


class _Markdown:
    """Text of elements as Markdown, from their starts, ends and texts in order."""

    def __init__(self):
        self.out: list[str] = []
        self.pre, self.row, self.rows = 0, None, 0

    def start(self, tag):
        if tag == "table":
            self.rows = 0
        elif tag == "pre":
            self.pre += 1
        if tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.row.append("")
        elif tag == "pre":
            self.out.append("\n\n```\n")
        elif tag in _BLOCKS and self.row is None:
            self.out.append("\n\n")
        elif tag == "li":
            self.out.append("\n- ")
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")

    def end(self, tag):
        if tag == "tr" and self.row is not None:
            cells = [" ".join(c.split()).replace("|", "\\|") for c in self.row]
            self.out.append("\n| " + " | ".join(cells) + " |" + ("\n|" + " --- |" * len(cells) if not self.rows else "") if cells else "")
            self.row, self.rows = None, self.rows + 1
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif self.row is None and (tag in _BLOCKS or tag[:1] == "h" and tag[1:].isdigit()):
            self.out.append("\n\n")

    def text(self, data):
        if self.row:
            self.row[-1] += data
        elif self.pre:
            self.out.append(data)
        elif self.row is None:
            self.out.append((" " if data[:1].isspace() else "") + " ".join(data.split()) + (" " if data[-1:].isspace() else "") if data.strip() else " ")

    def written(self) -> str:
        """Composed text, without white space at the start of lines outside code."""
        parts = "".join(self.out).split("```")
        return unicodedata.normalize("NFC", "```".join(p if i % 2 else re.sub(r"\n[ \t]+", "\n", re.sub(r"[ \t]+", " ", p)) for i, p in enumerate(parts)))


class _Declared:
    """What a page's elements declare: meta tags, JSON-LD, title, language, canonical link."""

    def __init__(self, root: content.Node):
        self.meta: dict[str, list[str]] = {}
        self.scripts: list[str] = []
        titles, canonical = [], []
        for node in root.below():
            a = node.attrs
            if node.tag == "link" and "canonical" in a.get("rel", "").lower().split():
                canonical.append(a.get("href"))
            elif node.tag == "meta":
                name = next((a[k] for k in ("property", "name", "itemprop", "http-equiv") if a.get(k)), None)
                if name and a.get("content"):
                    self.meta.setdefault(name.strip().lower(), []).append(a["content"].strip())
            elif node.tag == "title":
                titles.append(node.text())
            elif node.tag == "script" and a.get("type", "").lower() == "application/ld+json":
                self.scripts.append("".join(c for c in node.children if isinstance(c, str)))
        self.own = {"title": " ".join(titles), "lang": root.attrs.get("lang") or None, "canonical": next((x for x in canonical if x), None)}


def main_markdown(root: content.Node) -> str:
    """The page's main content as Markdown."""
    out = _Markdown()
    for kind, value in content.events(content.content_of(root)):
        getattr(out, kind)(value)
    return out.written()


def _nodes(value) -> Iterator[dict]:
    """Objects of lists and of @graph, outer ones first."""
    if isinstance(value, list):
        for x in value:
            yield from _nodes(x)
    elif isinstance(value, dict):
        yield value
        yield from _nodes(value.get("@graph", []))


def _authors(value) -> list[str]:
    if isinstance(value, str):
        return [" ".join(value.split())] if value.strip() else []
    if isinstance(value, dict):
        return _authors(value.get("name"))
    return [a for x in value for a in _authors(x)] if isinstance(value, list) else []


def _is_article(node: dict) -> bool:
    kinds = node["@type"] if isinstance(node.get("@type"), list) else [node.get("@type")]
    return any(isinstance(k, str) and k.lower() in ARTICLES for k in kinds)


def page_of(html: str | None, url: str | None = None) -> dict:
    """The fields of PRECEDENCE, authors in order without repeats, and the main content as Markdown; url resolves the canonical link.

    A title, an author and a date that are declared nowhere are taken from the page: its first heading, its byline, its first time element.
    """
    root = content.tree_of(html)
    declared = _Declared(root)
    nodes = []
    for text in declared.scripts:
        try:
            nodes += _nodes(json.loads(text))
        except ValueError:
            continue
    nodes = [n for n in nodes if _is_article(n)] or nodes
    places = {"ld": lambda keys: [n.get(k) for n in nodes for k in keys], "meta": lambda keys: [v for k in keys for v in declared.meta.get(k, [])], "page": lambda keys: [declared.own[k] for k in keys]}
    out = {}
    for name, rules in PRECEDENCE.items():
        values = (v for place, keys in rules for v in places[place](keys))
        out[name] = next((" ".join(v.split()) for v in values if isinstance(v, str) and v.strip()), None)
    if out["declared_canonical_url"]:
        out["declared_canonical_url"] = resolve(url, out["declared_canonical_url"])
    authors = [a for n in nodes for a in _authors(n.get("author"))] + _authors(places["meta"](AUTHOR_KEYS))
    out["title"] = out["title"] or content.title_of(root, content.content_of(root))
    out["published_at"] = out["published_at"] or content.date_of(root)
    return out | {"authors": list(dict.fromkeys(authors)) or _authors(content.author_of(root)), "markdown": main_markdown(root)}


@F.pandas_udf(ArrayType(StringType()))
def hrefs(html: pd.Series) -> pd.Series:
    """links_of() over a column; none for null."""
    return html.map(lambda x: [] if x is None else links_of(x))


_FIELDS = pa.struct([("title", pa.string()), ("authors", pa.list_(pa.string())), *[(f, pa.string()) for f in ("published_at", "modified_at", "language", "declared_canonical_url", "site_name", "description", "markdown")]])
_PAGE = "page struct<title:string,authors:array<string>,published_at:string,modified_at:string,language:string,declared_canonical_url:string,site_name:string,description:string,markdown:string>"


def page_links(pages: DataFrame, keys: list[str], html: str) -> DataFrame:
    """``keys, href`` for each link of each page."""
    schema = StructType([*pages.select(*keys).schema, *StructType.fromDDL("href string")])

    def run(batches):
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(batch.column(len(keys)).to_pylist()):
                own = links_of(text)
                at += [i] * len(own)
                found += own
            kept = [batch.column(k).take(pa.array(at, pa.int32())) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], schema.names)

    return pages.select(*keys, html).mapInArrow(run, schema)


def page_metadata(pages: DataFrame, html: str, url: str | None = None) -> DataFrame:
    """pages with a struct column page: declared metadata and Markdown; url names the column that a canonical link is resolved against.

    Pages are parsed once each, in batches beside their other columns.
    """
    schema = StructType([*pages.schema, *StructType.fromDDL(_PAGE)])

    def run(batches):
        for batch in batches:
            bases = batch.column(url).to_pylist() if url else [None] * batch.num_rows
            made = [page_of(x, b) for x, b in zip(batch.column(html).to_pylist(), bases, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, _FIELDS)], schema.names)

    return pages.mapInArrow(run, schema)
