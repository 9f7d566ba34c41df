"""Paged and linked sources over pages that were fetched before: sitemaps and feeds, bucket listings, harvests with tokens.

A service is reached through a folder of page files here (``Harvest``); another ``fetch`` is all that a real one needs. Pages
that link to pages are followed by joins against a table of fetched pages, one a level.
"""

from __future__ import annotations

import gzip
import json
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltstone.functions import web
from siltstone.session import ensure_checkpoints

ENTRIES = "url string, kind string, place int, loc string, lastmod string, changefreq string, priority double"


def _tag(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _texts(e: ET.Element) -> dict[str, str]:
    """Text of an element's children by name; the first of a name."""
    out: dict[str, str] = {}
    for child in e:
        out.setdefault(_tag(child), (child.text or "").strip() or child.get("href", ""))
    return out


def xml_of(content: bytes) -> ET.Element | None:
    """The root of an XML text, plain or gzipped; null if it is none."""
    try:
        return ET.fromstring(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)
    except (ET.ParseError, OSError, EOFError):
        return None


def sitemap_entries(url: str, content: bytes) -> Iterator[tuple]:
    root = xml_of(content or b"")
    if root is None:
        return
    named = [(k, [e for e in root.iter() if _tag(e) in tags]) for k, tags in (("index", ("sitemap",)), ("urls", ("url",)), ("feed", ("item", "entry")))]
    kind, found = next(((k, x) for k, x in named if x), ("", []))
    for place, e in enumerate(found):
        t = _texts(e)
        loc = t.get("link" if kind == "feed" else "loc", "")
        if loc:
            stamp = t.get("pubDate") or t.get("updated") if kind == "feed" else t.get("lastmod")
            yield url, kind, place, loc, stamp or None, t.get("changefreq") or None, float(pd.to_numeric(t.get("priority", ""), errors="coerce"))


def parsed(pages: DataFrame, parse: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of ``parse(url, content)`` for each of ``pages(url, content)``."""
    names = _parse_datatype_string(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([r for u, c in zip(b["url"], b["content"]) for r in parse(u, c)], columns=names)

    return pages.select("url", "content").mapInPandas(run, schema)


def crawl_sitemaps(pages: DataFrame, root: str, depth: int = 3, most: int | None = None, patterns: list[str] | None = None) -> DataFrame:
    """(loc, lastmod, changefreq, priority, level) from a root through indexes below; pages that are missing or no XML are passed over.

    ``most`` keeps the first entries in the order of levels, pages and places.
    """
    ensure_checkpoints(pages.sparkSession)
    every = parsed(pages, sitemap_entries, ENTRIES).checkpoint()
    frontier = pages.sparkSession.createDataFrame([(root,)], "at string")
    out, seen = None, frontier
    for level in range(depth + 1):
        here = every.join(frontier, F.col("url") == F.col("at"), "left_semi").withColumn("level", F.lit(level))
        kept = here.where("kind <> 'index'")
        out = kept if out is None else out.unionByName(kept)
        frontier = here.where("kind = 'index'").select(F.col("loc").alias("at")).distinct().join(seen.withColumnRenamed("at", "old"), F.col("at") == F.col("old"), "left_anti").checkpoint()
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    if patterns:
        keep = F.lit(False)
        for p in patterns:
            keep = keep | web.matches_pattern(F.col("loc"), p)
        out = out.where(keep)
    if most is not None:
        out = out.orderBy("level", "url", "place").limit(most)
    return out.select("loc", "lastmod", "changefreq", "priority", "level")


LISTING = "url string, prefix string, is_prefix boolean, key string, size long, modified string, next_marker string"


def bucket_entries(url: str, content: bytes) -> Iterator[tuple]:
    root = xml_of(content or b"")
    if root is None:
        return
    top = _texts(root)
    marker = (top.get("NextMarker") or None) if top.get("IsTruncated", "false").lower() == "true" else None
    keys = [(False, _texts(e)) for e in root.iter() if _tag(e) == "Contents"] + [(True, _texts(e)) for e in root.iter() if _tag(e) == "CommonPrefixes"]
    if marker is None and top.get("IsTruncated", "false").lower() == "true":
        marker = max((t.get("Key", "") for folder, t in keys if not folder), default=None)
    for folder, t in keys:
        yield url, top.get("Prefix", ""), folder, t.get("Prefix" if folder else "Key", ""), None if folder else int(t.get("Size") or 0), t.get("LastModified") or None, marker


def bucket_tree(pages: DataFrame, prefix: str = "", depth: int = 8) -> DataFrame:
    """(key, size, modified) of all objects below a prefix, from listing pages named ``prefix?marker``."""
    ensure_checkpoints(pages.sparkSession)
    every = parsed(pages, bucket_entries, LISTING).checkpoint()
    frontier = pages.sparkSession.createDataFrame([(f"{prefix}?",)], "at string")
    out = None
    for _ in range(depth):
        here = every.join(frontier, F.col("url") == F.col("at"), "left_semi")
        found = here.where(~F.col("is_prefix")).select("key", "size", "modified")
        out = found if out is None else out.unionByName(found)
        below = here.where("is_prefix").select(F.concat("key", F.lit("?")).alias("at"))
        more = here.where("next_marker IS NOT NULL").select(F.concat("prefix", F.lit("?"), "next_marker").alias("at"))
        frontier = below.unionByName(more).distinct().checkpoint()
        if frontier.isEmpty():
            break
    return out


BOOKS = "book_id int, title string, creators string, language string, formats map<string,string>"
_RDF = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}"


def catalogue_books(_: str, content: bytes) -> Iterator[tuple]:
    """Books of an RDF file: those with a type of value ``Text``, their number from the last path segment, files by media type."""
    root = xml_of(content or b"")
    for book in [] if root is None else [e for e in root.iter() if _tag(e) == "ebook"]:
        number = book.get(f"{_RDF}about", "").rsplit("/", 1)[-1]
        kinds = {(v.text or "").strip() for e in book.iter() if _tag(e) == "type" for v in e.iter() if _tag(v) == "value"}
        if "Text" not in kinds or not number.isdigit():
            continue
        names = [(n.text or "").strip() for e in book.iter() if _tag(e) == "creator" for n in e.iter() if _tag(n) == "name"]
        tongue = next((v.text.strip() for e in book.iter() if _tag(e) == "language" for v in e.iter() if _tag(v) == "value" and v.text), "")
        formats: dict[str, str] = {}
        for e in book.iter():
            if _tag(e) == "file":
                media = next((v.text.strip() for f in e.iter() if _tag(f) == "format" for v in f.iter() if _tag(v) == "value" and v.text), "")
                formats.setdefault(media, e.get(f"{_RDF}about", ""))
        title = next(((e.text or "").strip() for e in book.iter() if _tag(e) == "title"), "")
        yield int(number), title, "; ".join(names), tongue, formats


# --- harvests with tokens --------------------------------------------------------------------------------------------


def oai_page(content: bytes) -> tuple[list[str | None], str | None]:
    """Records (as JSON: id, datestamp and lists of Dublin Core fields; null for a deleted one) and the next token; an error page raises."""
    root = ET.fromstring(content)
    if (error := next((e for e in root.iter() if _tag(e) == "error"), None)) is not None:
        raise LookupError(error.get("code", ""))
    rows: list[str | None] = []
    for record in (e for e in root.iter() if _tag(e) == "record"):
        head = next(e for e in record if _tag(e) == "header")
        fields: dict[str, list[str]] = {}
        for e in record.iter():
            if e.tag.startswith("{http://purl.org/dc/elements/1.1/}") and (e.text or "").strip():
                fields.setdefault(_tag(e), []).append(e.text.strip())
        t = _texts(head)
        deleted = head.get("status") == "deleted"
        rows.append(None if deleted else json.dumps({"id": t.get("identifier", ""), "datestamp": t.get("datestamp", ""), "dc": fields}, ensure_ascii=False))
    token = next((e.text for e in root.iter() if _tag(e) == "resumptionToken"), None)
    return rows, (token or "").strip() or None


def json_page(content: bytes, items: tuple[str, ...] = ("results", "data", "items", "articles")) -> tuple[list[str], str | None]:
    """Items of a page, whatever their list is called, and the next cursor or token."""
    data = json.loads(content)
    rows = data if isinstance(data, list) else next((data[k] for k in items if isinstance(data.get(k), list)), [])
    meta = {} if isinstance(data, list) else {**data, **(data.get("meta") or {})}
    token = next((str(meta[k]) for k in ("next_cursor", "token", "next") if meta.get(k)), None)
    return [json.dumps(x, ensure_ascii=False) for x in rows], token


def chained(fetch: Callable[[str | None], bytes], parse: Callable[[bytes], tuple[list[str | None], str | None]], most: int | None = None, restarts: int = 1) -> Iterator[tuple[str, str]]:
    """(token, item) page after page, until there is no next token, a page is empty, or ``most`` items were given.

    Null items stand for what is not given, such as deleted records; a page of these alone is not empty.
    A token that the service rejects starts the harvest anew from the root, so often as allowed; what was given is not given again.
    """
    token, given, seen = None, 0, set()
    while True:
        try:
            rows, after = parse(fetch(token))
        except LookupError:
            if token is None or not restarts:
                raise
            token, restarts = None, restarts - 1
            continue
        for row in rows:
            if row is None or row in seen:
                continue
            seen.add(row)
            yield token or "", row
            given += 1
            if most is not None and given >= most:
                return
        if not rows or after is None or after == token:
            return
        token = after


class Harvest(DataSource):
    """``format("siltstone-harvest")``: items of a service whose pages name the next one.

    Options: ``folder`` of page files named by token (``start`` for the first), ``kind`` (oai or json), ``sets`` (comma-separated
    sub-folders, each a partition of its own) and ``most``. Pages of one chain follow each other, so a chain is one task; chains
    run side by side.
    """

    @classmethod
    def name(cls) -> str:
        return "siltstone-harvest"

    def schema(self) -> str:
        return "chain string, token string, item string"

    def reader(self, schema) -> DataSourceReader:
        return _HarvestReader(self.options)


class _HarvestReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.folder, self.kind = options["folder"], options.get("kind", "json")
        self.sets = [s for s in options.get("sets", "").split(",") if s]
        self.most = int(options["most"]) if options.get("most") else None

    def partitions(self):
        return [InputPartition(s) for s in self.sets or [""]]

    def read(self, partition):
        from siltstone.sources.files import open_uri

        base = f"{self.folder}/{partition.value}".rstrip("/")

        def fetch(token: str | None) -> bytes:
            fs, path = open_uri(f"{base}/{token or 'start'}")
            try:
                with fs.open_input_stream(path, compression=None) as f:
                    return f.read()
            except FileNotFoundError:
                raise LookupError("badResumptionToken") from None

        for token, item in chained(fetch, oai_page if self.kind == "oai" else json_page, self.most):
            yield partition.value, token, item
