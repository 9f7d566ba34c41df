"""HTML to rows: tables, linked data, meta tags, readable text. Pages are parsed in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

CLUTTER = frozenset(["script", "style", "nav", "footer", "header", "aside", "noscript", "form", "iframe", "svg"])
_BLOCKS = frozenset("p div section article main li ul ol table tr h1 h2 h3 h4 h5 h6 br blockquote pre".split())


class _Tables(HTMLParser):
    """Cells of top-level tables; nested ones add nothing to the outer cells."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[tuple[str, bool]]]] = []
        self.depth, self.cell, self.span, self.head = 0, None, 1, False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
        elif self.depth == 1 and tag == "tr":
            self.tables[-1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._close()
            span = dict(attrs).get("colspan") or "1"
            self.cell, self.head, self.span = [], tag == "th", max(1, min(1000, int(span))) if span.isdigit() else 1

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr") and self.depth == 1:
            self._close()
        if tag == "table" and self.depth:
            if self.depth == 1:
                self._close()
            self.depth -= 1

    def handle_data(self, data):
        if self.depth == 1 and self.cell is not None:
            self.cell.append(data)

    def _close(self):
        if self.cell is not None and self.tables:
            if not self.tables[-1]:
                self.tables[-1].append([])
            text = " ".join("".join(self.cell).split())
            self.tables[-1][-1] += [(text, self.head)] * self.span
        self.cell = None


def parse_tables(html: str) -> list[tuple[list[str], list[list[str]]]]:
    """(headers, rows) of each table; missing headers are ``Column n``, blank rows go."""
    parser = _Tables()
    parser.feed(html or "")
    parser.close()
    out = []
    for grid in parser.tables:
        grid = [r for r in grid if any(text for text, _ in r)]
        if not grid:
            continue
        width = max(map(len, grid))
        headed = all(head for _, head in grid[0])
        first = [text for text, _ in grid[0]] if headed else []
        headers = [(first[k] if k < len(first) and first[k] else f"Column {k + 1}") for k in range(width)]
        rows = [[text for text, _ in r] + [""] * (width - len(r)) for r in grid[headed:]]
        out.append((headers, rows))
    return out


def markdown_table(headers: list[str], rows: list[list[str]]) -> str:
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(headers), line(["---"] * len(headers)), *map(line, rows)])


class _Readable(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skip, self.out, self.inside, self.main = 0, [], "", 0

    def handle_starttag(self, tag, attrs):
        if tag in CLUTTER:
            self.skip += 1
        elif tag == "title":
            self.inside = "title"
        elif tag in ("main", "article"):
            self.main += 1
        if tag in _BLOCKS and self.main and not self.skip:
            level = int(tag[1]) if re.fullmatch("h[1-6]", tag) else 0
            self.out.append("\n\n" + "#" * level + " " if level else "\n- " if tag == "li" else "\n")

    def handle_endtag(self, tag):
        if tag in CLUTTER and self.skip:
            self.skip -= 1
        elif tag == "title":
            self.inside = ""
        elif tag in ("main", "article") and self.main:
            self.main -= 1
        if tag in _BLOCKS and self.main and not self.skip:
            self.out.append("\n")

    def handle_data(self, data):
        if self.main and not self.skip and not self.inside:
            self.out.append(data)


_AUTHOR = re.compile(r"(?is)<meta[^>]*name=[\"']author[\"'][^>]*content=[\"']([^\"']*)|<[^>]*(?:rel=[\"']author|class=[\"'][^\"']*(?:byline|author))[^>]*>([^<]*)<")


def byline(html: str) -> str:
    """The author that a page names, or an empty string."""
    m = _AUTHOR.search(html or "")
    return " ".join((m[1] or m[2] or "").split()) if m else ""


_TITLE = re.compile(r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>")


def title_of(page: str | None, references: tuple[str, ...] = ()) -> str | None:
    """The first title of a page, or an empty string; null for no page.

    All character references are decoded as browsers do, or only those named, with their semicolons.
    """
    if page is None:
        return None
    m = _TITLE.search(page)
    title = re.sub(r"[\t\n\f\r ]+", " ", m[1]).strip(" ") if m else ""
    return re.sub(f"&(?:{'|'.join(references)});", lambda r: unescape(r[0]), title) if references else unescape(title)


def markdown_of(html: str) -> str:
    return readable(html)[1]


def readable(html: str) -> tuple[str, str]:
    """(title, Markdown) of the main part of a page, without clutter; of all of it where no part is marked as main."""
    parser = _Readable()
    if not re.search(r"(?i)<(main|article)[\s>]", html or ""):
        parser.main = 1
    parser.feed(html or "")
    parser.close()
    lines = [" ".join(x.split()) for x in "".join(parser.out).split("\n")]
    return title_of(html) or "", re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def readable_pages(pages: DataFrame, key: str, html: str, references: tuple[str, ...] = ()) -> DataFrame:
    """(key, title, byline, markdown); ``references`` as for ``title_of``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [readable(x) for x in b[html]]
            yield pd.DataFrame({key: b[key], "title": [title_of(x, references) for x in b[html]], "byline": [byline(x) for x in b[html]], "markdown": [r[1] for r in rows]})

    return pages.select(key, html).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, title string, byline string, markdown string")


def tables_of(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row for each table: place, headers, rows as JSON and Markdown."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, n, h, json.dumps(r, ensure_ascii=False), markdown_table(h, r)) for k, x in zip(b[key], b[html]) for n, (h, r) in enumerate(parse_tables(x))]
            yield pd.DataFrame(out, columns=[key, "place", "headers", "rows", "markdown"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, place int, headers array<string>, rows string, markdown string")


def linked_data(html: Column) -> Column:
    """JSON-LD scripts as JSON texts; what does not parse is skipped, arrays are flattened."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    parts = F.transform(raw, lambda x: F.coalesce(F.from_json(x, "array<string>"), F.array(x)))
    return F.filter(F.flatten(parts), lambda x: F.expr("true") & F.get_json_object(x, "$").isNotNull())


@F.pandas_udf(MapType(StringType(), StringType()))
def _last_wins(s: pd.Series) -> pd.Series:
    return s.map(lambda pairs: None if pairs is None else dict((p["k"], p["v"]) for p in pairs if p["k"]))


def meta_tags(html: Column) -> Column:
    """Names (or properties) of meta tags with their contents; the last of a name wins."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\s[^>]*>"), F.lit(0))
    entries = F.transform(tags, lambda x: F.struct(F.lower(F.regexp_extract(x, r"(?i)(?:name|property)=[\"']([^\"']+)", 1)).alias("k"), F.trim(F.regexp_extract(x, r"(?i)content=[\"']([^\"']*)", 1)).alias("v")))
    return _last_wins(entries)
