"""Tables and texts inside files: delimited text, word processor and spreadsheet packages, e-books."""

from __future__ import annotations

import csv
import io
import json
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from siltstone.operators.html import markdown_of
from siltstone.sources.readers import MOST_BYTES, MOST_FILES, MOST_RATIO, detect_delimiter

TABLE = "path string, delimiter string, headers array<string>, place int, cells array<string>, record string"
TEXTS = "path string, kind string, part string, place int, title string, text string"


def delimited_rows(text: str, delimiter: str | None = None, header: bool = True, most: int | None = None) -> tuple[str, list[str], list[list[str]]]:
    """(delimiter, headers, rows) of delimited text; quoted cells may hold delimiters and line ends, blank rows go."""
    text = text.strip()
    delimiter = delimiter or detect_delimiter(text)
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter) if any(c.strip() for c in r)]
    width = max(map(len, rows), default=0)
    if header and rows:
        headers, rows = [c.strip() or f"column_{k + 1}" for k, c in enumerate(rows[0])], rows[1:]
    else:
        headers = [f"column_{k + 1}" for k in range(width)]
    return delimiter, headers, rows[:most] if most else rows


def delimited_tables(files: DataFrame, header: bool = True, most: int | None = None) -> DataFrame:
    """Rows of ``files(path, content)``: cells, and a record by header as JSON."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                delimiter, headers, rows = delimited_rows(content.decode("utf-8", "replace").removeprefix("﻿"), None, header, most)
                for k, cells in enumerate(rows):
                    record = {h: (cells[i] if i < len(cells) else "").strip() for i, h in enumerate(headers)}
                    out.append((path, delimiter, headers, k, cells, json.dumps(record, ensure_ascii=False)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in TABLE.split(", ")])

    return files.select("path", "content").mapInPandas(run, TABLE)


def markdown_table(headers: list[str], rows: list[list[str]]) -> str:
    def line(cells: list[str]) -> str:
        return "| " + " | ".join(c.replace("|", r"\|").replace("\n", " ") for c in cells) + " |"

    return "\n".join([line(headers), line(["---"] * len(headers)), *(line((r + [""] * len(headers))[: len(headers)]) for r in rows)])


def _local(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _text(e: ET.Element) -> str:
    """Text runs below an element; tabs and breaks as such."""
    return "".join((x.text or "") if _local(x) == "t" else "\t" if _local(x) == "tab" else "\n" if _local(x) == "br" else "" for x in e.iter())


def word_document(z: zipfile.ZipFile) -> Iterator[tuple[str, int, str, str]]:
    """Paragraphs and tables of the body, in order; headings with marks."""
    body = next(e for e in ET.fromstring(z.read("word/document.xml")).iter() if _local(e) == "body")
    parts = []
    for e in body:
        if _local(e) == "p" and _text(e).strip():
            style = next((v for x in e.iter() if _local(x) == "pStyle" for k, v in x.attrib.items() if k.endswith("val")), "")
            level = re.fullmatch(r"(?i)heading\s*([1-6])", style)
            parts.append(f"{'#' * int(level[1])} {_text(e).strip()}" if level else _text(e).strip())
        elif _local(e) == "tbl":
            rows = [[_text(c).strip() for c in r if _local(c) == "tc"] for r in e if _local(r) == "tr"]
            if rows:
                parts.append(markdown_table(rows[0], rows[1:]))
    yield "document", 0, "", "\n\n".join(parts)


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", reference)[0]:
        n = 26 * n + ord(c) - 64
    return max(0, n - 1)


def spreadsheet(z: zipfile.ZipFile) -> Iterator[tuple[str, int, str, str]]:
    """Each sheet as a Markdown table; cells by their references, shared strings resolved."""
    shared = [_text(e) for e in ET.fromstring(z.read("xl/sharedStrings.xml")) if _local(e) == "si"] if "xl/sharedStrings.xml" in z.namelist() else []
    names = [e.get("name", "") for e in ET.fromstring(z.read("xl/workbook.xml")).iter() if _local(e) == "sheet"] if "xl/workbook.xml" in z.namelist() else []
    sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for place, member in enumerate(sheets):
        grid: list[list[str]] = []
        for row in (e for e in ET.fromstring(z.read(member)).iter() if _local(e) == "row"):
            cells: dict[int, str] = {}
            for k, c in enumerate(e for e in row if _local(e) == "c"):
                raw = next((v.text or "" for v in c if _local(v) == "v"), "")
                at = _column(c.get("r", "")) if c.get("r") else k
                cells[at] = shared[int(raw)] if c.get("t") == "s" and raw.isdigit() and int(raw) < len(shared) else _text(c) if c.get("t") == "inlineStr" else raw
            if cells:
                grid.append([cells.get(k, "") for k in range(max(cells) + 1)])
        if grid:
            width = max(map(len, grid))
            grid = [r + [""] * (width - len(r)) for r in grid]
            yield member, place, names[place] if place < len(names) else "", markdown_table(grid[0], grid[1:])


def e_book(z: zipfile.ZipFile) -> Iterator[tuple[str, int, str, str]]:
    """Chapters in the order of the spine, as Markdown, under the titles of the table of contents."""
    box = ET.fromstring(z.read("META-INF/container.xml"))
    opf = next(e.get("full-path") for e in box.iter() if _local(e) == "rootfile")
    package, base = ET.fromstring(z.read(opf)), posixpath.dirname(opf)
    items = {e.get("id"): posixpath.normpath(posixpath.join(base, e.get("href", ""))) for e in package.iter() if _local(e) == "item"}
    titles: dict[str, str] = {}
    for ncx in (p for p in items.values() if p.endswith(".ncx") and p in z.namelist()):
        for point in (e for e in ET.fromstring(z.read(ncx)).iter() if _local(e) == "navPoint"):
            source = next((e.get("src", "") for e in point if _local(e) == "content"), "").split("#")[0]
            label = next(("".join(x.text or "" for x in e.iter()) for e in point if _local(e) == "navLabel"), "")
            titles.setdefault(posixpath.normpath(posixpath.join(posixpath.dirname(ncx), source)), label.strip())
    for place, ref in enumerate(e.get("idref") for e in package.iter() if _local(e) == "itemref"):
        if (path := items.get(ref)) in z.namelist():
            yield path, place, titles.get(path, ""), markdown_of(z.read(path).decode("utf-8", "replace"))


KINDS = (("word/document.xml", "word", word_document), ("xl/workbook.xml", "sheet", spreadsheet), ("META-INF/container.xml", "book", e_book))


def package_texts(files: DataFrame) -> DataFrame:
    """(path, kind, part, place, title, text) of packages ``files(path, content)``; what is none, or damaged, gives a row of kind ``unreadable``.

    The bomb guard of archives holds for packages too.
    """

    def texts(path: str, content: bytes) -> list[tuple]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                size = sum(i.file_size for i in z.infolist())
                if len(z.infolist()) > MOST_FILES or size > min(MOST_BYTES, MOST_RATIO * max(1, len(content))):
                    raise ValueError("more than a package may hold")
                for mark, kind, read in KINDS:
                    if mark in z.namelist():
                        return [(path, kind, *row) for row in read(z)]
        except (zipfile.BadZipFile, ET.ParseError, KeyError, StopIteration, ValueError) as e:
            return [(path, "unreadable", "", 0, type(e).__name__, "")]
        return [(path, "unreadable", "", 0, "unknown", "")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([r for p, c in zip(b["path"], b["content"]) for r in texts(p, c)], columns=[x.split()[0] for x in TEXTS.split(", ")])

    return files.select("path", "content").mapInPandas(run, TEXTS)
