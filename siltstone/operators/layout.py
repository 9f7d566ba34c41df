"""Page layout: repeated headers and footers, columns of positioned text, and pages joined for reading.

Pages are rows (document, page, text or items); items are structs (str, x, y, eol) with y growing upwards. What is voted on
is grouped by document; a document keeps a handful of repeated lines at most, as each must stand on half of its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as t

#: Pages from which lines are voted on, lines of a zone, share of pages, height of a zone, width of a gutter.
LEAST_PAGES, ZONE_LINES, SHARE, ZONE_HEIGHT, GUTTER = 3, 2, 0.5, 0.08, 20.0
#: Page numbers and rules between pages.
PAGE_MARKS = (r"^[-—–\s]*\d+[-—–\s]*$", r"(?i)^Sayfa\s+\d+$", r"^[<\s>•.\-_=]{4,}$")

ITEMS = "array<struct<str: string, x: double, y: double, eol: boolean>>"


def _repeated(candidates: DataFrame, pages: DataFrame, doc: str, least: Column) -> DataFrame:
    """(doc, repeated): lines of ``candidates(doc, zone, line)`` that stand in a zone of ``least`` pages or more; n is the count of pages."""
    n = pages.groupBy(F.col(doc).alias("own")).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    votes = candidates.groupBy(F.col(doc).alias("own"), "zone", "line").agg(F.count("*").alias("votes"))
    return votes.join(n, "own").where(F.col("votes") >= least).groupBy("own").agg(F.collect_set("line").alias("repeated"))


def _zone(lines: Column, zone: str) -> Column:
    kept = F.array_distinct(F.filter(lines, lambda x: x != ""))
    return F.transform(kept, lambda x: F.struct(F.lit(zone).alias("zone"), x.alias("line")))


def without_page_boilerplate(pages: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``pages`` without the lines that stand among the first or last two of half of a document's pages; three pages at least."""
    lines = F.transform(F.split(text, "\n"), t.strip)
    top, bottom = F.slice(lines, 1, ZONE_LINES), F.slice(lines, F.greatest(F.lit(1), F.size(lines) - (ZONE_LINES - 1)), F.lit(ZONE_LINES))
    candidates = pages.select(doc, F.inline(F.concat(_zone(top, "top"), _zone(bottom, "bottom"))))
    found = _repeated(candidates, pages, doc, F.col("n") * SHARE)
    joined = pages.join(found, F.col(doc) == F.col("own"), "left")
    rest = t.strip(F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("repeated", t.strip(x))), "\n"))
    return joined.withColumn(text, F.when(F.col("repeated").isNull(), F.col(text)).otherwise(rest)).select(*pages.columns)


def without_repeated_items(pages: DataFrame, doc: str = "doc_id", items: str = "items") -> DataFrame:
    """The same for positioned text: zones are the top and bottom eight hundredths of a page's height."""
    ys = F.transform(items, lambda i: i["y"])
    pages_ = pages.withColumns({"__low": F.array_min(ys), "__high": F.array_max(ys)})
    reach = (F.col("__high") - F.col("__low")) * ZONE_HEIGHT
    flat = F.col("__high") <= F.col("__low")

    def in_top(i: Column) -> Column:
        return i["y"] >= F.col("__high") - reach

    def in_bottom(i: Column) -> Column:
        return i["y"] <= F.col("__low") + reach

    def names(test) -> Column:
        return F.transform(F.filter(items, test), lambda i: t.strip(i["str"]))

    candidates = pages_.where(~flat).select(doc, F.inline(F.concat(_zone(names(in_top), "top"), _zone(names(in_bottom), "bottom"))))
    found = _repeated(candidates, pages, doc, F.col("n") * SHARE)
    joined = pages_.join(found, F.col(doc) == F.col("own"), "left")
    rest = F.filter(items, lambda i: ~((in_top(i) | in_bottom(i)) & F.array_contains("repeated", t.strip(i["str"]))))
    return joined.withColumn(items, F.when(F.col("repeated").isNull() | flat, F.col(items)).otherwise(rest)).select(*pages.columns)


def column_edges(items: Column, gutter: float = GUTTER) -> Column:
    """Left edges of columns: the first, and wherever the histogram of left edges has a gap as wide as a gutter."""
    width = max(4.0, gutter / 4)
    xs = F.transform(F.filter(items, lambda i: t.strip(i["str"]) != ""), lambda i: i["x"])

    def edges(x: Column) -> Column:
        first = F.array_min(x)
        bins = F.array_sort(F.array_distinct(F.transform(x, lambda v: F.floor((v - first) / width))))

        def jumps(b: Column) -> Column:
            return F.transform(F.filter(b, lambda v, k: (k > 0) & ((v - F.get(b, k - 1)) * width >= gutter)), lambda v: first + v * width)

        wide = F.array_max(x) - first >= 2 * gutter
        return F.when(F.size(x) == 0, F.array(F.lit(0.0))).when(~wide, F.array(first)).otherwise(F.concat(F.array(first), t.let(bins, jumps)))

    return t.let(xs, edges)


def reading_order(items: Column, gutter: float = GUTTER) -> Column:
    """Text of a page's items: column by column from the left, each from the top, columns one blank line apart."""

    def joined(of: Column) -> Column:
        return t.strip(F.array_join(F.transform(of, lambda i: F.concat(i["str"], F.when(i["eol"], "\n").otherwise(""))), ""))

    def by_columns(edges: Column) -> Column:
        def column(edge: Column, k: Column) -> Column:
            last = F.get(edges, k + 1)
            mine = F.filter(items, lambda i: ((k == 0) | (i["x"] >= edge - 2)) & (last.isNull() | (i["x"] < last - 2)))
            down = F.array_sort(F.transform(mine, lambda i, n: F.struct((-i["y"]).alias("y"), n.alias("n"), i["str"].alias("str"), i["eol"].alias("eol"))))
            return joined(down)

        parts = F.filter(F.transform(edges, column), lambda x: x != "")
        return F.when(F.size(edges) <= 1, joined(items)).otherwise(F.array_join(parts, "\n\n"))

    return F.when(F.size(items) == 0, "").otherwise(t.let(column_edges(items, gutter), by_columns))


def readable_documents(pages: DataFrame, doc: str = "doc_id", page: str = "page", text: str = "text") -> DataFrame:
    """(doc, text): pages without boilerplate, page numbers and rules, joined over page ends.

    A word cut by a hyphen goes on; after a sentence's end a paragraph begins, else a blank is put between. Lines vote on
    pages of more than four lines; a line goes that half of all pages (two at least) have.
    """
    lines = F.filter(F.transform(F.split(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), "\n"), t.strip), lambda x: x != "")
    rows = pages.select(doc, page, lines.alias("lines"))
    edge = F.array_distinct(F.concat(F.slice("lines", 1, ZONE_LINES), F.slice("lines", F.greatest(F.lit(1), F.size("lines") - (ZONE_LINES - 1)), F.lit(ZONE_LINES))))
    worth = F.filter(edge, lambda x: (F.length(x) > 4) & ~x.rlike(r"^\d+$"))
    votes = rows.where(F.size("lines") > 4).select(doc, F.lit("").alias("zone"), F.explode(worth).alias("line"))
    found = _repeated(votes, rows, doc, F.greatest(F.lit(2), F.floor(F.col("n") * SHARE)))

    def stays(x: Column) -> Column:
        out = ~F.coalesce(F.array_contains("repeated", x), F.lit(False))
        for mark in PAGE_MARKS:
            out = out & ~x.rlike(mark)
        return out

    kept = rows.join(found, F.col(doc) == F.col("own"), "left").select(doc, page, F.array_join(F.filter("lines", stays), "\n").alias("body"))
    ordered = kept.where("body <> ''").groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(page, "body"))).alias("all"))

    def add(acc: Column, x: Column) -> Column:
        hyphen = acc.rlike(r"\p{L}-$") & x.rlike(r"^\p{L}")
        plain = F.concat(acc, F.when(acc.rlike("[.!?:;]$"), "\n\n").otherwise(" "), x)
        return F.when(acc == "", x).when(hyphen, F.concat(F.substring(acc, F.lit(1), F.length(acc) - 1), x)).otherwise(plain)

    whole = F.aggregate(F.transform("all", lambda x: x["body"]), F.lit(""), add)
    whole = t.sub(t.sub(t.sub(whole, r"(\p{L})-\n+\s*(\p{L})", "$1$2"), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return ordered.select(doc, t.strip_invisible(t.strip(whole)).alias("text"))


#: Share of broken characters, text from which it is looked at, text a page must have.
BROKEN_SHARE, BROKEN_FROM, PAGE_CHARS = 0.3, 20, 15


def text_layer_class(header: Column, locked: Column, texts: Column, images: Column) -> Column:
    """What is wrong with a paged text layer, if anything: the first that holds, in fixed order."""
    whole = F.array_join(texts, "")
    solid = F.length(t.strip(whole))
    broken = F.length(whole) - F.length(t.sub(whole, r"[\x{FFFD}\x00-\x08]", ""))
    return (
        F.when(~header, "CORRUPT_PAYLOAD")
        .when(locked, "PASSWORD_PROTECTED")
        .when((F.length(whole) > BROKEN_FROM) & (broken / F.length(whole) >= BROKEN_SHARE), "ENCODING_ERROR")
        .when((solid == 0) & (images > 0), "SCANNED_IMAGE_ONLY")
        .when(solid / F.greatest(F.lit(1), F.size(texts)) < PAGE_CHARS, "EMPTY_TEXT_LAYER")
        .otherwise("EXTRACTABLE")
    )
