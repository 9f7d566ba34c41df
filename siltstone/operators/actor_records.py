"""Records of code benchmarks, proof wikis, proof libraries, paper feeds and media to rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as t
from siltstone.sources.feeds import _tag, _texts, parsed, xml_of

#: Where each benchmark keeps a task's parts, by preference.
CODE_FIELDS = {
    "humaneval": {"task_id": ["task_id"], "entry_point": ["entry_point"], "prompt": ["prompt"], "solution": ["canonical_solution"], "test": ["test"]},
    "mbpp": {"task_id": ["task_id", "id"], "entry_point": [], "prompt": ["text", "prompt"], "solution": ["code", "canonical_solution"], "test": ["test_list", "test"]},
    "swebench": {"task_id": ["instance_id", "task_id"], "entry_point": ["repo"], "prompt": ["problem_statement", "prompt"], "solution": ["patch"], "test": ["test_patch", "test"]},
    "generic": {"task_id": ["task_id", "id", "instance_id"], "entry_point": ["entry_point", "repo"], "prompt": ["prompt", "text", "problem_statement", "question"], "solution": ["canonical_solution", "code", "solution", "patch"], "test": ["test_list", "test", "test_patch"]},
}


def code_tasks(rows: DataFrame, benchmark: str) -> DataFrame:
    """(task_id, entry_point, prompt, solution, test, language) of ``rows(place, row)``, a row being JSON.

    A task without an id is named by its place; tests in a list stand one below the other.
    """
    fields = CODE_FIELDS.get(benchmark.replace("-", ""), CODE_FIELDS["generic"])
    j = F.col("row")

    def first(names: list[str]) -> Column:
        found = []
        for n in names:
            raw = F.get_json_object(j, f"$.{n}")
            listed = F.array_join(F.from_json(raw, "array<string>"), "\n")
            found.append(F.nullif(F.when(raw.startswith("["), listed).otherwise(raw) if n == "test_list" else raw, F.lit("")))
        return t.strip(F.coalesce(*found)) if found else F.lit(None).cast("string")

    named = {"humaneval": F.concat(F.lit("HumanEval/"), "place"), "swebench": F.concat(F.lit("swe-bench-"), F.col("place") + 1)}
    place = named.get(benchmark.replace("-", ""), (F.col("place") + 1).cast("string"))
    language = F.coalesce(F.get_json_object(j, "$.language"), F.lit("python")) if fields is CODE_FIELDS["generic"] else F.lit("python")
    columns = {n: first(names) for n, names in fields.items()}
    columns["task_id"] = F.coalesce(columns["task_id"], place)
    columns["prompt"] = F.coalesce(columns["prompt"], F.lit(""))
    return rows.select(*(c.alias(n) for n, c in columns.items()), language.alias("language"))


def wiki_sections(pages: DataFrame, key: str, text: str) -> DataFrame:
    """(key, theorem, proofs, definitions, sources) by the words in level-two headings; what stands before the first is the theorem by default."""
    parts = F.split(F.col(text), r"==\s*[^=]+?\s*==")
    heads = F.transform(F.regexp_extract_all(F.col(text), F.lit(r"==\s*([^=]+?)\s*=="), F.lit(1)), F.lower)
    rows = pages.select(key, F.transform(parts, t.strip).alias("parts"), heads.alias("heads"))
    pairs = F.transform("heads", lambda h, k: F.struct(h.alias("h"), F.get("parts", k + 1).alias("body")))
    words = {"theorem": ("theorem", "statement"), "proofs": ("proof",), "definitions": ("definition",), "sources": ("source",)}

    def has(kind: str, h: Column) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(h, F.lit(w)) for w in words[kind]))

    def of(kind: str) -> Column:
        # A heading counts for the first kind that it names.
        earlier = list(words)[: list(words).index(kind)]

        def test(p: Column) -> Column:
            return reduce(lambda a, e: a & ~has(e, p["h"]), earlier, has(kind, p["h"]))

        return F.transform(F.filter(pairs, test), lambda p: p["body"])

    lines = F.flatten(F.transform(of("sources"), lambda b: F.transform(F.split(b, "\n"), lambda x: t.strip(F.regexp_replace(x, r"^\*+\s*", "")))))
    theorem = F.coalesce(F.try_element_at(of("theorem"), F.lit(-1)), F.nullif(F.get("parts", F.lit(0)), F.lit("")))
    return rows.select(key, theorem.alias("theorem"), of("proofs").alias("proofs"), of("definitions").alias("definitions"), F.filter(lines, lambda x: x != "").alias("sources"))


#: What a declaration may begin with.
_MODIFIERS, _KINDS = ("protected", "private", "scoped", "noncomputable"), ("theorem", "lemma", "def", "axiom", "instance")
DECLARATIONS = "path string, place int, name string, kind string, docstring string, signature string, proof string, tactics array<string>"
_HEAD = re.compile(rf"(?:(?:{'|'.join(_MODIFIERS)}|@\[[^\]]*\])\s+)*({'|'.join(_KINDS)})\s+([\w.'’]+)(.*)", re.S)


def declarations_of(source: str) -> Iterator[tuple]:
    """(place, name, kind, docstring, signature, proof, tactics), block by block: a block begins where a line begins a declaration or its comment."""
    blocks: list[list[str]] = []
    doc = comment = False
    for line in source.split("\n"):
        starts = bool(_HEAD.match(line))
        if not comment and (line.startswith("/--") or (starts and not doc)):
            blocks.append([])
        if line.startswith("/--"):
            doc = True
        elif starts:
            doc = False
        comment = ("/-" in line or comment) and "-/" not in line
        if blocks:
            blocks[-1].append(line)
    for place, block in enumerate(blocks):
        said, _, code = "\n".join(block).rpartition("-/") if block[0].startswith("/--") else ("", "", "\n".join(block))
        if not (m := _HEAD.match(code.strip())):
            continue
        signature, assigned, proof = m[3].partition(":=")
        proof = proof.strip()
        steps = [x.strip() for x in proof.removeprefix("by").split("\n")] if proof.startswith("by") else []
        signature = signature.strip().removeprefix(":").strip()
        yield place, m[2], m[1], said.removeprefix("/--").strip() or None, signature, proof if assigned else None, [s for s in steps if s and not s.startswith("--")]


def declarations(files: DataFrame) -> DataFrame:
    """Declarations of ``files(path, source)`` of a proof library."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(p, *d) for p, s in zip(b["path"], b["source"]) for d in declarations_of(s or "")], columns=[x.split()[0] for x in DECLARATIONS.split(", ")])

    return files.select("path", "source").mapInPandas(run, DECLARATIONS)


FEED = "url string, place int, paper_id string, title string, summary string, authors array<string>, published string, primary_category string, categories array<string>, pdf_url string, html_url string"
_PAPER_ID = re.compile(r"(?:abs/)?([a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5}(?:v\d+)?)$", re.I)


def feed_papers(url: str, content: bytes) -> Iterator[tuple]:
    """Papers of an Atom feed."""
    root = xml_of(content or b"")
    for place, e in enumerate([] if root is None else [x for x in root.iter() if _tag(x) == "entry"]):
        t_ = {k: " ".join(v.split()) for k, v in _texts(e).items()}
        number = _PAPER_ID.search(t_.get("id", ""))
        kinds = list(dict.fromkeys(x.get("term") for x in e if _tag(x) == "category" and x.get("term")))
        first = next((x.get("term") for x in e if _tag(x) == "primary_category" and x.get("term")), kinds[0] if kinds else "")
        pdf = page = ""
        for link in (x for x in e if _tag(x) == "link"):
            href = link.get("href", "")
            if link.get("title") == "pdf" or link.get("type") == "application/pdf" or "/pdf/" in href:
                pdf = href
            elif link.get("rel") == "alternate" or "/abs/" in href:
                page = href
        names = [n for x in e if _tag(x) == "author" if (n := _texts(x).get("name", ""))]
        yield url, place, number[1] if number else t_.get("id", ""), t_.get("title", ""), t_.get("summary", ""), names, t_.get("published", ""), first, kinds, pdf, page


def papers_of_feeds(pages: DataFrame) -> DataFrame:
    return parsed(pages, feed_papers, FEED.replace("array<string>", "array<string>"))


def media_rows(raw: DataFrame) -> DataFrame:
    """(id, shortcode, media_type, caption, likes, comments) of media objects in ``raw(item)``, JSON; counts from the first path that has one."""

    def at(*paths: str) -> Column:
        return F.coalesce(*(F.nullif(F.get_json_object("item", f"$.{p}"), F.lit("")) for p in paths))

    def count(*paths: str) -> Column:
        return F.coalesce(*(F.nullif(F.get_json_object("item", f"$.{p}").try_cast("long"), F.lit(0).cast("long")) for p in paths), F.lit(0).cast("long"))

    kind = F.coalesce(F.get_json_object("item", "$.__typename"), F.lit(""))
    video = (F.get_json_object("item", "$.is_video") == "true") | (kind == "GraphVideo")
    several = (kind == "GraphSidecar") | F.get_json_object("item", "$.edge_sidecar_to_children").isNotNull() | F.coalesce(F.get_json_object("item", "$.carousel_media"), F.lit("")).startswith("[")
    plain = F.get_json_object("item", "$.caption")
    short = F.coalesce(at("shortcode", "code", "id"), F.lit(""))
    return raw.select(
        F.coalesce(at("id"), short).alias("id"),
        short.alias("shortcode"),
        F.when(F.coalesce(video, F.lit(False)), "video").when(several, "carousel").otherwise("image").alias("media_type"),
        F.coalesce(at("edge_media_to_caption.edges[0].node.text", "caption.text"), F.when(~plain.startswith("{"), plain), F.lit("")).alias("caption"),
        count("edge_liked_by.count", "edge_media_preview_like.count", "like_count").alias("likes"),
        count("edge_media_to_comment.count", "comment_count").alias("comments"),
    )
