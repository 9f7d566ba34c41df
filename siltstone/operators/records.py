"""Source records to fixed rows: each cleaner takes a DataFrame and returns the rows that pass, with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as t
from siltstone.operators.markup import LEAST_BOOK_WORDS, book_text, comment_markdown, decoded, html_to_text, rfc_text, transcript_segment, wiki_text  # noqa: F401
from siltstone.schemas import conform


def inverted_index(index: Column, least: int = 5, collide: str = "last") -> Column:
    """``{word: [places]}`` as text. On a shared place the last word wins, or (``keep``) all words stay, in order of words."""
    entries = F.map_entries(index)
    numbered = F.flatten(F.transform(entries, lambda e, k: F.transform(e["value"], lambda p: F.struct(p.alias("p"), k.alias("k"), e["key"].alias("w")))))
    if collide == "keep":
        ordered = F.transform(F.array_sort(F.transform(numbered, lambda x: F.struct(x["p"].alias("p"), x["w"].alias("w")))), lambda x: x["w"])
    else:
        ranked = F.array_sort(F.transform(numbered, lambda x: F.struct(x["p"].alias("p"), (-x["k"]).alias("k"), x["w"].alias("w"))))
        # Of equal places the first after this order is the latest word.
        ordered = t.let(ranked, lambda r: F.transform(F.filter(r, lambda x, i: (i == 0) | (F.get(r, i - 1)["p"] != x["p"])), lambda x: x["w"]))
    return t.let(ordered, lambda words: F.when(F.size(words) >= least, F.array_join(words, " ")))


def rows_of_arrays(df: DataFrame, *names: str) -> DataFrame:
    """Parallel arrays as rows by place; shorter ones are filled with nulls."""
    return df.select(F.inline(F.arrays_zip(*names)))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def names_of(array: Column, name: str, other: str, most: int, empty: str) -> Column:
    """Display names of the first ``most`` entries, another field where the first is blank."""
    names = F.transform(F.slice(array, 1, most), lambda a: F.coalesce(F.nullif(a[name], F.lit("")), F.nullif(a[other], F.lit(""))))
    kept = F.filter(F.coalesce(names, F.array()), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, ", ")).otherwise(empty)


def scholarly_works(works: DataFrame, least_words: int = 15) -> DataFrame:
    """Works with title and abstract, not retracted and no paratext; year 0 outside 1000 to 3000; Markdown of the parts."""
    title = t.clean_markup(F.coalesce(F.nullif("title", F.lit("")), "display_name", F.lit("")), controls=False)
    works = t.once(works.where(~F.coalesce("is_retracted", F.lit(False)) & ~F.coalesce("is_paratext", F.lit(False))), raw_abstract=inverted_index(F.col("abstract_inverted_index")))
    works = works.withColumns({"clean_title": title, "abstract": t.clean_markup(F.col("raw_abstract"), controls=False)})
    good = (F.length("clean_title") >= 5) & (F.size(t.words_of(F.col("clean_title"))) >= 2) & (F.size(t.words_of(F.col("abstract"))) >= least_words) & (last_segment(F.col("id")) != "")
    authors = names_of(F.transform("authorships", lambda a: F.struct(a["author"]["display_name"].alias("n"), a["raw_author_name"].alias("r"))), "n", "r", 10, "Unknown")
    all_topics = F.array_compact(F.concat(F.array(F.nullif(F.col("primary_topic.display_name"), F.lit(""))), F.coalesce(F.transform("topics", lambda x: F.nullif(x["display_name"], F.lit(""))), F.array().cast("array<string>"))))
    topics = F.array_join(F.slice(F.array_distinct(all_topics), 1, 3), "; ")
    year, cited = F.coalesce("publication_year", F.lit(0)), F.coalesce("cited_by_count", F.lit(0))
    works = works.where(good).withColumns({"authors": authors, "topic_list": F.when(topics == "", "General Science").otherwise(topics)})
    facts = F.concat_ws(" | ", F.when(year > 0, F.concat(F.lit("Year: "), year)), F.when(cited > 0, F.concat(F.lit("Citations: "), cited)), F.when(F.coalesce("doi", F.lit("")) != "", F.concat(F.lit("DOI: "), "doi")))
    body = F.concat_ws("\n\n", F.concat(F.lit("# "), "clean_title"), F.concat(F.lit("Authors: "), "authors"), F.nullif(facts, F.lit("")), F.concat(F.lit("Topics: "), "topic_list"), F.concat(F.lit("## Abstract\n"), "abstract"))
    return works.select(
        last_segment(F.col("id")).alias("id"),
        F.coalesce("doi", F.lit("")).alias("doi"),
        F.col("clean_title").alias("title"),
        F.when(year.between(1000, 3000), year).otherwise(0).cast("short").alias("year"),
        "authors",
        F.col("topic_list").alias("topics"),
        F.coalesce("open_access.is_oa", F.lit(False)).alias("is_oa"),
        F.coalesce("open_access.oa_url", F.lit("")).alias("oa_url"),
        cited.cast("int").alias("citations"),
        body.alias("text"),
    )


def question_threads(posts: DataFrame, comments: DataFrame, least_words: int = 20, least_score: int = 1) -> DataFrame:
    """A question with its accepted answer, else its best one, and up to five of both posts' top comments."""
    from siltstone.operators.tables import top_per_group

    q = posts.where("PostTypeId = 1").select(F.col("Id").alias("thread_id"), "Title", "Tags", "Score", "AcceptedAnswerId", F.col("Body").alias("qbody"))
    a = posts.where("PostTypeId = 2").select(F.col("Id").alias("aid"), "ParentId", F.col("Score").alias("answer_score"), F.col("Body").alias("abody"))
    both = q.join(a, F.col("ParentId") == F.col("thread_id")).withColumn("ok", F.coalesce(F.col("aid") == F.col("AcceptedAnswerId"), F.lit(False)))
    best = top_per_group(both.where(F.col("ok") | (F.col("answer_score") >= least_score)), ["thread_id"], [F.desc("ok"), F.desc("answer_score"), F.col("aid")], 1).drop("rank")
    top = top_per_group(comments, ["PostId"], [F.desc("Score"), F.desc("Text")], 3)
    lists = top.groupBy("PostId").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "Text"))), lambda x: F.substring(x["Text"], 1, 500)).alias("c"))
    one, two = lists.select(F.col("PostId").alias("p1"), F.col("c").alias("c1")), lists.select(F.col("PostId").alias("p2"), F.col("c").alias("c2"))
    joined = best.join(one, F.col("p1") == F.col("thread_id"), "left").join(two, F.col("p2") == F.col("aid"), "left")
    none = F.array().cast("array<string>")
    joined = joined.withColumns({"question": html_to_text(F.col("qbody")), "answer": html_to_text(F.col("abody"))})
    joined = joined.where((F.size(t.words_of(F.col("question"))) >= least_words) & (F.size(t.words_of(F.col("answer"))) >= least_words))
    tags = F.array_join(F.regexp_extract_all(F.col("Tags"), F.lit("<([^>]+)>"), F.lit(1)), ";")
    said = F.array_join(F.slice(F.concat(F.coalesce("c1", none), F.coalesce("c2", none)), 1, 5), " | ")
    return joined.select("thread_id", F.col("Title").alias("title"), tags.alias("tags"), F.col("Score").alias("score"), "question", "answer", "answer_score", said.alias("comments"))


#: Columns of market files in their order, with the value that stands for a missing one (none: the row goes), and
#: the first cells of header lines.
MARKET_FILES = {
    "klines": (
        (("open_time", "long"), ("open", "double"), ("high", "double"), ("low", "double"), ("close", "double"), ("volume", "double"), ("close_time", "long", "open_time"), ("quote_volume", "double", "0"), ("trades", "long", "0"), ("taker_base", "double", "0"), ("taker_quote", "double", "0")),
        ("open_time", "open time", "time", "timestamp"),
    ),
    "trades": (
        (("trade_id", "long"), ("price", "double"), ("qty", "double"), ("quote_qty", "double"), ("trade_time", "long"), ("is_buyer_maker", "flag", "false")),
        ("id", "trade_id", "trade id"),
    ),
    "agg_trades": (
        (("agg_trade_id", "long"), ("price", "double"), ("quantity", "double"), ("first_trade_id", "long"), ("last_trade_id", "long"), ("transact_time", "long"), ("is_buyer_maker", "flag", "false")),
        ("agg_trade_id", "agg trade id", "trade id", "id"),
    ),
}


def market_rows(rows: DataFrame, kind: str, symbol: str, market: str = "spot", interval: str = "1d", source_file: str = "") -> DataFrame:
    """Typed rows of ``rows(line)`` of comma-separated values, in the fixed schema of their kind.

    Headers go, and lines with a cell that is there but can't be read or with too few cells; missing tails take defaults.
    """
    columns, headers = MARKET_FILES[kind]
    cells = rows.select(F.transform(F.split("line", ","), lambda x: F.trim(x)).alias("c")).where(~F.lower(F.get("c", F.lit(0))).isin(*headers))
    values, good = {}, F.lit(True)
    for k, (name, of, *default) in enumerate(columns):
        raw = F.nullif(F.get("c", F.lit(k)), F.lit(""))
        # Whole numbers may be written as decimals in a tail, never in front.
        value = F.lower(raw).isin("true", "1", "t") if of == "flag" else raw.try_cast("double").cast("long") if of == "long" and default == ["0"] else raw.try_cast(of)
        good = good & (value.isNotNull() | (raw.isNull() if default else F.lit(False)))
        values[name] = F.coalesce(value, F.expr(default[0])) if default and default[0] not in values else F.coalesce(value, values[default[0]]) if default else value
    named = {"symbol": symbol, "market": market, "interval": interval, "source_file": source_file}
    return conform(cells.where(good).select(*(v.alias(n) for n, v in values.items()), *(F.lit(v).alias(n) for n, v in named.items())), kind)


def klines(rows: DataFrame, symbol: str, market: str = "spot", interval: str = "1d") -> DataFrame:
    return market_rows(rows, "klines", symbol, market, interval)


def quote_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, "\n"), lambda x: F.ltrim(x).rlike("^(- |> |\\* )")))


def benchmark_maths(c: Column) -> tuple[Column, Column]:
    """(reasoning, answer) of a solution: after ``####``, else the last boxed expression."""
    marked = F.contains(c, F.lit("####"))
    boxed = F.regexp_extract(c, r"(?s).*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}", 1)
    return F.when(marked, F.trim(F.split_part(c, F.lit("####"), F.lit(1)))).otherwise(c), F.when(marked, F.trim(F.regexp_replace(c, r"(?s)\A.*?####", ""))).otherwise(boxed)


def maths_tasks(rows: DataFrame, kind: str) -> DataFrame:
    """(task_id, question, reasoning, answer) of ``rows(place, row)``, a row being JSON: solutions with marks, word problems, or any."""
    at = lambda *names: F.coalesce(*(F.nullif(F.get_json_object("row", f"$.{n}"), F.lit("")) for n in names), F.lit(""))
    if kind == "svamp":
        question = t.strip(F.concat_ws(" ", at("Body", "body"), at("Question", "question")))
        reasoning, answer = at("Equation", "equation"), F.regexp_replace(at("Answer", "answer"), r"\.0+$", "")
    else:
        question = t.strip(at("question", "problem", "prompt"))
        reasoning, answer = benchmark_maths(at("answer", "solution") if kind in ("gsm8k", "math") else at("solution", "answer"))
        answer = F.coalesce(F.nullif(answer, F.lit("")), at("final_answer"))
    return rows.select(F.coalesce(F.nullif(at("ID", "id"), F.lit("")), F.concat(F.lit(f"{kind}-"), F.col("place") + 1)).alias("task_id"), question.alias("question"), reasoning.alias("reasoning"), answer.alias("answer"))


def books(raw: DataFrame) -> DataFrame:
    """Books of ``raw(book_id, title, content, ...)`` in their fixed schema; content is bytes; under 200 words they go."""
    text = raw.withColumn("text", book_text(decoded(F.col("content")))).drop("content")
    sized = text.withColumns({"char_count": F.length("text"), "word_count": t.word_count(F.col("text"))})
    return conform(sized.where(F.col("word_count") >= LEAST_BOOK_WORDS), "book")
