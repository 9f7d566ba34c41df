"""Queries of the source-record cleaners, over small inline records or columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import text as t
from siltstone.operators import layout, publishing
from siltstone.operators import records as r
from siltstone.plans.registry import query, table, texts


@query("""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents) SELECT doc_id, CASE WHEN len(w) >= 5 THEN md5(array_to_string(w, ' ')) END AS abstract FROM w""")
def c21_inverted_index(spark, sf_dir):
    """Texts are turned into inverted indexes and back."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    words = docs.select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "w"))
    index = words.groupBy("doc_id", "w").agg(F.collect_list("p").alias("ps")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("index"))
    return index.select("doc_id", F.md5(r.inverted_index(F.col("index"))).alias("abstract"))


@query("SELECT 'b b2 c d e f' AS last, 'a b b2 c d e f' AS kept")
def c22_colliding_words(spark, sf_dir):
    rows = spark.createDataFrame([('{"a": [0], "b": [0], "b2": [1], "c": [2], "d": [3], "e": [4], "f": [5]}',)], "j string").select(F.from_json("j", "map<string,array<int>>").alias("m"))
    return rows.select(r.inverted_index(F.col("m")).alias("last"), r.inverted_index(F.col("m"), collide="keep").alias("kept"))


_WORKS = "id string, title string, display_name string, is_retracted boolean, is_paratext boolean, abstract_inverted_index map<string,array<int>>, authorships array<struct<author: struct<display_name: string>, raw_author_name: string>>, primary_topic struct<display_name: string>, topics array<struct<display_name: string>>, publication_year int, doi string, cited_by_count int, open_access struct<is_oa: boolean, oa_url: string>"


@query("""SELECT 'W' || doc_id AS id, 'A study ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1990 + doc_id % 30 END::SMALLINT AS year, 'Ann, raw ' || doc_id AS authors, 'T1; T2; ' || source AS topics, doc_id % 5 = 0 AS is_oa,
md5('# A study ' || doc_id || chr(10) || chr(10) || 'Authors: Ann, raw ' || doc_id || chr(10) || chr(10) || 'Year: ' || CASE WHEN doc_id % 2 = 0 THEN 5000 ELSE 1990 + doc_id % 30 END || CASE WHEN doc_id % 7 > 0 THEN ' | Citations: ' || doc_id % 7 ELSE '' END || chr(10) || chr(10) || 'Topics: T1; T2; ' || source || chr(10) || chr(10) || '## Abstract' || chr(10) || a) AS text
FROM (SELECT doc_id, source, array_to_string(list_transform(range(0, 12 + (doc_id % 9)::INT), lambda k: 'w' || k), ' ') AS a FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 9 >= 3)""")
def c1_scholarly_works(spark, sf_dir):
    """Retracted works and those with abstracts of under 15 words go; the rest becomes Markdown."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    n = (F.lit(12) + k % 9).cast("int")
    index = F.map_from_entries(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.concat(F.lit("w"), i), F.array(i))))
    topic = lambda c: F.struct(c.alias("display_name"))
    works = d.select(
        F.concat(F.lit("https://example.org/W"), k).alias("id"),
        F.concat(F.lit("<b>A</b> study "), k).alias("title"),
        F.lit(None).cast("string").alias("display_name"),
        (k % 11 == 0).alias("is_retracted"),
        F.lit(False).alias("is_paratext"),
        index.alias("abstract_inverted_index"),
        F.array(F.struct(F.struct(F.lit("Ann").alias("display_name")).alias("author"), F.lit("x").alias("raw_author_name")), F.struct(F.struct(F.lit(None).cast("string").alias("display_name")).alias("author"), F.concat(F.lit("raw "), k).alias("raw_author_name"))).alias("authorships"),
        topic(F.lit("T1")).alias("primary_topic"),
        F.array(topic(F.lit("T1")), topic(F.lit("T2")), topic(F.col("source")), topic(F.lit("T9"))).alias("topics"),
        F.when(k % 2 == 0, 5000).otherwise(F.lit(1990) + k % 30).cast("int").alias("publication_year"),
        F.lit(None).cast("string").alias("doi"),
        (k % 7).cast("int").alias("cited_by_count"),
        F.struct((k % 5 == 0).alias("is_oa"), F.lit("").alias("oa_url")).alias("open_access"),
    )
    return r.scholarly_works(works).select("id", "title", "year", "authors", "topics", "is_oa", F.md5("text").alias("text"))


@query("""WITH q AS (SELECT conv_id, min(turn) AS t0 FROM conversations GROUP BY conv_id) SELECT conv_id AS thread_id, 'T' || conv_id AS title, 'a;b' AS tags, 2 AS answer_score, 'high | low' AS comments FROM q WHERE conv_id % 4 <> 3""")
def c10_question_threads(spark, sf_dir):
    """Accepted answers first, else the best with a score; threads without either go."""
    body = F.lit("<p>" + "word " * 25 + "</p><pre><code>x &lt; 1</code></pre>")
    ids = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("c")).distinct()
    accepted = F.when(F.col("c") % 4 == 0, F.col("c") * 10 + 2).cast("int")
    q = ids.select((F.col("c") * 1).cast("int").alias("Id"), F.lit(1).alias("PostTypeId"), F.lit(None).cast("int").alias("ParentId"), accepted.alias("AcceptedAnswerId"), F.lit(5).alias("Score"), F.concat(F.lit("T"), "c").alias("Title"), F.lit("<a><b>").alias("Tags"), body.alias("Body"))
    score = lambda best: F.when(F.col("c") % 4 == 3, 0).when(F.lit(best), 2).otherwise(F.when(F.col("c") % 4 == 0, 9).otherwise(1))
    a = [ids.select((F.col("c") * 10 + k).cast("int").alias("Id"), F.lit(2).alias("PostTypeId"), F.col("c").cast("int").alias("ParentId"), F.lit(None).cast("int").alias("AcceptedAnswerId"), score(k == 2).alias("Score"), F.lit("").alias("Title"), F.lit("").alias("Tags"), body.alias("Body")) for k in (1, 2)]
    posts = q.withColumn("Id", F.col("Id") * 1 + 1_000_000).unionByName(a[0].withColumn("ParentId", F.col("ParentId") + 1_000_000)).unionByName(a[1].withColumn("ParentId", F.col("ParentId") + 1_000_000))
    comments = ids.select((F.col("c") + 1_000_000).cast("int").alias("PostId"), F.explode(F.array(F.struct(F.lit(1).alias("Score"), F.lit("low").alias("Text")), F.struct(F.lit(7).alias("Score"), F.lit("high").alias("Text")))).alias("x")).select("PostId", "x.Score", "x.Text")
    out = r.question_threads(posts, comments)
    return out.select((F.col("thread_id") - 1_000_000).cast("long").alias("thread_id"), "title", "tags", "answer_score", "comments")


_LINES = ["open_time,open,high,low,close,volume", "1,1.5,2,1,1.7,10", "2,1.5,2,1,1.7,10,99,3.5,4,1.0,2.0", "bad,1,1,1,1,1", "3,1,2", "4,1,1,1,1,x", "5, 1 ,1,1,1,1,,,7.0"]


@query("""SELECT open_time, close, close_time, quote_volume, trades, 'BTC' AS symbol FROM (VALUES (1::BIGINT, 1.7::DOUBLE, 1::BIGINT, 0::DOUBLE, 0::BIGINT), (2, 1.7, 99, 3.5, 4), (5, 1, 5, 0, 7)) v(open_time, close, close_time, quote_volume, trades)""")
def c20_klines(spark, sf_dir):
    return r.klines(spark.createDataFrame([(x,) for x in _LINES], "line string"), "BTC").select("open_time", "close", "close_time", "quote_volume", "trades", "symbol")


@query("SELECT 'Chapter' || chr(10) || chr(10) || 'A line here' || chr(10) || chr(10) || '*** END OF THE FIRST PART ***' || chr(10) || 'on' AS body")
def c12_book(spark, sf_dir):
    raw = "Legal\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\n\nChapter  \n\n\n\n-------\n[Pg 12]A <i>line</i> here\n\n[Transcriber's Note: x]gone\n\n*** END OF THE FIRST PART ***\non\n*** END OF PROJECT GUTENBERG EBOOK X ***\nmore"
    return spark.createDataFrame([(raw,)], "raw string").select(r.book_text(F.col("raw")).alias("body"))


_WIKI = "== Head ==\n'''Bold''' [[Target|label]] and [[Plain]]{{tpl|{{in}}}}<!-- c --><ref>r</ref>\n{| table\n|}\n[[File:x.png|thumb]][http://a.b text] end<br>x"


@query("""SELECT project, body FROM (VALUES ('source', 'Head' || chr(10) || 'Bold label and Plain' || chr(10) || chr(10) || 'text end' || chr(10) || 'x'), ('dictionary', '## Head' || chr(10) || 'Bold label and Plain' || chr(10) || chr(10) || 'text end' || chr(10) || 'x'), ('voyage', '## Head' || chr(10) || 'Bold label and Plain' || chr(10) || chr(10) || 'text end' || chr(10) || 'x')) v(project, body)""")
def c13_c14_c17_wikitext(spark, sf_dir):
    row = spark.createDataFrame([(_WIKI,)], "raw string")
    out = None
    for project in ("source", "dictionary", "voyage"):
        one = row.select(F.lit(project).alias("project"), r.wiki_text(F.col("raw"), project).alias("body"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT 2 AS quotes, '- one' || chr(10) || '  - two' AS body, chr(96) || chr(96) || chr(96) || 'c' || chr(10) || 'int a[] = {{1}};' || chr(10) || chr(96) || chr(96) || chr(96) AS code, 'Homo sapiens' AS species""")
def c15_c16_c19_wikitext(spark, sf_dir):
    row = spark.createDataFrame([("* one\n** two", '<syntaxhighlight lang="c">\nint a[] = {{1}};\n</syntaxhighlight>', "{{Homo}} sapiens{{a|{{b}}}}")], "q string, c string, s string")
    body = r.wiki_text(F.col("q"), "quote")
    return row.select(r.quote_count(body).alias("quotes"), body.alias("body"), r.wiki_text(F.col("c"), "books").alias("code"), r.wiki_text(F.col("s"), "species").alias("species"))


@query(r"""SELECT id, reasoning, answer FROM (VALUES (1, 'so 2+2', '4'), (2, 'thus \boxed{7}', '7'), (3, 'plain', '')) v(id, reasoning, answer)""")
def c23_benchmark_maths(spark, sf_dir):
    rows = spark.createDataFrame([(1, "so 2+2 #### 4"), (2, "thus \\boxed{7}"), (3, "plain")], "id int, s string")
    reasoning, answer = r.benchmark_maths(F.col("s"))
    return rows.select("id", reasoning.alias("reasoning"), answer.alias("answer"))


@query("SELECT l_orderkey AS accession, l_linenumber AS n, 'https://example.org/' || l_orderkey || '/' || l_linenumber AS url FROM lineitem")
def c25_column_arrays(spark, sf_dir):
    """A record of parallel arrays for each order becomes rows by place."""
    filings = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("n"))
    arrays = filings.select(F.transform("n", lambda _: F.col("l_orderkey")).alias("accession"), "n")
    return r.rows_of_arrays(arrays, "accession", "n").withColumn("url", F.concat_ws("/", F.lit("https://example.org"), "accession", "n"))


@query("""SELECT 'a' || chr(10) || chr(10) || '*b* [t](http://x) & "q" <ok>' AS comment, 'Head' || chr(10) || chr(10) || 'next' AS rfc, 'hello there' AS segment, '### Problem:' || chr(10) || 'q' || chr(10) || chr(10) || '### Solution:' || chr(10) || 'a' AS pair""")
def c11_c26_c27_c28_texts(spark, sf_dir):
    rows = spark.createDataFrame([('a<p><i>b</i> <a href="http://x" rel="n">t</a> &amp; &quot;q&quot; &lt;ok&gt;', "Head\r\n\fSmith   [Page 3]\n\nRFC 1 x\n\nnext", ">> [Music] hello   there ♪", "q", "a")], "h string, r string, s string, q string, a string")
    return rows.select(r.comment_markdown(F.col("h")).alias("comment"), r.rfc_text(F.regexp_replace("r", "\r\n", "\n")).alias("rfc"), r.transcript_segment(F.col("s")).alias("segment"), F.concat(F.lit("### Problem:\n"), "q", F.lit("\n\n### Solution:\n"), "a").alias("pair"))


@query(r"""SELECT page_id, list_distinct_sorted AS words FROM (SELECT page_id, list_filter(['the', 'of', 'zzz'], lambda t: contains(lower(html), t)) AS found, CASE WHEN contains(lower(html), 'the') AND contains(lower(html), 'of') THEN 'all' ELSE 'some' END AS list_distinct_sorted FROM pages)""")
def c32_all_terms(spark, sf_dir):
    hay = F.lower("html")
    every = F.forall(F.split(F.lit("the of"), " "), lambda w: F.contains(hay, w))
    return table(spark, sf_dir, "pages").select("page_id", F.when(every, "all").otherwise("some").alias("words"))


@query("SELECT p_partkey, CASE WHEN starts_with(p_type, 'PROMO') OR starts_with(p_type, 'ECONOMY') THEN 'cheap' WHEN contains(lower(p_type), 'stand') THEN 'standard' ELSE 'other' END AS stem, p_size > 20 AND contains(lower(p_name), '1') AS hit FROM part")
def c33_c34_alias_filters(spark, sf_dir):
    kind = F.when(F.col("p_type").startswith("PROMO") | F.col("p_type").startswith("ECONOMY"), "cheap").when(F.contains(F.lower("p_type"), F.lit("stand")), "standard").otherwise("other")
    return table(spark, sf_dir, "part").select("p_partkey", kind.alias("stem"), ((F.col("p_size") > 20) & F.contains(F.lower("p_name"), F.lit("1"))).alias("hit"))


@query("SELECT claim, CASE WHEN claim LIKE '%claim%' THEN regexp_extract(claim, 'claim (\\d+)', 1) ELSE '' END AS depends_on, claim NOT LIKE '%claim%' AS independent FROM (VALUES ('1. A device'), ('2. The device of claim 1'), ('3. The device of claim 2, red')) v(claim)")
def c37_claims(spark, sf_dir):
    rows = spark.createDataFrame([("1. A device",), ("2. The device of claim 1",), ("3. The device of claim 2, red",)], "claim string")
    on = F.regexp_extract("claim", r"claim (\d+)", 1)
    return rows.select("claim", on.alias("depends_on"), (on == "").alias("independent"))


@query("SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'root' WHEN role = 'assistant' THEN 'review' ELSE 'reply' END AS part FROM conversations")
def c38_thread_roles(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") == 0, "root").when(F.col("role") == "assistant", "review").otherwise("reply").alias("part"))


@query("SELECT p_partkey, CASE WHEN p_size > 30 THEN 'application/pdf' WHEN p_size > 10 THEN 'application/epub+zip' WHEN p_size > 2 THEN 'text/plain; charset=utf-8' END AS chosen, CASE WHEN p_size % 3 = 0 THEN 'best' WHEN p_size % 2 = 0 THEN 'first' WHEN p_size % 5 = 0 THEN 'pdf' END AS label, CASE WHEN p_size % 3 = 0 THEN 'b' WHEN p_size % 2 = 0 THEN 'f' WHEN p_size % 5 = 0 THEN 'x.pdf' END AS url FROM part")
def c31_c42_c44_preferences(spark, sf_dir):
    """The first format of a priority list that a row has, equal or in part; the first place that has a link."""
    size = F.col("p_size")
    has = F.array_compact(F.array(F.when(size > 2, "text/plain; charset=utf-8"), F.when(size > 10, "application/epub+zip"), F.when(size > 30, "application/pdf")))
    chosen = publishing.format_preference(has, ("application/pdf", "application/epub+zip", "text/plain"))
    other = F.when(size % 5 == 0, "x.pdf").otherwise("x.html")
    label, url = publishing.source_preference(("best", F.when(size % 3 == 0, "b")), ("first", F.when(size % 2 == 0, "f").otherwise("")), ("pdf", F.when(other.endswith(".pdf"), other)))
    return table(spark, sf_dir, "part").select("p_partkey", chosen.alias("chosen"), label.alias("label"), url.alias("url"))


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'CORRUPT_PAYLOAD' WHEN 1 THEN 'PASSWORD_PROTECTED' WHEN 2 THEN 'ENCODING_ERROR' WHEN 3 THEN 'SCANNED_IMAGE_ONLY' WHEN 4 THEN 'EMPTY_TEXT_LAYER' ELSE 'EXTRACTABLE' END AS verdict FROM documents""")
def x8_pdf_anomalies(spark, sf_dir):
    """The class of a paged text layer by its characters, for layers of all six kinds."""
    k = F.col("doc_id") % 6
    ten = F.repeat(F.lit("\ufffd"), 10)
    layers = F.when(k == 2, F.array(F.concat(ten, F.lit("readable here")))).when(k == 3, F.array(F.lit(" "), F.lit(""))).when(k == 4, F.array(F.lit("a short page"), F.lit("next"))).otherwise(F.array(F.concat(F.lit("a page of ordinary text in "), "lang")))
    return table(spark, sf_dir, "documents").select("doc_id", layout.text_layer_class(k != 0, k == 1, layers, F.when(k == 3, 2).otherwise(0)).alias("verdict"))


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END, ''), CASE WHEN doc_id % 2 = 0 THEN lang END, 'none') AS first FROM documents")
def p3_first_text(spark, sf_dir):
    """The first candidate field that is neither null nor empty."""
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(k % 3 == 0, F.col("source")).otherwise("").alias("content"), F.when(k % 2 == 0, F.col("lang")).alias("markdown"), F.lit("none").alias("body"))
    return rows.select("doc_id", t.first_text("content", "markdown", "body").alias("first"))


@query("""SELECT doc_id::VARCHAR AS task_id, 'Ann has ' || doc_id || ' pens. How many?' AS question, '( 3.0 - 1.0 )' AS reasoning, (doc_id % 50)::VARCHAR AS answer FROM documents""")
def c23_word_problems(spark, sf_dir):
    k = F.col("doc_id")
    row = F.format_string('{"ID": "%d", "Body": "Ann has %d pens.", "Question": "How many?", "Equation": "( 3.0 - 1.0 )", "Answer": "%d.0"}', k, k, k % 50)
    return r.maths_tasks(table(spark, sf_dir, "documents").select(k.alias("place"), row.alias("row")), "svamp")


@query("""SELECT doc_id, '## ' || source || chr(10) || 'Text ' || doc_id || '.' || chr(10) || 'Source: Ann, A title, P, May ' || doc_id % 28 AS body FROM documents""")
def c18_news(spark, sf_dir):
    """Sources of news become citations; other templates go."""
    raw = F.concat(F.lit("{{date|x}}== "), "source", F.lit(" ==\nText ''"), "doc_id", F.lit("''.\n{{source|url=u|title=[[w|A title]]|author=Ann|pub=P|date=May "), F.col("doc_id") % 28, F.lit("}}[[Category:y]]"))
    return table(spark, sf_dir, "documents").select("doc_id", r.wiki_text(raw, "news").alias("body"))


@query("""SELECT doc_id::INT AS book_id, 210 AS word_count, md5(array_to_string(list_transform(range(0, 210), lambda i: 'é' || i), ' ')) AS text FROM documents WHERE doc_id % 2 = 0""")
def c12_books(spark, sf_dir):
    """Bytes in one of two encodings; books of under 200 words go."""
    k = F.col("doc_id")
    n = F.when(k % 2 == 0, 210).otherwise(150)
    words = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("é"), i)), " ")
    text = F.concat(F.lit("*** START OF THIS PROJECT GUTENBERG EBOOK A ***\n"), words, F.lit("\n*** END OF THIS PROJECT GUTENBERG EBOOK A ***"))
    raw = table(spark, sf_dir, "documents").select(k.alias("book_id"), F.lit("A").alias("title"), F.when(k % 4 == 0, F.encode(text, "UTF-8")).otherwise(F.encode(text, "ISO-8859-1")).alias("content"))
    return r.books(raw).select("book_id", "word_count", F.md5("text").alias("text"))
