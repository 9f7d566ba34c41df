"""Known answers, properties and traps of single operators."""

import json

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import text as t
from siltstone.functions import web
from siltstone.operators import dedup, html, records, tables
from siltstone.sources import readers


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_normalise(spark):
    assert one(spark, "ﬁn​e\x0c a\r\n\n\n\n\n\nb\t\t c ", t.normalise) == "fine a\n\n\nb c"
    again = one(spark, "fine a\n\n\nb c", t.normalise)
    assert again == "fine a\n\n\nb c"


def test_normalise_corpus_keeps_two_breaks(spark):
    assert one(spark, "a &amp;  b\n\n\n\n\nx@y.com +1 555 123 4567", t.normalise_corpus) == "a & b\n\n[EMAIL_REDACTED] [PHONE_REDACTED]"


def test_redaction_order(spark):
    assert one(spark, "TR330006100519786457841326", t.redact) != "[FINANCIAL_REDACTED]"  # phones go first
    assert one(spark, "x eyJabcdefghijk.abcdefghijk.abcdefghijk y", t.redact) == "x [SECRET_REDACTED] y"


def test_gate_traps(spark):
    long_ = " ".join(["word"] * 600_000)
    df = t.with_quality_metrics(spark.createDataFrame([("a " * 10,), (None,), (long_,)], "text string"))
    got = [r.r for r in df.select(t.gate_reasons().alias("r")).collect()]
    assert got[0] == ["min_words", "min_chars", "min_alpha_ratio"] and "min_words" in got[1] and got[2] == []
    assert df.select(t.gate_reasons({"max_words": 500_000}).alias("r")).collect()[2].r == ["max_words"]


def test_turkish_folding(spark):
    assert one(spark, " İSTANBUL IĞDIR Çöp", t.fold_turkish) == "istanbul igdir cop"


def test_budget(spark):
    body = "x" * 85 + "\n# head\n" + "y" * 40
    assert one(spark, body, lambda c: t.within_budget(c, 100)[0]) == "x" * 85
    assert one(spark, "z" * 120, lambda c: t.within_budget(c, 100)[0]) == "z" * 100


def test_fnv_and_simhash():
    h = dedup.FNV_OFFSET
    for unit in (97, 0xE9):
        h = (h ^ unit) * dedup.FNV_PRIME % 2**64
    assert dedup.fnv1a64("") == dedup.FNV_OFFSET and dedup.fnv1a64("aé") == h
    texts = ["", "a", "foobar", "é\U0001f600", "x" * 50]
    assert dedup.fnv1a64_all(texts).tolist() == [dedup.fnv1a64(x) for x in texts]
    assert dedup.simhash_of("") == 0 and dedup.simhash_of("One, two!") == dedup.simhash_of("one two")


def test_near_greedy_matches_a_loop(spark):
    rng = np.random.default_rng(3)
    base = [f"word{k}" for k in rng.integers(0, 900, 60)]
    rows = []
    for k in range(40):
        w = list(base) if k % 2 else [f"word{x}" for x in rng.integers(0, 900, 60)]
        for _ in range(k % 5):
            w[int(rng.integers(0, 60))] = f"new{k}"
        rows.append((k, " ".join(w)))
    rows += [(100, rows[4][1]), (101, "short"), (102, "short")]
    got = {r.doc_id: r for r in dedup.near_greedy(spark.createDataFrame(rows, "doc_id long, text string"), bits=8).collect()}
    seen, kept = {}, []
    for k, text in rows:
        near = next((j for j, f in kept if len(text) >= 50 and (f ^ dedup.simhash_of(text)).bit_count() <= 8), None)
        if text in seen:
            assert got[k].is_duplicate
            continue
        seen[text] = k
        assert got[k].is_duplicate == (near is not None), k
        if near is None and len(text) >= 50:
            kept.append((k, dedup.simhash_of(text)))


@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("abc")), max_size=12))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_exact_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "seq long, n int, key string")
    once = dedup.drop_exact(df, "key", "seq")
    twice = dedup.drop_exact(once, "key", "seq")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) and once.count() == len({r[1] for r in rows})


def test_canonical_urls(spark):
    cases = {"EXAMPLE.com/a/?b=2&a=1#x": "https://example.com/a?a=1&b=2", "http://x.org:80/": "http://x.org", "https://x.org:8443/p/": "https://x.org:8443/p", "ftp://x.org/": None, "http://nodots/": None}
    for raw, want in cases.items():
        assert one(spark, raw, web.canonical_url) == want


def test_robots(spark):
    rules = "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow:\n"
    urls = spark.createDataFrame([("http://x/a/c",), ("http://x/a/b",), ("http://x/z",)], "u string")
    assert [r.allowed for r in web.robots_allows(urls, "u", rules, "bot").orderBy("u").collect()] == [True, False, True]


def test_tables_and_readable():
    (headers, rows), = html.parse_tables("<table><tr><td colspan=2>a</td></tr><tr><td></td></tr><tr><td>b</td><td>c<table><tr><td>n</td></tr></table></td></tr></table>")
    assert headers == ["Column 1", "Column 2"] and rows == [["a", "a"], ["b", "c"]]
    assert html.readable("<title> T </title><nav>no</nav><article><h2>H</h2><p>x</p><script>no</script></article>") == ("T", "## H\n\nx")


def test_wikitext():
    from siltstone.operators.markup import wiki_plain

    assert wiki_plain("a{{b{{c}}d}}e") == "ae" and wiki_plain("a{{b") == "a" and wiki_plain("a}}b") == "a}}b"
    assert wiki_plain("= Top =\nx [ftp://a.b label] [http://c.d]\n[[File:y.png|thumb|a [[b]] c]]z") == "Top\nx label\nz"
    assert wiki_plain("{{see|name=The [[x|Tower]]|address=1 Road|content=High.}}", "voyage") == "- **The Tower** (1 Road) High."
    assert wiki_plain("Said.\n{{source|url=u|title=A title|author=Ann|pub=P|date=May}}", "news") == "Said.\nSource: Ann, A title, P, May"
    assert wiki_plain("=== Deep ===", "voyage") == "### Deep" and wiki_plain("{{Homo}} sapiens", "species") == "Homo sapiens"


def test_books_memos_and_comments():
    from siltstone.operators import markup

    inside = "One\n*** END OF THE FIRST PART ***\nTwo"
    assert markup.book_body(f"x\n*** START OF PROJECT GUTENBERG EBOOK Y ***\n{inside}\n*** END OF THIS PROJECT GUTENBERG EBOOK Y ***\nz") == inside
    assert markup.book_body("no marks at all") == "no marks at all"
    assert markup.memo_body("a\r\nSmith   Standard   [Page 2]\n\fRFC 9 Title May\n\nb") == "a\n\nb"
    assert markup.body_text("<p>x <code>y</code></p><pre><code>k &lt; 1\n  m</code></pre><ul><li>one</li></ul>") == "x `y`\n\n\n    k < 1\n      m\n\n\n- one".replace("\n\n\n", "\n\n")
    assert markup.comment_text('a<p>b <i>c</i> <a href="u" rel="x">d</a> &amp; e') == "a\n\nb *c* [d](u) & e"


def test_transcripts(spark):
    from siltstone.operators.markup import transcript

    df = spark.createDataFrame([(["[Music] >> hello", "[Note the word] stays", "SPEAKER 1: so", "(applause)"],)], "s array<string>")
    assert df.select(transcript(F.col("s")).alias("t")).first().t == "hello [Note the word] stays so"


def test_null_keys_are_no_copies(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, None)], "id long, key string, other string")
    assert sorted(tuple(r) for r in dedup.drop_exact(df, "key", "id").collect()) == [(1, "a", "x"), (3, None, "z"), (4, None, None)]
    flags = {r.id: (r.is_duplicate, r.duplicate_match) for r in dedup.flag_exact(df, "key", "id").collect()}
    assert flags == {1: (False, None), 2: (True, 1), 3: (False, None), 4: (False, None)}
    texts = spark.createDataFrame([(1, "same words in this text " * 5), (2, None), (3, None), (4, "same words in this text " * 5)], "doc_id long, text string")
    assert {r.doc_id: r.duplicate_type for r in dedup.near_greedy(texts).collect()} == {1: None, 2: None, 3: None, 4: "exact"}


def test_one_row_of_a_key_is_written(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (1, "z"), (2, "c"), (2, "b"), (None, "n")], "k int, v string")
    assert sorted(map(str, tables.merge(old, new, ["k"]).collect())) == sorted(["Row(k=1, v='z')", "Row(k=2, v='c')", "Row(k=None, v='n')"])
    assert sorted(map(str, tables.insert_missing(old, new, ["k"]).collect())) == sorted(["Row(k=2, v='b')", "Row(k=None, v='n')"])


def test_places_in_two_levels(spark):
    df = spark.range(1000).select(F.expr("id * 7 % 1000").alias("o"), (F.col("id") % 5).alias("size")).repartition(5)
    rows = sorted(tables.with_places(df, ["o"], {"before": F.col("size")}, ranges=6).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1, 1001)) and [r.o for r in rows] == list(range(1000)) and rows[0].whole == 1000
    assert [r.before for r in rows] == [sum(x["size"] for x in rows[:k]) for k in range(1000)]


def test_fixed_schemas(spark):
    from siltstone.schemas import SCHEMAS, conform, struct_of

    df = spark.createDataFrame([("1", None, "99999", "x")], "id string, title string, year string, extra string")
    for kind in SCHEMAS:
        assert conform(df, kind).schema.simpleString() == struct_of(kind).simpleString()
    row = conform(df, "oa_article").first()
    assert (row.id, row.title, row.year, row.char_count) == ("1", "", 32767, 0)


def test_harvest_restarts_once():
    from siltstone.sources.feeds import chained

    pages = {None: (["a", "b"], "t1"), "t2": (["c"], None)}
    tries = []

    def parse(token):
        tries.append(token)
        if token == "t1" and tries.count("t1") == 1:
            raise LookupError("badResumptionToken")
        return pages.get(token, (["b", "x"], "t2"))

    assert [x for _, x in chained(lambda t: t, parse)] == ["a", "b", "x", "c"] and [x for _, x in chained(lambda t: t, parse, most=1)] == ["a"]


def test_harvest_passes_over_pages_of_deleted_records():
    from siltstone.sources.feeds import chained, oai_page

    record = '<record><header%s><identifier>%s</identifier></header></record>'
    gone = ' status="deleted"'
    pages = {None: (["", ""], "t1"), "t1": ([gone, gone], "t2"), "t2": ([gone, ""], None)}

    def fetch(token):
        kinds, after = pages[token]
        return ("<OAI-PMH>" + "".join(record % (k, f"{token}{n}") for n, k in enumerate(kinds)) + f"<resumptionToken>{after or ''}</resumptionToken></OAI-PMH>").encode()

    assert [json.loads(x)["id"] for _, x in chained(fetch, oai_page)] == ["None0", "None1", "t21"]


def test_cron_fields():
    assert web._cron_values("*/15", 0, 59) == [0, 15, 30, 45] and web._cron_values("1-5,9", 0, 59) == [1, 2, 3, 4, 5, 9]
    assert web._cron_values("10-20/5", 0, 59) == [10, 15, 20] and web._cron_values("x,*/0,70", 0, 59) == [] and web._cron_values("50/4", 0, 59) == [50, 54, 58]


def test_readable_without_a_main_part():
    assert html.readable("<body><nav>no</nav><h1>H</h1><p>x</p></body>")[1] == "# H\n\nx"
    assert html.byline('<meta name="author" content="Ann B">') == "Ann B" and html.byline('<span class="byline">By C</span>') == "By C"


def test_titles_decode_the_references_asked_for(spark):
    pages = [("<title> a &amp;&amp\n</title><svg><title>b</title></svg>", "a &&amp"), ("<TITLE>x &lt;&quot;&amp;lt;</TITLE>", "x <&quot;&lt;"), ("no", ""), (None, None)]
    rows = spark.createDataFrame([(k, p) for k, (p, _) in enumerate(pages)], "k long, html string")
    got = html.readable_pages(rows, "k", "html", ("lt", "gt", "amp")).orderBy("k").collect()
    assert [r.title for r in got] == [t for _, t in pages]
    assert html.readable(pages[0][0])[0] == "a &&" and html.readable(pages[1][0])[0] == 'x <"&lt;'


def test_metrics_of_odd_texts(spark):
    from siltstone.functions import text as t

    rows = [("  a\u00a0b\u2003c \n\n x ",), (None,), ("",), ("one",), ("x...\nx...\ny",)]
    got = [r for r in t.with_quality_metrics(spark.createDataFrame(rows, "text string")).collect()]
    assert [r.word_count for r in got] == [4, 0, 0, 1, 3] and got[4].duplicate_line_fraction == 0.3333 and got[4].ellipsis_line_fraction == 0.6667
    assert all(r.char_count == 0 and r.alpha_ratio == 0 for r in got[1:3])


def test_merge_and_split(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, v string, n int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "k int, v string, n int")
    assert sorted(map(tuple, tables.merge(old, new, ["k"], coalesce=True).collect())) == [(1, "a", 1), (2, "b", 5), (3, "c", 6)]
    for n in (1, 2, 10, 37):
        got = [r.split for r in tables.positional_split(spark.range(n), "id").collect()]
        assert len(got) == n and got.count("train") == max(1, int(n * 0.8)) and got.count("validation") == min(n - got.count("train"), int(n * 0.1))


def test_readers(spark, tmp_path):
    import io
    import tarfile
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.csv", "1,2")
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as f:
        info = tarfile.TarInfo("b.txt")
        info.size = 3
        f.addfile(info, io.BytesIO(b"abc"))
    (tmp_path / "x.zip").write_bytes(z.getvalue())
    (tmp_path / "y.tar.gz").write_bytes(tar.getvalue())
    got = sorted((r.member, bytes(r.content)) for r in readers.archives(spark, f"file://{tmp_path}").collect())
    assert got == [("a.csv", b"1,2"), ("b.txt", b"abc")]
    for k in (1, 2):
        (tmp_path / f"page{k}.json").write_text(json.dumps({"items": [{"n": k}, {"n": 10 * k}]}))
    spark.dataSource.register(readers.PagedSource)
    pages = spark.read.format("siltstone-pages").option("path", f"{tmp_path}/page{{page}}.json").option("pages", 2).load()
    assert sorted((r.page, r.place, json.loads(r.item)["n"]) for r in pages.collect()) == [(1, 0, 1), (1, 1, 10), (2, 0, 2), (2, 1, 20)]


def test_declared_pipeline(spark, tmp_path):
    import pytest

    from siltstone import config
    from siltstone.operators import runner

    prose = "This is a sentence of ordinary words that say nothing much at all. " * 5
    rows = [("a", prose), ("b", prose + "  "), ("c", "short"), ("d", "$$$ " * 60), ("e", prose + "More of them here.")]
    spark.createDataFrame(rows, "id string, content string").write.parquet(f"file://{tmp_path}/in")
    text = f"name: t\nsource: {{path: 'file://{tmp_path}/in'}}\nnormalise: {{}}\nquality: {{action: %s}}\ndedup: {{}}\noutput: {{format: %s, path: 'file://{tmp_path}/out-%s'}}\n"
    done = runner.run(spark, config.load(text % ("drop", "parquet", "p")))
    assert done["state"] == "COMPLETED" and done["records"] == 2 and done["files"] and all(len(f["sha256"]) == 64 for f in done["files"])
    assert runner.run(spark, config.load(text % ("flag", "jsonl", "j")))["records"] == 4
    assert runner.run(spark, config.load((text % ("drop", "csv", "c")).replace("/in'", "/none'")))["state"] == "FAILED"
    for bad in ("name: x", "name: x\nsource: {}\noutput: {format: xml}", "name: x\nsource: {}\noutput: {}\nstages: []", "name: x\nsource: {}\noutput: {}\nquality: {acton: drop}"):
        with pytest.raises(ValueError):
            config.load(bad)


def test_near_dedup_decides_long_chains(spark, monkeypatch):
    """Each row is next to the one before it only, so every other one goes; more rounds than a hundred."""
    rows = [(k, f"text {k}") for k in range(210)]
    chain = spark.createDataFrame([(k, k + 1, 1) for k in range(209)], "a long, b long, distance int").coalesce(1)
    monkeypatch.setattr(dedup, "close_pairs", lambda fps, bits: chain)
    got = dedup.near_greedy(spark.createDataFrame(rows, "doc_id long, text string"), least_chars=1).collect()
    assert sorted(r.doc_id for r in got if r.is_duplicate) == list(range(1, 210, 2))


def test_extensions(spark, tmp_path):
    import pytest

    from siltstone import extensions as x
    from siltstone.sources import files

    reg = x.Registry()
    reg.add("a", len)
    with pytest.raises(ValueError):
        reg.add("a", len)
    x.HANDLERS.add("double", lambda t: t["n"] * 2)
    x.HANDLERS.add("fail", lambda t: 1 / 0)
    assert [(r["outcome"], r["result"]) for r in x.handle([{"operation": "double", "n": 2}, {"operation": "fail"}, {"operation": "none"}])] == [("ok", 4), ("error", "division by zero"), ("no handler", None)]
    seen = []
    manifest = files.roll_parquet(spark.range(25), f"file://{tmp_path}/out", ["id"], most_rows=10, row_group=4)
    assert x.after_shards(manifest, seen.append) == len(seen) >= 3 and sum(r["records"] for r in seen) == 25


def test_streams_read_files_and_folders(spark, tmp_path):
    """A table may be one file or a folder of several; a stream reads all of either once."""
    from siltstone.plans import registry

    folder, file = f"{tmp_path}/folder", f"{tmp_path}/file"
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/one")
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(f"{file}/documents.parquet")
    for name in ("stream_exact_dedup", "stream_gate"):
        query = registry.load()[name]
        got = [sorted(map(str, query(spark, d).collect())) for d in (folder, file)]
        assert got[0] and got[0] == got[1]


def test_streams_take_several_files_at_once(spark, tmp_path):
    from siltstone.streaming import micro_batch as m

    spark.range(20).repartition(5).write.parquet(f"{tmp_path}/t")
    sizes = []
    m.drain(m.parquet_stream(spark, f"{tmp_path}/t"), lambda df, _: sizes.append(df.count()), f"{tmp_path}/c1")
    m.drain(m.parquet_stream(spark, f"{tmp_path}/t", files=2), lambda df, _: sizes.append(df.count()), f"{tmp_path}/c2")
    assert len(sizes) == 4 and sizes[0] == sum(sizes[1:]) == 20


def test_dumps_of_many_documents(spark, tmp_path):
    """More elements than one dump holds, in one partition, and none."""
    from siltstone.plans import registry

    ids = spark.range(2500).selectExpr("id AS doc_id", "'x' AS text")
    ids.coalesce(1).write.parquet(f"{tmp_path}/many/documents.parquet")
    ids.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name, want in (("s2_s3_wiki_pages", 1250), ("s4_qa_rows", 2500)):
        query = registry.load()[name]
        rows = query(spark, f"{tmp_path}/many").collect()
        assert len(rows) == len(set(rows)) == want
        assert query(spark, f"{tmp_path}/none").count() == 0


def test_a_second_root_is_no_silent_end(spark, tmp_path):
    import pytest

    (tmp_path / "two.xml").write_text('<posts><row Id="1" /></posts>\n<posts><row Id="2" /></posts>\n')
    with pytest.raises(Exception, match="not one XML document"):
        readers.qa_rows(spark, str(tmp_path), "Id long").collect()
    (tmp_path / "two.xml").write_text('<posts><row Id="1" Body="a > b" /><row /></posts>')
    assert sorted(map(tuple, readers.qa_rows(spark, str(tmp_path), "Id long, Body string").collect()), key=str) == [(1, "a > b"), (None, None)]
