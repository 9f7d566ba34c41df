"""Paged and packaged sources: pages are built from whole tables, written or linked as a service would, and read back."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from siltstone.operators import actor_records
from siltstone.plans.registry import query, table
from siltstone.session import ensure_checkpoints
from siltstone.sources import documents, feeds, readers


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoints(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _put(pages, folder: str) -> str:
    """Write ``pages(name, content)`` as files of these names, by the tasks that hold them."""

    def run(batches):
        from siltstone.sources.files import open_uri

        for b in batches:
            for name, content in zip(b["name"], b["content"]):
                fs, path = open_uri(f"{folder}/{name}")
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(path, compression=None) as f:
                    f.write(content.encode())
            yield b[["name"]]

    pages.select("name", "content").mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()
    return folder


_SITE = "http://x.org"


@query(f"SELECT '{_SITE}/c/' || c_custkey AS loc, CASE WHEN c_custkey % 2 = 0 THEN '2024-01-02' END AS lastmod, (c_custkey % 10) / 10.0::DOUBLE AS priority, 1 AS level FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT '{_SITE}/feed/' || s_suppkey, 'Mon', NULL, 1 FROM supplier")
def s17_sitemaps(spark, sf_dir):
    """An index of one sitemap for each nation and a feed; one sitemap is missing, one is broken, all others are gzipped or not."""
    c = table(spark, sf_dir, "customer")
    entry = F.format_string("<url><loc>%s/c/%d</loc>%s<priority>%s</priority></url>", F.lit(_SITE), F.col("c_custkey"), F.when(F.col("c_custkey") % 2 == 0, "<lastmod>2024-01-02</lastmod>").otherwise(""), (F.col("c_custkey") % 10 / 10).cast("string"))
    maps = c.groupBy("c_nationkey").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    maps = maps.select(F.format_string("%s/map%d.xml", F.lit(_SITE), F.col("c_nationkey")).alias("url"), _zipped("xml").alias("content"))
    items = F.format_string("<item><link>%s/feed/%d</link><pubDate>Mon</pubDate></item>", F.lit(_SITE), F.col("s_suppkey"))
    feed = table(spark, sf_dir, "supplier").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(items), ""), F.lit("</channel></rss>")).alias("xml"))
    feed = feed.select(F.lit(f"{_SITE}/feed.xml").alias("url"), F.col("xml").cast("binary").alias("content"))
    links = "".join(f"<sitemap><loc>{_SITE}/{name}</loc></sitemap>" for name in [*(f"map{k}.xml" for k in range(25)), "feed.xml", "gone.xml", "broken.xml", "root.xml"])
    fixed = spark.createDataFrame([(f"{_SITE}/root.xml", f"<sitemapindex>{links}</sitemapindex>".encode()), (f"{_SITE}/broken.xml", b"<urlset><url>")], "url string, content binary")
    out = feeds.crawl_sitemaps(maps.unionByName(feed).unionByName(fixed), f"{_SITE}/root.xml", patterns=[f"{_SITE}/*"])
    kept = out.where(~F.col("loc").rlike("/c/[0-9]*[05]$"))
    return kept.select("loc", "lastmod", F.when(~F.isnan("priority"), F.col("priority")).alias("priority"), "level")


@F.pandas_udf(BinaryType())
def _zipped(s: pd.Series) -> pd.Series:
    import gzip

    return pd.Series([gzip.compress(x.encode()) if k % 2 else x.encode() for k, x in enumerate(s)])


@query("SELECT 'x/' || p_brand || '/' || p_partkey || '.zip' AS key, p_size::BIGINT AS size FROM part")
def s8_c41_bucket_tree(spark, sf_dir):
    """A listing of prefixes, one below for each brand, in pages of a marker."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size", (F.col("p_partkey") % 3).alias("page"))
    # Pages by key order within a brand; the next page's marker is named.
    content = F.format_string("<Contents><Key>x/%s/%d.zip</Key><Size>%d</Size></Contents>", F.col("p_brand"), F.col("p_partkey"), F.col("p_size"))
    pages = p.groupBy("p_brand", "page").agg(F.array_join(F.collect_list(content), "").alias("body"))
    last = pages.groupBy("p_brand").agg(F.array_sort(F.collect_set("page")).alias("all"))
    pages = pages.join(last.withColumnRenamed("p_brand", "b"), F.col("b") == F.col("p_brand"))
    at = F.array_position("all", F.col("page")).cast("int")
    marker = F.get("all", at)
    xml = F.concat(F.lit("<ListBucketResult><Prefix>x/"), "p_brand", F.lit("/</Prefix>"), F.when(marker.isNotNull(), F.concat(F.lit("<IsTruncated>true</IsTruncated><NextMarker>m"), marker, F.lit("</NextMarker>"))).otherwise("<IsTruncated>false</IsTruncated>"), "body", F.lit("</ListBucketResult>"))
    below = pages.select(F.concat(F.lit("x/"), "p_brand", F.lit("/?"), F.when(at > 1, F.concat(F.lit("m"), F.col("page"))).otherwise("")).alias("url"), xml.cast("binary").alias("content"))
    brands = p.select("p_brand").distinct().agg(F.array_join(F.collect_list(F.concat(F.lit("<CommonPrefixes><Prefix>x/"), "p_brand", F.lit("/</Prefix></CommonPrefixes>"))), "").alias("b"))
    root = brands.select(F.lit("x/?").alias("url"), F.concat(F.lit("<ListBucketResult><Prefix>x/</Prefix>"), "b", F.lit("</ListBucketResult>")).cast("binary").alias("content"))
    return feeds.bucket_tree(below.unionByName(root), "x/").select("key", "size")


@query("SELECT 'oai:' || s_suppkey AS id, s_name AS title, s_nationkey::INT AS chain FROM supplier WHERE s_suppkey % 7 <> 0")
def s9_oai_harvest(spark, sf_dir):
    """A set for each nation, in pages of four records; deleted records go."""
    s = table(spark, sf_dir, "supplier")
    record = F.format_string(
        '<record><header%s><identifier>oai:%d</identifier><datestamp>2024</datestamp></header><metadata><dc xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>%s</dc:title></dc></metadata></record>',
        F.when(F.col("s_suppkey") % 7 == 0, ' status="deleted"').otherwise(""),
        F.col("s_suppkey"),
        F.col("s_name"),
    )
    pages = _pages(s, "s_nationkey", "s_suppkey", record)
    token = F.when(F.col("page") < F.col("last"), F.format_string("<resumptionToken>t%d</resumptionToken>", F.col("page") + 1)).otherwise("<resumptionToken/>")
    xml = F.concat(F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>'), F.array_join("rows", ""), token, F.lit("</ListRecords></OAI-PMH>"))
    folder = _put(pages.select("name", xml.alias("content")), _folder(spark, "oai"))
    _register(spark)
    chains = ",".join(str(r.c) for r in s.select(F.col("s_nationkey").alias("c")).distinct().collect())  # a set for each nation
    rows = spark.read.format("siltstone-harvest").option("folder", folder).option("kind", "oai").option("sets", chains).load()
    return rows.select(F.get_json_object("item", "$.id").alias("id"), F.get_json_object("item", "$.dc.title[0]").alias("title"), F.col("chain").cast("int").alias("chain"))


def _pages(df, chain: str, order: str, item, size: int = 4):
    """(name, page, last, rows): items of a chain in pages, the first named ``start``, others by token."""
    from pyspark.sql import Window

    w = Window.partitionBy(chain).orderBy(order)
    numbered = df.select(F.col(chain).alias("chain"), item.alias("item"), F.col(order).alias("o"), F.floor((F.row_number().over(w) - 1) / size).alias("page"))
    pages = numbered.groupBy("chain", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "item"))), lambda x: x["item"]).alias("rows"))
    last = pages.groupBy(F.col("chain").alias("c")).agg(F.max("page").alias("last"))
    name = F.concat(F.col("chain").cast("string"), F.lit("/"), F.when(F.col("page") == 0, "start").otherwise(F.concat(F.lit("t"), "page")))
    return pages.join(last, F.col("c") == F.col("chain")).withColumn("name", name)


def _register(spark) -> None:
    spark.dataSource.register(feeds.Harvest)


@query("SELECT c_custkey AS id, c_mktsegment AS segment FROM customer WHERE c_custkey % 6 = 0")
def s10_s12_cursor_scan(spark, sf_dir):
    """Pages that name the next cursor, in chains side by side; keys are projected from the items, a filter runs on them."""
    c = table(spark, sf_dir, "customer").withColumn("chain", F.col("c_custkey") % 3)
    pages = _pages(c, "chain", "c_custkey", F.format_string('{"id": %d, "meta": {"segment": "%s"}}', F.col("c_custkey"), F.col("c_mktsegment")), 50)
    cursor = F.when(F.col("page") < F.col("last"), F.concat(F.lit('"t'), (F.col("page") + 1).cast("string"), F.lit('"'))).otherwise("null")
    body = F.concat(F.lit('{"meta": {"next_cursor": '), cursor, F.lit('}, "results": ['), F.array_join("rows", ", "), F.lit("]}"))
    folder = _put(pages.select("name", body.alias("content")), _folder(spark, "cursor"))
    _register(spark)
    rows = spark.read.format("siltstone-harvest").option("folder", folder).option("sets", "0,1,2").load()
    return rows.select(F.get_json_object("item", "$.id").cast("long").alias("id"), F.get_json_object("item", "$.meta.segment").alias("segment")).where("id % 6 = 0")


@query("SELECT p_partkey::INT AS book_id, p_name AS title, 'A B; C' AS creators, 'en' AS language, 'u/' || p_partkey AS text_url FROM part WHERE p_size % 3 <> 0")
def s14_c45_catalogue(spark, sf_dir):
    """Entries of a catalogue in RDF; those without a text go."""
    p = table(spark, sf_dir, "part")
    head = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:d="t:" xmlns:g="g:">'
    value = lambda x: F.concat(F.lit("<rdf:Description><rdf:value>"), x, F.lit("</rdf:value></rdf:Description>"))
    xml = F.concat(
        F.lit(f'{head}<g:ebook rdf:about="ebooks/'),
        F.col("p_partkey").cast("string"),
        F.lit('"><d:title>'),
        "p_name",
        F.lit("</d:title><d:creator><g:agent><g:name>A B</g:name></g:agent></d:creator><d:creator><g:agent><g:name>C</g:name></g:agent></d:creator><d:language>"),
        value(F.lit("en")),
        F.lit("</d:language><d:type>"),
        value(F.when(F.col("p_size") % 3 == 0, "Sound").otherwise("Text")),
        F.lit('</d:type><g:hasFormat><g:file rdf:about="u/'),
        F.col("p_partkey").cast("string"),
        F.lit('"><d:format>'),
        value(F.lit("text/plain")),
        F.lit("</d:format></g:file></g:hasFormat></g:ebook></rdf:RDF>"),
    )
    books = feeds.parsed(p.select(F.lit("").alias("url"), xml.cast("binary").alias("content")), feeds.catalogue_books, feeds.BOOKS)
    return books.select("book_id", "title", "creators", "language", F.col("formats")["text/plain"].alias("text_url"))


@query("SELECT c_custkey AS id, c_name || ', \"q\"' || chr(10) || 'x' AS name, c_mktsegment AS segment FROM customer")
def x6_delimited(spark, sf_dir):
    """Files of one delimiter or another, with quoted delimiters, quotes and line ends in cells."""
    c = table(spark, sf_dir, "customer")
    mark = F.element_at(F.array(F.lit(","), F.lit("\t"), F.lit(";"), F.lit("|")), (F.col("c_nationkey") % 4 + 1).cast("int"))
    line = F.concat(F.col("c_custkey").cast("string"), mark, F.lit('"'), "c_name", F.lit(', ""q""\nx"'), mark, "c_mktsegment")
    files = c.groupBy("c_nationkey", mark.alias("mark")).agg(F.concat(F.concat_ws("", F.lit("id"), "mark", F.lit("name"), "mark", F.lit("segment")), F.lit("\r\n"), F.array_join(F.collect_list(line), "\r\n")).alias("body"))
    rows = documents.delimited_tables(files.select(F.col("c_nationkey").cast("string").alias("path"), F.col("body").cast("binary").alias("content")))
    return rows.select(*(F.get_json_object("record", f"$.{k}").alias(k) for k in ("id", "name", "segment"))).withColumn("id", F.col("id").cast("long"))


def _package(kind: str, key: int, name: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        if kind == "word":
            w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
            run = lambda x: f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>"
            z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>{name}</w:t></w:r></w:p>{run("No. " + str(key))}<w:tbl><w:tr><w:tc>{run("a")}</w:tc><w:tc>{run("b")}</w:tc></w:tr><w:tr><w:tc>{run(1)}</w:tc><w:tc>{run("x|y")}</w:tc></w:tr></w:tbl></w:body></w:document>')
        elif kind == "sheet":
            z.writestr("xl/workbook.xml", f'<workbook><sheets><sheet name="{name}"/></sheets></workbook>')
            z.writestr("xl/sharedStrings.xml", f"<sst><si><t>key</t></si><si><r><t>na</t></r><r><t>me</t></r></si><si><t>{name}</t></si></sst>")
            z.writestr("xl/worksheets/sheet1.xml", f'<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>{key}</v></c><c r="C2" t="s"><v>2</v></c></row></sheetData></worksheet>')
        else:
            z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>')
            z.writestr("O/p.opf", '<package><manifest><item id="n" href="t.ncx"/><item id="a" href="a.xhtml"/><item id="b" href="b.xhtml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/></spine></package>')
            z.writestr("O/t.ncx", f'<ncx><navMap><navPoint><navLabel><text>{name}</text></navLabel><content src="b.xhtml#x"/></navPoint></navMap></ncx>')
            z.writestr("O/a.xhtml", f"<html><body><p>second {key}</p></body></html>")
            z.writestr("O/b.xhtml", "<html><body><h1>First</h1><p>one</p></body></html>")
    return out.getvalue()


@F.pandas_udf(BinaryType())
def _packed(kind: pd.Series, key: pd.Series, name: pd.Series) -> pd.Series:
    return pd.Series([b"no package" if k == "none" else _package(k, i, n) for k, i, n in zip(kind, key, name)])


@query(r"""SELECT s_suppkey AS id, 'word' AS kind, 0 AS place, '' AS title, '## ' || s_name || chr(10) || chr(10) || 'No. ' || s_suppkey || chr(10) || chr(10) || '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | x\|y |' AS text FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT s_suppkey, 'sheet', 0, s_name, '| key |  | name |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || s_suppkey || ' |  | ' || s_name || ' |' FROM supplier WHERE s_suppkey % 4 = 1
UNION ALL SELECT s_suppkey, 'book', 0, s_name, '# First' || chr(10) || chr(10) || 'one' FROM supplier WHERE s_suppkey % 4 = 2 UNION ALL SELECT s_suppkey, 'book', 1, '', 'second ' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 2
UNION ALL SELECT s_suppkey, 'unreadable', 0, 'BadZipFile', '' FROM supplier WHERE s_suppkey % 4 = 3""")
def s22_packages(spark, sf_dir):
    """Word processor files, spreadsheets and e-books are made of every row and read back; what is none is named so."""
    kind = F.element_at(F.array(F.lit("word"), F.lit("sheet"), F.lit("book"), F.lit("none")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    files = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("path"), _packed(kind, "s_suppkey", "s_name").alias("content"))
    return documents.package_texts(files).select(F.col("path").cast("long").alias("id"), "kind", "place", "title", "text")


@query("SELECT doc_id::VARCHAR AS id, 'P' || doc_id AS title, md5('t' || doc_id) AS text FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0")
def s24_wiki_extract(spark, sf_dir):
    """Extracted articles in JSON lines; those without a title or text go."""
    folder = _folder(spark, "extract")
    k = F.col("doc_id")
    line = F.to_json(F.struct(k.cast("string").alias("id"), F.lit("u").alias("url"), F.when(k % 5 != 0, F.concat(F.lit("P"), k)).otherwise("").alias("title"), F.when(k % 7 != 0, F.md5(F.concat(F.lit("t"), k))).otherwise(" ").alias("text")))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(folder)
    return readers.wiki_extracts(spark, folder).select("id", "title", "text")


@query("SELECT ordinal::INT AS place, 'part_' || ordinal || '.gz' AS url, ordinal * 10 AS records FROM (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS ordinal FROM supplier)")
def s6_manifest_partitions(spark, sf_dir):
    """The files that a manifest lists, with their places; a manifest is one small file."""
    folder = _folder(spark, "manifest")
    n = table(spark, sf_dir, "supplier").count()
    entries = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(F.concat(F.lit("part_"), k, F.lit(".gz")).alias("url"), F.struct((k * 10).alias("record_count"), k.alias("content_length")).alias("meta")))
    spark.range(1).select(F.to_json(F.struct(entries.alias("entries"))).alias("value")).write.text(folder)
    return readers.manifest_partitions(spark, folder).select("place", "url", "records")


@query("""SELECT doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 'HumanEval/' || doc_id WHEN 1 THEN 'm' || doc_id ELSE doc_id + 1 || '' END AS task_id, 'do ' || source AS prompt, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a' || chr(10) || 'b' ELSE 't' END AS test, 'code' AS solution, CASE doc_id % 3 WHEN 2 THEN 'rust' ELSE 'python' END AS language FROM documents""")
def c24_code_tasks(spark, sf_dir):
    """Three shapes of benchmark rows."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    k = F.col("doc_id")
    shapes = {
        "humaneval": F.format_string('{"prompt": " do %s ", "canonical_solution": "code"}', "source"),
        "mbpp": F.format_string('{"id": "m%d", "text": "do %s", "code": "code", "test_list": ["a", "b"]}', k, F.col("source")),
        "other": F.format_string('{"question": "do %s", "solution": "code", "test_patch": "t", "language": "rust"}', "source"),
    }
    out = None
    for n, (name, row) in enumerate(shapes.items()):
        rows = d.where(k % 3 == n).select(k.alias("place"), row.alias("row"))
        one = actor_records.code_tasks(rows, name).withColumn("id", F.lit(n))
        out = one if out is None else out.unionByName(one)
    number = F.regexp_extract("task_id", r"(\d+)$", 1).cast("long")
    return out.select(F.when(F.col("id") == 2, number - 1).otherwise(number).alias("id"), "task_id", "prompt", "test", "solution", "language")


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'the claim' ELSE 'lead ' || source END AS theorem, ['p1 ' || doc_id, 'p2'] AS proofs, [source] AS definitions, ['one', 'two'] AS sources FROM documents""")
def c35_wiki_sections(spark, sf_dir):
    k = F.col("doc_id")
    text = F.concat(F.lit("lead "), "source", F.when(k % 2 == 0, "\n== Theorem ==\nthe claim").otherwise(""), F.lit("\n== Proof 1 ==\np1 "), k, F.lit("\n==Definition==\n"), "source", F.lit("\n== Proof 2 ==\n p2\n== Sources ==\n* one\n\n** two\n== Also see ==\nx"))
    return actor_records.wiki_sections(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), "doc_id", "text")


@query("""SELECT doc_id::VARCHAR AS path, 0 AS place, 't' || doc_id AS name, 'theorem' AS kind, 'says ' || source AS docstring, '(a : Nat) : a = a' AS signature, 'by' || chr(10) || '  simp' || chr(10) || '  -- no' || chr(10) || '  rfl' AS proof, 'simp,rfl' AS tactics FROM documents
UNION ALL SELECT doc_id::VARCHAR, 1, 'b.c', 'def', NULL, 'Nat', '3', '' FROM documents""")
def c36_declarations(spark, sf_dir):
    source = F.concat(F.lit("import x\n\n/-- says "), "source", F.lit(" -/\nprotected theorem t"), "doc_id", F.lit(" (a : Nat) : a = a := by\n  simp\n  -- no\n  rfl\n\n@[simp] def b.c : Nat := 3\n"))
    out = actor_records.declarations(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), source.alias("source")))
    return out.withColumn("tactics", F.array_join("tactics", ","))


@query("""SELECT '2301.' || lpad((doc_id % 100000)::VARCHAR, 5, '0') || 'v1' AS paper_id, 'A title' AS title, 'Ann,Bo' AS authors, 'cs.AI' AS primary_category, 'cs.AI,' || lang AS categories, 'http://a/pdf/' || doc_id AS pdf_url, 'http://a/abs/' || doc_id AS html_url FROM documents""")
def c39_feed_papers(spark, sf_dir):
    k = F.col("doc_id")
    entry = F.concat(
        F.lit("<entry><id>http://a.org/abs/2301."),
        F.lpad((k % 100000).cast("string"), 5, "0"),
        F.lit('v1</id><title>A\n  title</title><summary>s</summary><author><name>Ann</name></author><author><name>Bo</name></author><category term="cs.AI"/><category term="'),
        "lang",
        F.lit('"/><category term="cs.AI"/><link href="http://a/abs/'),
        k,
        F.lit('" rel="alternate"/><link href="http://a/pdf/'),
        k,
        F.lit('" title="pdf"/></entry>'),
    )
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), entry, F.lit("</feed>"))
    out = actor_records.papers_of_feeds(table(spark, sf_dir, "documents").select(k.cast("string").alias("url"), feed.cast("binary").alias("content")))
    return out.select("paper_id", "title", F.array_join("authors", ",").alias("authors"), "primary_category", F.array_join("categories", ",").alias("categories"), "pdf_url", "html_url")


@query("""SELECT 'c' || doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 'video' WHEN 1 THEN 'carousel' ELSE 'image' END AS media_type, CASE doc_id % 3 WHEN 0 THEN 'cap ' || source WHEN 1 THEN 'o' ELSE 'plain' END AS caption, CASE WHEN doc_id % 2 = 0 THEN 7 ELSE 9 END::BIGINT AS likes, 0::BIGINT AS comments FROM documents""")
def c40_media(spark, sf_dir):
    k = F.col("doc_id")
    shape = F.when(k % 3 == 0, F.concat(F.lit('"is_video": true, "edge_media_to_caption": {"edges": [{"node": {"text": "cap '), "source", F.lit('"}}]}'))).when(k % 3 == 1, '"carousel_media": [1], "caption": {"text": "o"}').otherwise('"caption": "plain"')
    item = F.concat(F.lit('{"code": "c'), k, F.lit('", "edge_liked_by": {"count": '), F.when(k % 2 == 0, "7").otherwise("0"), F.lit('}, "like_count": 9, '), shape, F.lit("}"))
    return actor_records.media_rows(table(spark, sf_dir, "documents").select(item.alias("item"))).select("id", "media_type", "caption", "likes", "comments")
