"""Round trips through the sinks and readers: what is written must be read back alike."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltstone.operators import scholarly
from siltstone.plans.registry import query, table
from siltstone.schemas import conform
from siltstone.session import ensure_checkpoints
from siltstone.sources import files, readers, writers


def _folder(spark, name: str) -> str:
    """A new folder in the shared one, which executors and driver both see."""
    return f"{ensure_checkpoints(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _dumps(elements, root: str, path: str) -> None:
    """XML dumps of a thousand elements each, under one root; each is a file, as a document has one root."""
    body = F.array_join(F.collect_list("value"), "\n  ")
    dumps = elements.groupBy(F.floor(F.col("doc_id") / 1000).alias("dump")).agg(F.concat(F.lit(f"<{root}>\n  "), body, F.lit(f"\n</{root}>")).alias("value"))
    dumps.select("dump", "value").write.partitionBy("dump").text(path)


@query("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def k1_json_lines(spark, sf_dir):
    path = _folder(spark, "json")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    writers.write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("""SELECT c_custkey, c_name || ', "q"' AS name, '["' || c_mktsegment || '"]' AS tags FROM customer""")
def k2_csv(spark, sf_dir):
    path = _folder(spark, "csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(', "q"')).alias("name"), F.array("c_mktsegment").alias("tags"))
    writers.write_csv(rows, path)
    return spark.read.csv(path, header=True, schema="c_custkey long, name string, tags string", quote='"', escape='"', lineSep="\r\n", multiLine=False)


@query("SELECT count(*)::BIGINT AS rows, sum(o_orderkey)::BIGINT AS keys, 8::BIGINT AS files FROM orders")
def k5_k7_parquet_shards(spark, sf_dir):
    """Eight shards of contiguous ranges; rows and files are counted from what was written."""
    path = _folder(spark, "shards")
    writers.write_shards(table(spark, sf_dir, "orders"), path, "o_orderkey", 8)
    files = writers.manifest(path, spark).agg(F.count("*").alias("files"))
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")).crossJoin(files)


@query("SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus")
def k8_partitioned(spark, sf_dir):
    """Folders by key; the filter prunes the others."""
    path = _folder(spark, "by-status")
    writers.write_partitioned(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    return spark.read.parquet(path).where("o_orderstatus = 'F'").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT 'verified' AS verdict, 4::BIGINT AS n UNION ALL SELECT 'missing', 1")
def k16_cold_vault_verify(spark, sf_dir):
    path = _folder(spark, "vault")
    writers.write_shards(table(spark, sf_dir, "orders").select("o_orderkey"), path, "o_orderkey", 4)
    found = writers.manifest(path, spark)
    listed = found.unionByName(spark.createDataFrame([("part-none", 1, "x")], "file string, bytes long, sha256 string"))
    return writers.verify(listed, found).groupBy("verdict").agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, CASE doc_id % 3 WHEN 0 THEN 'obj' WHEN 1 THEN 'broken' ELSE 'plain' END AS kind, substr(sha256(text), 1, 12) AS h FROM documents)
SELECT CASE kind WHEN 'obj' THEN 'd' || doc_id ELSE 'set-' || lpad(n::VARCHAR, 8, '0') END AS id, CASE kind WHEN 'obj' THEN 'T' ELSE '' END AS title, CASE kind WHEN 'obj' THEN h WHEN 'broken' THEN '{' || h || '}' ELSE h END AS text FROM l""")
def s1_json_lines_or_text(spark, sf_dir):
    path = _folder(spark, "lines")
    d = table(spark, sf_dir, "documents")
    h, k = F.substring(F.sha2("text", 256), 1, 12), F.col("doc_id") % 3
    line = F.when(k == 0, F.format_string('{"id": "d%d", "title": "T", "content": "%s"}', F.col("doc_id"), h)).when(k == 1, F.concat(F.lit("{"), h, F.lit("}"))).otherwise(h)
    d.select("doc_id", line.alias("value")).repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    return readers.json_lines_or_text(spark, path, "set")


@query("SELECT doc_id AS id, 'P' || doc_id AS title, md5('x' || doc_id) AS text FROM documents WHERE doc_id % 4 NOT IN (1, 2)")
def s2_s3_wiki_pages(spark, sf_dir):
    """Other namespaces and redirects go."""
    path = _folder(spark, "wiki")
    k = F.col("doc_id")
    text = F.when(k % 4 == 2, "#REDIRECT [[x]]").otherwise(F.md5(F.concat(F.lit("x"), k)))
    page = F.format_string("<page><title>P%d</title><ns>%d</ns><id>%d</id><revision><timestamp>t</timestamp><text xml:space=\"preserve\">%s</text></revision></page>", k, F.when(k % 4 == 1, 1).otherwise(0), k, text)
    _dumps(table(spark, sf_dir, "documents").select("doc_id", page.alias("value")), "mediawiki", path)
    return readers.wiki_pages(spark, path).select("id", "title", "text")


@query("SELECT doc_id AS \"Id\", 'b' || doc_id AS \"Body\" FROM documents")
def s4_qa_rows(spark, sf_dir):
    path = _folder(spark, "qa")
    row = F.format_string('<row Id="%d" Body="b%d" />', F.col("doc_id"), F.col("doc_id"))
    _dumps(table(spark, sf_dir, "documents").select("doc_id", row.alias("value")), "posts", path)
    return readers.qa_rows(spark, path, "Id long, Body string")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'")
def s5_parquet_scan(spark, sf_dir):
    """Two columns and a filter reach the scan."""
    return table(spark, sf_dir, "orders").where("o_orderdate < timestamp '1997-01-01'").select("o_orderkey", "o_custkey")


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS nation FROM supplier")
def k3_json_array(spark, sf_dir):
    path = _folder(spark, "array")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("nation"))
    writers.write_json_array(rows, path, "s_suppkey")
    return writers.read_json_array(spark, path, "s_suppkey long, s_name string, nation int")


@query("SELECT DISTINCT sha256(c_mktsegment || c_nationkey) AS sha256, length(c_mktsegment || c_nationkey)::BIGINT AS bytes, true AS intact FROM customer")
def k13_object_store(spark, sf_dir):
    """Contents under their hashes, equal ones once, twice put."""
    root = _folder(spark, "objects")
    content = table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", "c_nationkey").cast("binary").alias("content"))
    for _ in range(2):
        writers.put_objects(content, root).write.format("noop").mode("overwrite").save()
    return writers.list_objects(spark, root).select("sha256", "bytes", "intact")


@query("SELECT event_id, event_type FROM events")
def k14_append_log(spark, sf_dir):
    path = _folder(spark, "log")
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        writers.append_log(e.where(part), path)
    return spark.read.schema("event_id long, event_type string").json(path)


@query("SELECT 'd' || doc_id AS id, 'Paper ' || doc_id AS title, doc_id::INT % 50 + 1 AS fulltext_chars FROM documents WHERE doc_id % 3 > 0")
def k10_full_texts(spark, sf_dir):
    """Articles with their texts in the fixed schema of full texts, packed and read back."""
    k = F.col("doc_id")
    articles = conform(table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), k).alias("id"), F.concat(F.lit("Paper "), k).alias("title")), "portal_article")
    texts = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), k).alias("id"), F.when(k % 3 == 0, "").otherwise(F.repeat(F.lit("x"), (k % 50 + 1).cast("int"))).alias("fulltext"))
    folder = _folder(spark, "fulltexts")
    files.roll_parquet(scholarly.with_full_texts(articles, texts), folder, ["id"], most_rows=1000)
    return spark.read.parquet(folder).select("id", "title", "fulltext_chars")


@query("SELECT event_id, event_type AS reason, event_id * 7 % 10007 AS vetoed_at FROM events WHERE event_id % 5 <> 0 ORDER BY vetoed_at DESC, event_id LIMIT 40")
def l9_quarantine(spark, sf_dir):
    """Audits as JSON, one in a line; what can't be read is skipped, the newest come first."""
    path = _folder(spark, "quarantine")
    e = F.col("event_id")
    line = F.when(e % 5 == 0, "{broken").otherwise(F.to_json(F.struct(e.alias("event_id"), F.col("event_type").alias("reason"), (e * 7 % 10007).alias("vetoed_at"))))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    rows = spark.read.schema("event_id long, reason string, vetoed_at long").option("mode", "DROPMALFORMED").json(path)
    return rows.orderBy(F.desc("vetoed_at"), "event_id").limit(40)
