"""Rolling shards, the verification gate, snapshots, run and vault states, and page layout."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltstone.operators import layout, publishing
from siltstone.plans.registry import query, table
from siltstone.session import ensure_checkpoints
from siltstone.sources import files, readers, writers


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoints(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT count(*)::BIGINT AS records, sum(o_orderkey)::BIGINT AS keys, 0::BIGINT AS too_long, true AS names_in_order, true AS hashes_agree FROM orders")
def k5_k6_rolling_shards(spark, sf_dir):
    """Files of 1,500 rows at most in row groups of 400; the manifest is held against the files themselves."""
    folder = _folder(spark, "rolled")
    manifest = files.named(files.roll_parquet(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), folder, ["o_orderkey"], most_rows=1500, row_group=400), "orders")
    found = files.hashes(spark, folder, "*.parquet").select(F.col("file").alias("f"), F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    same = manifest.join(found, F.element_at(F.split("path", "/"), -1) == F.col("f"), "full_outer")
    summed = same.agg(
        F.sum("records").alias("records"),
        F.count_if(F.col("records") > 1500).alias("too_long"),
        ((F.min("file") == "orders-part-00001") & (F.count_distinct("file") == F.max("shard_index"))).alias("names_in_order"),
        F.every(F.coalesce((F.col("s") == F.col("sha256")) & (F.col("b") == F.col("bytes")), F.lit(False))).alias("hashes_agree"),
    )
    keys = spark.read.parquet(folder).agg(F.sum("o_orderkey").alias("keys"))
    return summed.join(keys).select("records", "keys", "too_long", "names_in_order", "hashes_agree")


@query("SELECT page_id || '.html' AS member, octet_length(encode(html))::BIGINT AS bytes FROM pages")
def k9_tar_shards(spark, sf_dir):
    """Pages in TAR files that roll over, read back through the archive reader."""
    folder = _folder(spark, "tars")
    pages = table(spark, sf_dir, "pages").where("html IS NOT NULL").select(F.concat("page_id", F.lit(".html")).alias("name"), F.col("html").cast("binary").alias("content"))
    files.roll_tar(pages, folder, most_bytes=200_000)
    return readers.archives(spark, folder).select("member", F.length("content").cast("long").alias("bytes"))


_WANTED = ("o_orderkey", "o_orderstatus")


@query("""SELECT k::INT AS shard_id, k <> 3 AND k <> 5 AS record_count_matches, k <> 5 AS parquet_readable, k <> 4 AND k <> 5 AS checksum_matches, k NOT IN (3, 4, 5) AS verification_passed, k NOT IN (3, 4, 5) AS raw_may_go FROM range(1, 7) t(k)""")
def g1_verification_gate(spark, sf_dir):
    """Six written shards: one with another count than expected, one with a wrong replica, one whose file is gone."""
    folder = _folder(spark, "gate")
    orders = table(spark, sf_dir, "orders").select(*_WANTED)
    writers.write_shards(orders, folder, "o_orderkey", 6)
    replicas = files.hashes(spark, folder).withColumn("shard_id", F.element_at(F.split("file", "-"), 2).cast("int") + 1)
    found = publishing.rows_in_files(spark, folder)
    shards = replicas.join(found, "file").select("shard_id", "file", F.col("found").alias("records"), "bytes", "sha256", (F.col("found") + F.when(F.col("shard_id") == 3, 1).otherwise(0)).alias("expected"))
    gone = replicas.where("shard_id = 5").select(F.col("file").alias("g"))
    kept = replicas.withColumn("sha256", F.when(F.col("shard_id") == 4, "x").otherwise(F.col("sha256"))).join(gone, F.col("file") == F.col("g"), "left_anti")
    audit = publishing.verification_audit(shards, found.join(gone, F.col("file") == F.col("g"), "left_anti"), kept, orders.columns, list(_WANTED))
    return audit.select("shard_id", "record_count_matches", "parquet_readable", "checksum_matches", "verification_passed", "raw_may_go")


@query("""WITH s AS (SELECT l_orderkey % 40 AS shard, count(*) AS records, sum(l_linenumber) AS bytes FROM lineitem GROUP BY shard), r AS (SELECT *, row_number() OVER (ORDER BY shard) AS k, count(*) OVER () AS n FROM s),
p AS (SELECT *, CASE WHEN k <= greatest(1, floor(n * 0.8)) THEN 'train' WHEN k <= greatest(1, floor(n * 0.8)) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split FROM r)
SELECT split, count(*)::BIGINT AS shards, sum(records)::BIGINT AS records, sum(bytes)::BIGINT AS bytes, min(sha256('s' || shard)) AS first_sha, (SELECT sum(records) FROM s)::BIGINT AS total, (SELECT greatest(sum(records) * 100, round(sum(bytes) / 4)) FROM s)::BIGINT AS tokens, '2024.05.06.1' AS version FROM p GROUP BY split""")
def g2_publish_snapshot(spark, sf_dir):
    """A manifest as JSON, read again: version, totals, and splits with their shards' checksums."""
    shards = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 40).alias("shard_index")).agg(F.count("*").alias("records"), F.sum("l_linenumber").alias("bytes"))
    shards = shards.withColumns({"file": F.format_string("corpus-part-%05d", F.col("shard_index")), "sha256": F.sha2(F.concat(F.lit("s"), "shard_index"), 256)})
    manifest = publishing.snapshot_manifest(shards, "corpus", "2024-05-06").select("manifest")
    kind = "version string, records long, tokens long, splits array<struct<split: string, records: long, bytes: long, shards: array<struct<file: string, sha256: string>>>>"
    read = manifest.select(F.from_json("manifest", kind).alias("m")).select("m.version", F.col("m.records").alias("total"), "m.tokens", F.inline("m.splits"))
    return read.select("split", F.size("shards").cast("long").alias("shards"), "records", "bytes", F.array_min(F.transform("shards", lambda s: s["sha256"])).alias("first_sha"), "total", "tokens", "version")


@query("""WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'CLEANING' WHEN 'click' THEN 'PACKING' WHEN 'purchase' THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM events),
r AS (SELECT *, CASE status WHEN 'CLEANING' THEN 2 WHEN 'PACKING' THEN 3 WHEN 'COMPLETED' THEN 5 ELSE 6 END AS k FROM e), l AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM r)
SELECT user_id AS run_id, arg_max(status, event_id) AS status, max(event_id) FILTER (status IN ('COMPLETED', 'FAILED')) AS completed_at, arg_max(CASE WHEN status = 'FAILED' THEN 'e' || event_id ELSE '' END, event_id) AS error_message, count_if(k < before)::INT AS steps_back FROM l GROUP BY user_id""")
def g3_run_lifecycle(spark, sf_dir):
    """States of runs from their logs; a time of completion outlives a restart."""
    status = F.when(F.col("event_type") == "view", "CLEANING").when(F.col("event_type") == "click", "PACKING").when(F.col("event_type") == "purchase", "COMPLETED").otherwise("FAILED")
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), status.alias("status"), F.when(status == "FAILED", F.concat(F.lit("e"), "event_id")).otherwise("").alias("error_message"), F.col("event_id").alias("at"))
    return publishing.run_states(log)


@query("SELECT * FROM (VALUES ('all', 'healthy', 4::BIGINT, 0::BIGINT, 0::BIGINT), ('one gone', 'incomplete', 4, 0, 1), ('one changed', 'corrupted', 3, 1, 1), ('none', 'incomplete', 0, 0, 0)) v(vault, state, verified, corrupted, missing)")
def k16_vault_state(spark, sf_dir):
    """Shards of orders against lists of them: whole, with a file that is gone, with a wrong sum besides, and no list at all."""
    folder = _folder(spark, "vault")
    writers.write_shards(table(spark, sf_dir, "orders").select("o_orderkey"), folder, "o_orderkey", 4)
    found = writers.manifest(folder, spark)
    lost = found.unionByName(spark.createDataFrame([("part-none", 1, "x")], "file string, bytes long, sha256 string"))
    changed = lost.withColumn("sha256", F.when(F.col("file").startswith("part-00002"), "x").otherwise(F.col("sha256")))
    out = None
    for name, listed in (("all", found), ("one gone", lost), ("one changed", changed), ("none", found.where("false"))):
        one = publishing.vault_state(writers.verify(listed, found)).withColumn("vault", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


_PAGE_LINES = r"list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"


@query(rf"""WITH p AS (SELECT source AS doc_id, doc_id AS page, 'Head of ' || source || chr(10) || coalesce(text, '') || chr(10) || CASE WHEN doc_id % 5 < 3 THEN '  Foot' ELSE 'p. ' || doc_id END AS t FROM documents),
l AS (SELECT doc_id, page, t, {_PAGE_LINES} AS ls FROM p), n AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id),
z AS (SELECT doc_id, 'top' AS zone, unnest(list_distinct(list_filter(ls[1:2], lambda x: x <> ''))) AS line FROM l UNION ALL SELECT doc_id, 'bottom', unnest(list_distinct(list_filter(ls[-2:], lambda x: x <> ''))) FROM l),
b AS (SELECT z.doc_id, line FROM z JOIN n USING (doc_id) WHERE n >= 3 GROUP BY z.doc_id, zone, line, n HAVING count(*) >= n * 0.5), g AS (SELECT doc_id, list(DISTINCT line) AS gone FROM b GROUP BY doc_id)
SELECT doc_id, page, md5(CASE WHEN gone IS NULL THEN t ELSE regexp_replace(array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT list_contains(gone, regexp_replace(x, '^\s+|\s+$', '', 'g'))), chr(10)), '^\s+|\s+$', '', 'g') END) AS body FROM l LEFT JOIN g USING (doc_id)""")
def b1_boilerplate_lines(spark, sf_dir):
    """Heads and feet of a source's documents, taken as its pages, are found and removed."""
    k = F.col("doc_id")
    foot = F.when(k % 5 < 3, "  Foot").otherwise(F.concat(F.lit("p. "), k))
    text = F.concat_ws("\n", F.concat(F.lit("Head of "), "source"), F.coalesce("text", F.lit("")), foot)
    pages = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), k.alias("page"), text.alias("text"))
    return layout.without_page_boilerplate(pages).select("doc_id", "page", F.md5("text").alias("body"))


@query("SELECT doc_id // 7 AS doc, doc_id AS page, CASE WHEN count(*) OVER (PARTITION BY doc_id // 7) >= 3 THEN '' ELSE 'Head,' END || 'a' || doc_id || ',Head,b' || CASE WHEN count(*) OVER (PARTITION BY doc_id // 7) >= 3 THEN '' ELSE ',Foot' END AS kept FROM documents")
def b2_boilerplate_items(spark, sf_dir):
    """Positioned heads and feet go; the same words in the middle of a page stay. Seven documents in a row are one's pages."""
    item = lambda s, y: F.struct(s.alias("str"), F.lit(0.0).alias("x"), F.lit(float(y)).alias("y"), F.lit(True).alias("eol"))
    k = F.col("doc_id")
    items = F.array(item(F.lit("Head"), 800), item(F.concat(F.lit("a"), k), 600), item(F.lit("Head"), 400), item(F.lit("b"), 300), item(F.lit("Foot"), 10))
    pages = table(spark, sf_dir, "documents").select(F.floor(k / 7).alias("doc_id"), k.alias("page"), items.alias("items"))
    out = layout.without_repeated_items(pages)
    return out.select(F.col("doc_id").alias("doc"), "page", F.array_join(F.transform("items", lambda i: i["str"]), ",").alias("kept"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'one two' || chr(10) || 'three' ELSE 'left ' || doc_id || chr(10) || 'below' || chr(10) || chr(10) || 'right' || chr(10) || 'end' END AS text FROM documents""")
def x7_t8_reading_order(spark, sf_dir):
    """Two columns whose lines come mixed, or one."""
    item = lambda s, x, y, eol: F.struct(s.alias("str"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), F.lit(eol).alias("eol"))
    k = F.col("doc_id")
    two = F.array(item(F.lit("end"), 300, 600, True), item(F.concat(F.lit("left "), k), 10, 700, True), item(F.lit("right"), 302, 700, True), item(F.lit("below"), 12, 650, True))
    one = F.array(item(F.lit("one "), 10, 700, False), item(F.lit("two"), 25, 700, True), item(F.lit("three"), 10, 600, True))
    pages = table(spark, sf_dir, "documents").select("doc_id", F.when(k % 3 == 0, one).otherwise(two).alias("items"))
    return pages.select("doc_id", layout.reading_order(F.col("items")).alias("text"))


@query("""SELECT doc_id, 'It begins ' || doc_id || ' and goes' || chr(10) || 'on and on' || chr(10) || 'without doubt here to the compound end.' || chr(10) || chr(10) || 'Last words' || chr(10) || 'are said.' AS text FROM documents""")
def b3_readable_documents(spark, sf_dir):
    """Three pages of each document: heads, numbers and rules go, a cut word is joined, a paragraph begins after a sentence."""
    head = "Running head of the book\n"
    k = F.col("doc_id")
    texts = [F.concat(F.lit(f"{head}It begins "), k, F.lit(" and goes\non and on\nwithout\n- 1 -\nSayfa 1\ndoubt here to the com-")), F.lit(f"{head}2\npound end.\r\n______\n\n 3 \n."), F.lit(f"{head}Last words\nare said.")]
    texts[0] = F.concat(F.lit(f"{head}It begins "), k, F.lit(" and goes\non and on\n- 1 -\nSayfa 1\nwithout doubt here to the com-"))
    texts[1] = F.lit(f"{head}12\npound end.\r\n______\n\n 3 ")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.array(*texts)).alias("page", "text"))
    # Pages of few lines have no vote, so each is given some more of them at its end, which all repeat.
    rows = rows.withColumn("text", F.concat(F.lit("Title page line\n"), "text", F.lit("\nFoot of the page\nThe very last line")))
    rows = rows.withColumn("text", F.when(F.col("page") == 1, F.replace("text", F.lit("______\n"), F.lit("______\n....\n"))).otherwise(F.replace("text", F.lit("are said."), F.lit("are said.\n======"))))
    return layout.readable_documents(rows)
