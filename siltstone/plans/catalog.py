"""Catalogue, ledger, publishing and verification."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siltstone.operators import tables as ops
from siltstone.plans.registry import query, table

#: orders as a job table: DuckDB and Spark give the same columns.
_JOBS = """j AS (SELECT o_orderkey AS job_id, CASE o_orderkey % 5 WHEN 0 THEN 'queued' WHEN 1 THEN 'running' WHEN 2 THEN 'retry_wait' WHEN 3 THEN 'done' ELSE 'failed' END AS status, (o_custkey % 100)::BIGINT AS available_at,
(o_orderkey % 4)::INT AS attempt, 3 AS max_attempts, (o_orderkey % 3)::INT AS epoch, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS owner, (o_custkey % 120)::BIGINT AS expires_at FROM orders)"""


def _jobs(spark, sf_dir):
    k = F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, ("queued", "running", "retry_wait", "done", "failed"))), (k % 5 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(k.alias("job_id"), status.alias("status"), (F.col("o_custkey") % 100).alias("available_at"), (k % 4).cast("int").alias("attempt"), F.lit(3).alias("max_attempts"), (k % 3).cast("int").alias("epoch"), F.when(k % 2 == 0, "a").otherwise("b").alias("owner"), (F.col("o_custkey") % 120).alias("expires_at"))


@query(f"WITH {_JOBS} SELECT job_id, 'running' AS status, 'me' AS owner, attempt + 1 AS attempt, epoch + 1 AS epoch, 90::BIGINT AS expires_at FROM j WHERE status IN ('queued', 'retry_wait') AND available_at <= 60 AND attempt < max_attempts ORDER BY available_at, job_id LIMIT 1")
def l1_claim_next(spark, sf_dir):
    return ops.claim_next(_jobs(spark, sf_dir), "me", now=60, lease=30).select("job_id", "status", "owner", "attempt", "epoch", "expires_at")


@query(f"WITH {_JOBS} SELECT job_id, CASE WHEN status = 'running' AND owner = 'a' AND epoch = 1 AND expires_at > 60 THEN 160::BIGINT ELSE expires_at END AS expires_at FROM j")
def l2_heartbeat(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ops.update_where(jobs, ops.fenced("a", F.lit(1), 60), {"expires_at": F.lit(160).cast("long")}).select("job_id", "expires_at")


@query(f"""WITH {_JOBS}, n AS (SELECT *, CASE WHEN job_id % 35 = 1 THEN 'quarantined' WHEN attempt >= max_attempts THEN 'failed' ELSE 'retry_wait' END AS s FROM j)
SELECT job_id, CASE WHEN status = 'running' THEN s ELSE status END AS status, CASE WHEN status = 'running' AND s = 'retry_wait' THEN 60 + least(300, 2 ** attempt * 5)::BIGINT ELSE available_at END AS available_at FROM n""")
def l3_fail(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    return ops.fail(jobs, F.col("status") == "running", 60, F.col("job_id") % 35 == 1, F.lit(False)).select("job_id", "status", "available_at")


@query(f"WITH {_JOBS} SELECT job_id, CASE WHEN status = 'running' AND expires_at <= 60 THEN CASE WHEN attempt >= max_attempts THEN 'failed' ELSE 'retry_wait' END ELSE status END AS status FROM j")
def l4_reap(spark, sf_dir):
    return ops.reap(_jobs(spark, sf_dir), 60).select("job_id", "status")


_OUTBOX = "o AS (SELECT event_id, ts, event_type, CASE WHEN user_id % 4 = 0 THEN 'dispatched' WHEN user_id % 4 = 1 THEN 'claimed' ELSE 'pending' END AS status, (user_id % 3)::INT AS attempts, (user_id % 90)::BIGINT AS claimed_until FROM events)"


def _outbox(spark, sf_dir):
    u = F.col("user_id")
    status = F.when(u % 4 == 0, "dispatched").when(u % 4 == 1, "claimed").otherwise("pending")
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", status.alias("status"), (u % 3).cast("int").alias("attempts"), (u % 90).cast("long").alias("claimed_until"))


@query(f"""WITH {_OUTBOX}, c AS (SELECT event_id FROM o WHERE status = 'pending' OR (status = 'claimed' AND claimed_until <= 60) ORDER BY ts, event_id LIMIT 50)
SELECT event_id, CASE WHEN event_id IN (FROM c) THEN 'claimed' ELSE status END AS status, attempts + CASE WHEN event_id IN (FROM c) THEN 1 ELSE 0 END AS attempts, CASE WHEN event_id IN (FROM c) THEN 90::BIGINT ELSE claimed_until END AS claimed_until FROM o""")
def l5_outbox_claim(spark, sf_dir):
    """The oldest fifty that are pending, or whose claim ran out, are claimed; all others stay as they are."""
    return ops.claim_batch(_outbox(spark, sf_dir), ["ts", "event_id"], "event_id", now=60, lease=30, most=50).select("event_id", "status", "attempts", "claimed_until")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 2 THEN 'cursor-2' ELSE 'cursor-1' END AS cursor, CASE WHEN s_suppkey % 4 = 2 THEN 3 ELSE (s_suppkey % 4)::INT END AS revision FROM supplier")
def l6_compare_and_set(spark, sf_dir):
    parts = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("cursor-1").alias("cursor"), (F.col("s_suppkey") % 4).cast("int").alias("revision"))
    return ops.update_where(parts, F.col("revision") == 2, {"cursor": F.lit("cursor-2"), "revision": F.col("revision") + 1})


@query("SELECT c_custkey AS source FROM customer WHERE c_custkey % 2 = 1")
def l7_idempotent_create(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source"))
    return ops.insert_missing(c.where("source % 2 = 0"), c.unionByName(c), ["source"])


@query("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def l8_registry_listing(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25)


@query(f"""WITH {_OUTBOX}, h AS (SELECT *, CASE WHEN event_type = 'purchase' THEN 'ok' WHEN event_type = 'click' THEN 'error' END AS outcome FROM o WHERE status = 'claimed'),
n AS (SELECT *, CASE WHEN outcome = 'ok' THEN 'dispatched' WHEN attempts >= 2 THEN 'dead' ELSE 'pending' END AS after FROM h)
SELECT event_type, count(*)::BIGINT AS claimed, count_if(after = 'dispatched')::BIGINT AS dispatched, count_if(after = 'pending')::BIGINT AS retried, count_if(after = 'dead')::BIGINT AS dead FROM n GROUP BY event_type""")
def l10_dispatch_counts(spark, sf_dir):
    """Claimed messages after their handlers: done, to be tried again, or given up; a type without a handler counts as failed."""
    handled = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "click", "error")
    after = ops.settle(_outbox(spark, sf_dir).where("status = 'claimed'"), handled, most_attempts=2)
    return after.groupBy("event_type").agg(F.count("*").alias("claimed"), *(F.count_if(F.col("status") == s).alias(n) for n, s in (("dispatched", "dispatched"), ("retried", "pending"), ("dead", "dead"))))


@query("SELECT count(*)::BIGINT AS inserted, min(p_partkey)::BIGINT AS first FROM part WHERE p_partkey % 3 <> 0")
def l11_manifest_registration(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey")
    return ops.insert_missing(p.where("p_partkey % 3 = 0"), p, ["p_partkey"]).agg(F.count("*").alias("inserted"), F.min("p_partkey").alias("first"))


@query("""WITH o AS (SELECT 'a/' || p_partkey AS path, md5(p_name) AS sum FROM part WHERE p_partkey % 3 > 0), n AS (SELECT 'a/' || p_partkey AS path, md5('new' || p_name) AS sum FROM part WHERE p_partkey % 4 = 0)
SELECT coalesce(n.path, o.path) AS path, coalesce(n.sum, o.sum) AS sum FROM o FULL JOIN n ON o.path = n.path""")
def k15_checksum_merge(spark, sf_dir):
    """A keyed merge of checksum lines, so exporting again adds no line twice."""
    p = table(spark, sf_dir, "part")
    path = F.concat(F.lit("a/"), F.col("p_partkey")).alias("path")
    old = p.where("p_partkey % 3 > 0").select(path, F.md5("p_name").alias("sum"))
    new = p.where("p_partkey % 4 = 0").select(path, F.md5(F.concat(F.lit("new"), "p_name")).alias("sum"))
    return ops.merge(old, new, ["path"])


@query("SELECT user_id, hour, n, (n - lag(n) OVER (PARTITION BY user_id ORDER BY hour))::BIGINT AS grown FROM (SELECT user_id, date_trunc('day', ts) AS hour, count(*) AS n FROM events GROUP BY ALL)")
def w6_growth_series(spark, sf_dir):
    per = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("hour")).agg(F.count("*").alias("n"))
    return per.withColumn("grown", F.col("n") - F.lag("n").over(Window.partitionBy("user_id").orderBy("hour")))
