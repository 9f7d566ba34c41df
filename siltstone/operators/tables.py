"""Keyed writes as pure table transforms: merges, appends, conditional updates, splits, leases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import ensure_checkpoints


def merge(old: DataFrame, new: DataFrame, keys: list[str], update: list[str] | None = None, coalesce: bool = False) -> DataFrame:
    """Upsert: keys of ``new`` overwrite ``update`` columns (all others by default); with ``coalesce`` nulls of ``new`` keep the old value.

    Of rows of ``new`` with equal keys the last by all columns' order counts, so no key is written twice.
    """
    new = _one_of_a_key(new, keys, F.max)
    rest = [c for c in old.columns if c not in keys]
    update = rest if update is None else update
    o = old.withColumn("__o", F.lit(True)).alias("o")
    n = new.withColumn("__n", F.lit(True)).alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    isnew = F.col("__n").isNotNull()

    def pick(c: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keys:
            return F.coalesce(b, a)
        if c not in update:
            return F.when(F.col("__o").isNotNull(), a).otherwise(b)
        return F.when(isnew, F.coalesce(b, a) if coalesce else b).otherwise(a)

    return both.select(*(pick(c).alias(c) for c in old.columns))


def _one_of_a_key(df: DataFrame, keys: list[str], which: Callable[[Column], Column]) -> DataFrame:
    """One row of each key: the first or last by the order of all other columns. A partial aggregate, so hot keys don't meet in one task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(which(F.struct(*rest)).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose keys ``old`` lacks; the first of equal keys by all columns' order."""
    one = _one_of_a_key(new, keys, F.min)
    return one.join(old.select(*(F.col(k).alias(f"__{k}") for k in keys)), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")


def last_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order.desc())
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark keeps only these before the shuffle (WindowGroupLimit)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def with_places(df: DataFrame, order: list[str], sums: dict[str, Column] | None = None, ranges: int | None = None) -> DataFrame:
    """``df`` with ``place`` (from one) in a global order, and exclusive running sums of columns; and in ``whole`` the number of rows.

    Two levels: rows are put in ranges of the order and numbered within, and only one row for each range meets in one task.
    """
    sums = {"__one": F.lit(1)} | (sums or {})
    ranged = df.repartitionByRange(*([ranges] if ranges else []), *order).withColumn("__part", F.spark_partition_id())
    ranged = ranged.withColumns({f"__v_{k}": v for k, v in sums.items()}).checkpoint()
    inner = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(F.col("__part").alias("__at")).agg(*(F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums))
    bases = parts.select("__at", F.sum("__t___one").over(Window.partitionBy()).alias("whole"), *(F.coalesce(F.sum(f"__t_{k}").over(outer), F.lit(0)).alias(f"__b_{k}") for k in sums))
    within = ranged.withColumns({f"__w_{k}": F.coalesce(F.sum(f"__v_{k}").over(inner), F.lit(0)) for k in sums})
    joined = within.join(bases, F.col("__part") == F.col("__at"))
    running = {k: F.col(f"__w_{k}") + F.col(f"__b_{k}") for k in sums}
    return joined.select(*df.columns, (running["__one"] + 1).alias("place"), "whole", *(running[k].alias(k) for k in sums if k != "__one"))


def positional_split(df: DataFrame, order: str, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """floor(n * ratio) rows to train (one at least) and validation, the rest to test, by place in ``order``."""
    ensure_checkpoints(df.sparkSession)
    first = F.greatest(F.lit(1), F.floor(F.col("whole") * train))
    second = F.floor(F.col("whole") * validation)
    split = F.when(F.col("place") <= first, "train").when(F.col("place") <= first + second, "validation").otherwise("test")
    return with_places(df, [order]).select(*df.columns, split.alias("split"))


def backfill(records: DataFrame, names: DataFrame, by: str, value: str) -> DataFrame:
    """``records`` with ``value`` looked up by a title, case and blanks apart; of names that fold alike the smallest value counts."""

    def folded(c: Column) -> Column:
        return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))

    known = names.groupBy(folded(F.col(by)).alias("__by")).agg(F.min(value).alias(value))
    return records.join(known, folded(F.col(by)) == F.col("__by"), "left").drop("__by")


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    return df.withColumns({k: F.when(condition, v).otherwise(F.col(k)) for k, v in changes.items()})


def cumulative_shards(df: DataFrame, order: list[str], size: str, limit: int) -> DataFrame:
    """Shard numbers by running size: a shard ends with the row that reaches ``limit`` (sizes fall short by one row at most)."""
    ensure_checkpoints(df.sparkSession)
    placed = with_places(df, order, {"__before": F.col(size)})
    return placed.select(*df.columns, F.floor(F.col("__before") / limit).cast("long").alias("shard"))


# --- leases on a job table -------------------------------------------------------------------------------------------


def claim_next(jobs: DataFrame, owner: str, now: int, lease: int) -> DataFrame:
    """The oldest eligible job, with its new owner, attempt, epoch and expiry."""
    eligible = F.col("status").isin("queued", "retry_wait") & (F.col("available_at") <= now) & (F.col("attempt") < F.col("max_attempts"))
    one = jobs.where(eligible).orderBy("available_at", "job_id").limit(1)
    return one.withColumns({"status": F.lit("running"), "owner": F.lit(owner), "attempt": F.col("attempt") + 1, "epoch": F.col("epoch") + 1, "expires_at": F.lit(now + lease).cast("long")})


def fenced(owner: str, epoch: Column, now: int) -> Column:
    """Whether a lease is still held: same owner, same epoch, not expired."""
    return (F.col("status") == "running") & (F.col("owner") == owner) & (F.col("epoch") == epoch) & (F.col("expires_at") > now)


def claim_batch(outbox: DataFrame, order: list[str], key: str, now: int, lease: int, most: int) -> DataFrame:
    """``outbox`` after a claim: of the messages that are pending, or whose claim ran out, the first ``most`` in order."""
    open_ = outbox.where((F.col("status") == "pending") | ((F.col("status") == "claimed") & (F.col("claimed_until") <= now)))
    taken = open_.orderBy(*order).limit(most).select(F.col(key).alias("__taken"))
    joined = outbox.join(taken, F.col(key) == F.col("__taken"), "left")
    claim = F.col("__taken").isNotNull()
    changes = {"status": F.lit("claimed"), "attempts": F.col("attempts") + 1, "claimed_until": F.lit(now + lease).cast("long")}
    return update_where(joined, claim, changes).select(*outbox.columns)


def settle(claimed: DataFrame, outcome: Column, most_attempts: int) -> DataFrame:
    """Claimed messages after their handlers: ``outcome`` is ``ok``, anything else or null (no handler) has failed."""
    status = F.when(F.coalesce(outcome == "ok", F.lit(False)), "dispatched").when(F.col("attempts") >= most_attempts, "dead").otherwise("pending")
    return claimed.withColumn("status", status)


#: Waits between attempts, in seconds.
MOST_WAIT, FIRST_WAIT = 300, 5


def fail(jobs: DataFrame, condition: Column, now: int, quarantine: Column, terminal: Column) -> DataFrame:
    wait = F.least(F.lit(MOST_WAIT), F.pow(F.lit(2), F.col("attempt")) * FIRST_WAIT).cast("long")
    status = F.when(quarantine, "quarantined").when(terminal | (F.col("attempt") >= F.col("max_attempts")), "failed").otherwise("retry_wait")
    return update_where(jobs, condition, {"available_at": F.when(status == "retry_wait", F.lit(now) + wait).otherwise(F.col("available_at")), "status": status})


def reap(jobs: DataFrame, now: int) -> DataFrame:
    expired = (F.col("status") == "running") & (F.col("expires_at") <= now)
    return update_where(jobs, expired, {"status": F.when(F.col("attempt") >= F.col("max_attempts"), "failed").otherwise("retry_wait")})


Transform = Callable[[DataFrame], DataFrame]
