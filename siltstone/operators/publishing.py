"""From written shards to a published snapshot: the verification gate, run states, vault states, and the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.tables import positional_split

#: A run's states in order; the last two end it.
RUN_STATES = ("INITIALIZING", "CLEANING", "PACKING", "VERIFYING", "COMPLETED", "FAILED")
TERMINAL = RUN_STATES[-2:]


def rows_in_files(spark, paths: list[str] | str) -> DataFrame:
    """(file, found) of Parquet files: their rows, counted without reading a column."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).groupBy(name.alias("file")).agg(F.count("*").alias("found"))


def verification_audit(shards: DataFrame, found: DataFrame, replicas: DataFrame, columns: list[str], wanted: list[str], purge: bool = True) -> DataFrame:
    """One row for each of ``shards(shard_id, file, records, bytes, sha256, expected)``: its three checks, and whether all passed.

    ``found(file, found)`` has the files' own counts, ``replicas(file, bytes, sha256)`` what storage holds, ``columns`` those
    that the files have and ``wanted`` those that they must. Raw data may only be purged where all checks passed.
    """
    missing = sorted(set(wanted) - set(columns))
    r = replicas.select(F.col("file").alias("rf"), F.col("bytes").alias("rb"), F.col("sha256").alias("rs"))
    f = found.select(F.col("file").alias("ff"), "found")
    joined = shards.join(f, F.col("file") == F.col("ff"), "left").join(r, F.col("file") == F.col("rf"), "left")
    counts = F.coalesce((F.col("found") == F.col("records")) & (F.col("records") == F.col("expected")), F.lit(False))
    readable = F.col("found").isNotNull() & F.lit(not missing)
    same = F.coalesce((F.col("rs") == F.col("sha256")) & (F.col("rb") == F.col("bytes")), F.lit(False))
    notes = F.concat_ws(
        "; ",
        F.when(~readable, F.lit(f"columns missing: {', '.join(missing)}" if missing else "file not readable")),
        F.when(~counts, F.format_string("records: expected %d, shard %d, file %d", F.col("expected"), F.col("records"), F.coalesce("found", F.lit(0)))),
        F.when(~same, F.lit("replica differs")),
    )
    passed = counts & readable & same
    return joined.select(
        F.concat(F.lit("audit-"), F.col("shard_id").cast("string")).alias("audit_id"),
        "shard_id",
        counts.alias("record_count_matches"),
        readable.alias("parquet_readable"),
        same.alias("checksum_matches"),
        passed.alias("verification_passed"),
        (passed & F.lit(purge)).alias("raw_may_go"),
        notes.alias("notes"),
    )


def require_verified(audit: DataFrame) -> DataFrame:
    """The audit, or an error that names a few of the shards that did not pass."""
    bad = audit.where(~F.col("verification_passed")).select("shard_id", "notes").limit(5).collect()
    if bad:
        raise RuntimeError("; ".join(f"{r.shard_id}: {r.notes}" for r in bad))
    return audit


def run_states(events: DataFrame) -> DataFrame:
    """(run_id, status, completed_at, error_message, steps_back) from ``events(run_id, status, error_message, at)``.

    The last event names the state and error; the last terminal one the time of completion, which later events keep.
    ``steps_back`` counts events whose state stands before the one reached until then.
    """
    rank = F.array_position(F.array(*map(F.lit, RUN_STATES)), F.col("status"))
    per = events.where(rank > 0).groupBy("run_id").agg(
        F.max_by(F.struct("status", "error_message"), F.struct("at", rank)).alias("last"),
        F.max(F.when(F.col("status").isin(*TERMINAL), F.col("at"))).alias("completed_at"),
        F.array_sort(F.collect_list(F.struct("at", rank.alias("rank")))).alias("steps"),
    )
    back = F.size(F.filter("steps", lambda s, k: (k > 0) & (s["rank"] < F.get(F.col("steps"), k - 1)["rank"])))
    return per.select("run_id", "last.status", "completed_at", "last.error_message", back.alias("steps_back"))


def vault_state(verdicts: DataFrame) -> DataFrame:
    """One row (state, verified, corrupted, missing): corrupted before incomplete before healthy; an empty list is incomplete."""
    n = {v: F.count_if(F.col("verdict") == v) for v in ("verified", "corrupted", "missing")}
    counts = verdicts.agg(*(c.alias(v) for v, c in n.items()))
    state = F.when(F.col("corrupted") > 0, "corrupted").when((F.col("missing") > 0) | (F.col("verified") == 0), "incomplete").otherwise("healthy")
    return counts.select(state.alias("state"), *n)


def estimated_tokens(records: Column, size: Column) -> Column:
    return F.greatest(records * 100, F.round(size / 4).cast("long"))


def snapshot_manifest(shards: DataFrame, name: str, day: str, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """One row: totals, splits with their shards and checksums, and the manifest as JSON, of ``shards(shard_index, file, records, bytes, sha256)``.

    The version is the day with dots and a one. Shards are one row for each file; their list is the manifest.
    """
    version = f"{day.replace('-', '.')}.1"
    placed = positional_split(shards, "shard_index", train, validation)
    entry = F.struct("shard_index", "file", "records", "bytes", "sha256")
    splits = placed.groupBy("split").agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(entry)).alias("shards"))
    whole = splits.agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.sum(F.size("shards")).alias("shards"), F.array_sort(F.collect_list(F.struct("split", "records", "bytes", "shards"))).alias("splits"))
    whole = whole.withColumns({"name": F.lit(name), "version": F.lit(version), "tokens": estimated_tokens(F.col("records"), F.col("bytes"))})
    return whole.withColumn("manifest", F.to_json(F.struct("name", "version", "records", "bytes", "tokens", "splits")))


def _holding(available: Column, wanted: str) -> Column:
    return F.get(F.filter(available, lambda x: F.contains(x, F.lit(wanted))), F.lit(0))


def format_preference(available: Column, wanted: tuple[str, ...]) -> Column:
    """The entry of ``available`` that comes first in ``wanted``: one that is equal, else one that has it as a part; null if none."""
    exact = [F.when(F.array_contains(available, w), F.lit(w)) for w in wanted]
    return F.coalesce(*exact, *(_holding(available, w) for w in wanted))


def source_preference(*places: tuple[str, Column]) -> tuple[Column, Column]:
    """(label, value) of the first place that has a value that is not empty."""
    found = [(label, F.nullif(c, F.lit(""))) for label, c in places]
    return F.coalesce(*(F.when(c.isNotNull(), F.lit(label)) for label, c in found)), F.coalesce(*(c for _, c in found))
