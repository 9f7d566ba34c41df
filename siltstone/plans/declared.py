"""A declarative pipeline over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import config, extensions
from siltstone.operators import runner
from siltstone.plans.registry import query, table
from siltstone.plans.text import _METRICS, _PASSED

_YAML = """
name: corpus
source: {{format: parquet, path: "{path}", id: doc_id, text: text}}
normalise: {{max_breaks: 2}}
quality: {{action: drop}}
dedup: {{action: drop}}
output: {{format: parquet, path: unused}}
"""


@query(f"WITH {_METRICS}, k AS (SELECT doc_id, x, row_number() OVER (PARTITION BY x ORDER BY doc_id) AS n FROM m WHERE {_PASSED}) SELECT doc_id AS id, sha256(x) AS normalized_sha256 FROM k WHERE n = 1")
def declared_pipeline(spark, sf_dir):
    """Normalise, gate and exact dedup as a YAML document says."""
    p = config.load(_YAML.format(path=f"{sf_dir}/documents.parquet"))
    return runner.plan(spark, p).select(F.col("id"), "normalized_sha256")


@query("SELECT doc_id, 'a & b' AS plain, 'fi' AS folded FROM documents")
def sql_functions(spark, sf_dir):
    """Functions that are offered to SQL."""
    extensions.register_functions(spark)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit("a &amp; b").alias("x"), F.lit("\ufb01").alias("y"))
    return rows.selectExpr("doc_id", "siltstone_unescape(x) AS plain", "siltstone_nfkc(y) AS folded")
