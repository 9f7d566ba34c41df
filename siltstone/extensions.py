"""Where others add parts: cleaners by kind of record, sinks by format, handlers by operation, and functions in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from siltstone.functions import text
from siltstone.operators import dedup, records, scholarly
from siltstone.sources import writers


class Registry(dict):
    """Named parts; ``add`` as a decorator or with a value. A name is given once."""

    def add(self, name: str, part: Callable | None = None) -> Callable:
        def put(f: Callable) -> Callable:
            if name in self:
                raise ValueError(f"{name} is taken")
            self[name] = f
            return f

        return put if part is None else put(part)

    def named(self, name: str) -> Callable:
        if name not in self:
            raise ValueError(f"{name} is none of {', '.join(sorted(self))}")
        return self[name]


#: Raw records to rows of a fixed schema.
CLEANERS = Registry(
    api_work=scholarly.api_works,
    paper=scholarly.papers,
    preprint=scholarly.preprints,
    medical_article=scholarly.medical_articles,
    oa_article=scholarly.oa_articles,
    portal_article=scholarly.portal_articles,
    repository_record=scholarly.repository_records,
    book=records.books,
)


def _parquet(df: DataFrame, path: str, compression: str = "zstd", max_rows_per_file: int | None = None, **_) -> None:
    out = df.write.mode("overwrite").option("compression", compression)
    (out.option("maxRecordsPerFile", max_rows_per_file) if max_rows_per_file else out).parquet(path)


#: Writers of a table to a path; further settings of an output are passed as names.
SINKS = Registry(
    parquet=_parquet,
    jsonl=lambda df, path, **_: writers.write_json_lines(df, path),
    csv=lambda df, path, **_: writers.write_csv(df, path),
)

#: What is done with a task, by its operation.
HANDLERS = Registry()


def after_shards(manifest: DataFrame, *callbacks: Callable[[dict], None]) -> int:
    """Call back for each written shard in order; a manifest has one row for each file, and they come one at a time."""
    n = 0
    for row in manifest.orderBy("part", "place").toLocalIterator():
        for f in callbacks:
            f(row.asDict())
        n += 1
    return n


def handle(tasks: Iterable[dict]) -> list[dict]:
    """Each task with the outcome of its operation's handler, or of ``*``; an error is an outcome too."""
    out = []
    for task in tasks:
        handler = HANDLERS.get(task["operation"]) or HANDLERS.get("*")
        try:
            out.append(task | {"outcome": "no handler" if handler is None else "ok", "result": None if handler is None else handler(task)})
        except Exception as e:  # noqa: BLE001
            out.append(task | {"outcome": "error", "result": str(e)})
    return out


def register_functions(spark: SparkSession) -> list[str]:
    """Offer functions that SQL has not: ``siltstone_simhash64``, ``siltstone_nfkc``, ``siltstone_unescape``."""
    functions = {"siltstone_simhash64": dedup.simhash64, "siltstone_nfkc": text._nfkc, "siltstone_unescape": text.unescaped}
    for name, f in functions.items():
        spark.udf.register(name, f)
    return list(functions)
