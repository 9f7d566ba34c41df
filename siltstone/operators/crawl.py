"""Crawls over tables of fetched pages: breadth-first search with limits, waits of hosts, search results, fetches in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import web
from siltstone.session import ensure_checkpoints


def breadth_first(seeds: DataFrame, links: DataFrame, depth: int) -> DataFrame:
    """(node, depth) of all nodes within ``depth`` links of ``seeds(node)``; ``links(source, target)`` may repeat."""
    ensure_checkpoints(seeds.sparkSession)
    visited = seeds.distinct().withColumn("depth", F.lit(0))
    frontier = visited.select("node")
    for level in range(1, depth + 1):
        found = links.join(frontier, F.col("source") == F.col("node"), "left_semi").select(F.col("target").alias("found")).distinct()
        frontier = found.join(visited.select("node"), F.col("found") == F.col("node"), "left_anti").select(F.col("found").alias("node")).checkpoint()
        visited = visited.unionByName(frontier.withColumn("depth", F.lit(level)))
    return visited


def crawl(seeds: DataFrame, links: DataFrame, depth: int, most_pages: int | None = None, include: list[str] | None = None, exclude: list[str] | None = None, same_domain: bool = True, robots: dict[str, str] | None = None, agent: str = "*") -> DataFrame:
    """(url, depth) of pages within ``depth`` links of ``seeds(url)`` that a crawler may see; the first ``most_pages`` by depth and URL.

    ``links(source, target)`` is filtered before it is followed: by patterns, by the seeds' hosts, and by ``robots``, the rules
    of each host (hosts are few and named by the caller).
    """
    ok = F.lit(True)
    if include:
        any_of = F.lit(False)
        for p in include:
            any_of = any_of | web.matches_pattern(F.col("target"), p)
        ok = ok & any_of
    for p in exclude or []:
        ok = ok & ~web.matches_pattern(F.col("target"), p)
    kept = links.where(ok)
    if same_domain:
        hosts = seeds.select(F.lower(web.host_of(F.col("url"))).alias("host")).distinct()
        kept = kept.join(hosts, F.lower(web.host_of(F.col("target"))) == F.col("host"), "left_semi")
    for host, rules in (robots or {}).items():
        checked = web.robots_allows(kept, "target", rules, agent)
        kept = checked.where((F.lower(web.host_of(F.col("target"))) != host) | F.col("allowed")).drop("allowed")
    found = breadth_first(seeds.select(F.col("url").alias("node")), kept, depth).withColumnRenamed("node", "url")
    return found.orderBy("depth", "url").limit(most_pages) if most_pages is not None else found


#: Answers that are worth another try.
RETRIED = (408, 425, 429)


def retried(status: Column) -> Column:
    return status.isin(*RETRIED) | (status >= 500)


def host_waits(log: DataFrame, base: float = 1.0, most: float = 60.0) -> DataFrame:
    """``log(host, at, ok, retry_after)`` with the wait before the host's next request.

    Waits double with each failure in a row, up to ``most``; a success sets them back, and what a host asks for wins.
    """
    w = Window.partitionBy("host").orderBy("at")
    run = log.withColumn("__run", F.sum(F.col("ok").cast("int")).over(w))
    failures = F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy("host", "__run").orderBy("at"))
    doubled = F.least(F.lit(most), base * F.pow(F.lit(2.0), failures - 1))
    return run.withColumn("wait", F.when(F.col("ok"), base).otherwise(F.coalesce(F.col("retry_after").cast("double"), doubled))).drop("__run")


_RESULT = r'(?is)<div class="(result[^"]*)">\s*<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>(?:\s*<p>(.*?)</p>)?'


def search_results(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, rank, url, title, snippet) of result pages: advertisements take no rank, redirects are unwrapped."""
    blocks = F.transform(
        F.regexp_extract_all(html, F.lit(_RESULT), F.lit(0)),
        lambda b: F.struct(*(F.regexp_extract(b, _RESULT, k).alias(n) for k, n in enumerate(("kind", "href", "title", "snippet"), 1))),
    )
    organic = F.filter(blocks, lambda b: ~F.contains(b["kind"], F.lit("--ad")) & (b["href"] != ""))
    rows = pages.select(key, F.posexplode(organic).alias("place", "b"))
    wrapped = F.regexp_extract("b.href", r"[?&]uddg=([^&]+)", 1)
    url = F.when(wrapped != "", F.try_url_decode(wrapped)).otherwise(F.col("b.href"))
    plain = lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))
    return rows.select(key, (F.col("place") + 1).alias("rank"), url.alias("url"), plain("b.title").alias("title"), plain("b.snippet").alias("snippet"))


def fetch_in_batches(ids: DataFrame, key: str, order: str, size: int, fetched: DataFrame) -> DataFrame:
    """Second phase of a search: the ``ids(key, order)`` of each search in batches, joined with ``fetched(request, content)``.

    A request is the batch's ids with commas; batches without an answer stay, with null content.
    """
    w = Window.partitionBy(key).orderBy(order)
    numbered = ids.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size))
    batches = numbered.groupBy(key, "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x.cast("string")), ",").alias("asked"))
    return batches.join(fetched, F.col("asked") == F.col("request"), "left").select(key, "batch", "asked", "content")
