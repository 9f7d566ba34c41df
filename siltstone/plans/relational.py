"""Joins, aggregates, windows, top-n, upserts and splits, over tables that stand in for catalogues and record stores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from siltstone.operators import tables as ops
from siltstone.plans.registry import query, table

# orders play runs or posts, lineitem shards or slides, customer journals, supplier replicas, events a log of calls.


@query("""SELECT o_orderkey, l_linenumber, s_name, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey WHERE o_orderstatus = 'F' AND l_quantity > 45""")
def j1_shards_runs_replicas(spark, sf_dir):
    """Inner join on runs, left join on replicas; filters and columns reach the scans."""
    shards = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    runs = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    replicas = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")
    joined = shards.join(runs, F.col("l_orderkey") == F.col("o_orderkey")).join(replicas, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.select("o_orderkey", "l_linenumber", "s_name", "l_extendedprice")


@query("SELECT o_orderkey, l_linenumber, l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey < 50 ORDER BY l_shipdate, o_orderkey, l_linenumber LIMIT 100")
def j2_slides_posts_top(spark, sf_dir):
    posts = table(spark, sf_dir, "orders").where("o_custkey < 50").select("o_orderkey")
    slides = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return posts.join(slides, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_linenumber", "l_shipdate").orderBy("l_shipdate", "o_orderkey", "l_linenumber").limit(100)


@query("""WITH a AS (SELECT l_orderkey AS q, l_linenumber AS id, round(l_discount * 100)::INT AS score FROM lineitem), q AS (SELECT o_orderkey, o_custkey % 7 AS accepted FROM orders),
r AS (SELECT o_orderkey, id, score, id = accepted AS ok, row_number() OVER (PARTITION BY o_orderkey ORDER BY (id = accepted) DESC, score DESC, id) AS n FROM q JOIN a ON q = o_orderkey WHERE id = accepted OR score >= 1)
SELECT o_orderkey AS question, id AS answer, score, ok AS accepted FROM r WHERE n = 1""")
def j3_best_answer(spark, sf_dir):
    """The accepted answer, else the best one with a score of one or more."""
    answers = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("q"), F.col("l_linenumber").alias("id"), F.round(F.col("l_discount") * 100).cast("int").alias("score"))
    questions = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("wanted"))
    both = questions.join(answers, F.col("q") == F.col("o_orderkey")).withColumn("accepted", F.col("id") == F.col("wanted")).where("accepted OR score >= 1")
    best = ops.top_per_group(both, ["o_orderkey"], [F.desc("accepted"), F.desc("score"), F.col("id")], 1)
    return best.select(F.col("o_orderkey").alias("question"), F.col("id").alias("answer"), "score", "accepted")


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey DESC, l_linenumber) AS n FROM lineitem WHERE l_returnflag = 'R')
SELECT o_orderkey, coalesce(string_agg(l_partkey::VARCHAR, ' | ' ORDER BY n), '') AS comments FROM orders LEFT JOIN r ON o_orderkey = l_orderkey AND n <= 3 GROUP BY o_orderkey""")
def j4_top_comments(spark, sf_dir):
    """Top three comments, joined in order; none gives an empty string."""
    comments = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    top = ops.top_per_group(comments, ["l_orderkey"], [F.desc("l_quantity"), F.desc("l_partkey"), F.col("l_linenumber")], 3)
    lists = top.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("rank", "l_partkey"))).alias("x"))
    joined = table(spark, sf_dir, "orders").select("o_orderkey").join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce(F.array_join(F.transform("x", lambda s: s["l_partkey"].cast("string")), " | "), F.lit("")).alias("comments"))


@query("SELECT o_orderkey // 30 AS batch, count(DISTINCT o_orderkey)::BIGINT AS questions, coalesce(string_agg(l_orderkey || ':' || l_linenumber, ' ' ORDER BY l_orderkey, l_linenumber), '') AS answers FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY batch")
def j5_batched_answers(spark, sf_dir):
    """Answers of thirty questions at a time, as one list; a batch bounds its length."""
    a = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    both = table(spark, sf_dir, "orders").select("o_orderkey").join(a, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    per = both.groupBy(F.floor(F.col("o_orderkey") / 30).alias("batch")).agg(F.count("*").alias("questions"), F.array_sort(F.collect_list(F.struct("l_orderkey", "lines"))).alias("all"))
    flat = F.flatten(F.transform(F.filter("all", lambda x: x["lines"].isNotNull()), lambda x: F.transform(x["lines"], lambda n: F.concat(x["l_orderkey"], F.lit(":"), n))))
    return per.select("batch", "questions", F.array_join(flat, " ").alias("answers"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def j6_exists(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_custkey")
    return table(spark, sf_dir, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j7_not_loaded(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").select("o_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("""WITH w AS (SELECT unnest(['Brand#11', 'Brand#23', 'part 7', 'x']) AS k, unnest(['train', 'validation', 'test', 'train']) AS split)
SELECT p_partkey, split FROM part JOIN w ON k = p_brand OR k = 'part ' || p_partkey""")
def j9_explicit_split_keys(spark, sf_dir):
    """A shard is named by file or by id; the few keys are a local table, so this is a broadcast join on either name."""
    wanted = spark.createDataFrame([("Brand#11", "train"), ("Brand#23", "validation"), ("part 7", "test"), ("x", "train")], "k string, split string")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array("p_brand", F.concat(F.lit("part "), F.col("p_partkey")))).alias("key"))
    return parts.join(F.broadcast(wanted), F.col("k") == F.col("key")).select("p_partkey", "split")


@query("SELECT s_suppkey, CASE WHEN n_nationkey % 3 > 0 THEN 'slug-' || n_nationkey END AS slug FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def j10_slug_backfill(spark, sf_dir):
    """Titles in other spellings find the slug of their journal; those without one stay null."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    slugs = n.where("n_nationkey % 3 > 0").select(F.concat(F.lit("  "), F.initcap("n_name"), F.lit(" ")).alias("title"), F.concat(F.lit("slug-"), "n_nationkey").alias("slug"))
    records = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.regexp_replace(F.upper("n_name"), " ", "   ").alias("title"))
    return ops.backfill(records, slugs, "title", "slug").select("s_suppkey", "slug")


@query("""SELECT o_orderkey, count(l_linenumber)::INT AS slides, coalesce(string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber), '') AS lines, round(coalesce(sum(l_quantity), 0), 2) AS qty FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def j12_nested_record(spark, sf_dir):
    slides = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("x"), F.sum("l_quantity").alias("q"))
    posts = table(spark, sf_dir, "orders").select("o_orderkey")
    both = posts.join(slides, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    lines = F.array_join(F.transform("x", lambda v: v.cast("string")), ",")
    return both.select("o_orderkey", F.when(F.col("x").isNull(), 0).otherwise(F.size("x")).alias("slides"), F.coalesce(lines, F.lit("")).alias("lines"), F.round(F.coalesce("q", F.lit(0.0)), 2).alias("qty"))


@query("""SELECT count(*)::BIGINT AS n, coalesce(round(sum(o_totalprice), 2), 0) AS total, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS done, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS done_total, count(DISTINCT o_custkey)::BIGINT AS customers, count(DISTINCT o_orderpriority)::BIGINT AS priorities FROM orders""")
def a1_a4_totals(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.coalesce(F.round(F.sum("o_totalprice"), 2), F.lit(0.0)).alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)), 2).alias("done_total"), F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities"))


@query("SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders GROUP BY o_orderstatus")
def a2_status_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT coalesce(s, 'pending') AS status, max(n)::BIGINT AS n FROM (SELECT s, count(*) AS n FROM (SELECT CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN 'pending' ELSE o_orderstatus END AS s FROM orders) GROUP BY s) GROUP BY ALL""")
def a3_labelled_after_grouping(spark, sf_dir):
    """Grouped on the raw column and labelled afterwards, so null and 'pending' meet; here the larger count is told."""
    raw = F.when(F.col("o_orderstatus") == "O", None).when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_orderstatus"))
    counts = table(spark, sf_dir, "orders").select(raw.alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    return counts.groupBy(F.coalesce("s", F.lit("pending")).alias("status")).agg(F.max("n").alias("n"))


@query("SELECT coalesce(max(p_partkey) + 1, 0)::BIGINT AS next_part, coalesce((SELECT max(p_partkey) + 1 FROM part WHERE p_name LIKE 'zzz%'), 0)::BIGINT AS next_zzz FROM part")
def a5_next_index(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.agg(F.coalesce(F.max("p_partkey") + 1, F.lit(0)).alias("next_part"), F.coalesce(F.max(F.when(F.col("p_name").like("zzz%"), F.col("p_partkey"))) + 1, F.lit(0)).cast("long").alias("next_zzz"))


@query("""SELECT count(*)::BIGINT AS raw_count, count_if(length(text) >= 100)::BIGINT AS clean_count, count_if(length(text) < 100)::BIGINT AS rejected, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents""")
def a8_run_counters(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("text")
    return d.agg(F.count("*").alias("raw_count"), F.count_if(F.length("text") >= 100).alias("clean_count"), F.count_if(F.length("text") < 100).alias("rejected"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*)::BIGINT AS n FROM {t}" for t in _TABLES))
def a9_table_counts(spark, sf_dir):
    return reduce(lambda a, b: a.unionByName(b), (table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in _TABLES))


@query("SELECT word, count(*)::BIGINT AS calls, count(DISTINCT p_partkey)::BIGINT AS articles FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word FROM part) GROUP BY word")
def a10_keyword_counters(spark, sf_dir):
    """Counts of index calls, and of distinct articles."""
    words = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("calls"), F.count_distinct("p_partkey").alias("articles"))


@query("""WITH h AS (SELECT floor(l_extendedprice / 5000)::BIGINT AS bin, count(*)::BIGINT AS n FROM lineitem GROUP BY bin)
SELECT bin, n, (bin - lag(bin) OVER (ORDER BY bin))::BIGINT AS gap FROM h""")
def a14_histogram_gaps(spark, sf_dir):
    h = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_extendedprice") / 5000).alias("bin")).agg(F.count("*").alias("n"))
    return h.withColumn("gap", F.col("bin") - F.lag("bin").over(Window.orderBy("bin")))


@query("SELECT p_brand, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_size, p_partkey) AS parts FROM part GROUP BY p_brand")
def a17_group_collect(spark, sf_dir):
    lists = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct("p_size", "p_partkey"))).alias("x"))
    return lists.select("p_brand", F.array_join(F.transform("x", lambda s: s["p_partkey"].cast("string")), ",").alias("parts"))


@query("SELECT user_id, count(*)::BIGINT AS calls, count_if(event_type = 'click')::BIGINT AS clicks, round(avg(value), 6) AS mean_value, max(ts) AS last_seen FROM events GROUP BY user_id")
def a19_worker_stats(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.count("*").alias("calls"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.round(F.avg("value"), 6).alias("mean_value"), F.max("ts").alias("last_seen"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS latest, max(ts) AS ts FROM events GROUP BY user_id")
def w4_latest_snapshot(spark, sf_dir):
    """The latest row of each key by max_by: partial aggregates, no sort."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("latest"), F.max("ts").alias("ts"))


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal, (turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS step FROM conversations")
def w5_w6_ordinals_growth(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.row_number().over(w).alias("ordinal"), (F.col("turn") - F.lag("turn").over(w)).alias("step"))


@query("""WITH n AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS r, count(*) OVER () AS n FROM supplier)
SELECT s_suppkey, CASE WHEN r <= greatest(1, floor(n * 0.8)) THEN 'train' WHEN r <= greatest(1, floor(n * 0.8)) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split FROM n""")
def w7_positional_split(spark, sf_dir):
    """Over a catalogue of shards, so one window over all of it is small."""
    return ops.positional_split(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")


@query("""WITH c AS (SELECT p_partkey, p_size, coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM part)
SELECT floor(b / 500)::BIGINT AS shard, count(*)::BIGINT AS parts, sum(p_size)::BIGINT AS size FROM c GROUP BY shard""")
def w8_cumulative_rotation(spark, sf_dir):
    rolled = ops.cumulative_shards(table(spark, sf_dir, "part").select("p_partkey", "p_size"), ["p_partkey"], "p_size", 500)
    return rolled.groupBy("shard").agg(F.count("*").alias("parts"), F.sum("p_size").alias("size"))


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n <= 3")
def w9_preorder_cap(spark, sf_dir):
    """At most three comments of a thread, in pre-order."""
    return ops.top_per_group(table(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id"], [F.col("turn")], 3).drop("rank")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def t1_page(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(20)


@query("SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def t2_top_journals(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@query("""SELECT o_orderkey, array_to_string(list_slice(list_transform(list_sort(list_transform(xs, lambda x: {'s': -x.s, 'p': x.p, 'n': x.n})), lambda x: x.n::VARCHAR), 1, 5), '; ') AS concepts
FROM (SELECT l_orderkey AS o_orderkey, list({'s': l_discount, 'p': l_linenumber, 'n': l_partkey} ORDER BY l_linenumber) AS xs FROM lineitem GROUP BY l_orderkey)""")
def t4_top_concepts(spark, sf_dir):
    """Top five of an array by score, ties by place."""
    xs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((-F.col("l_discount")).alias("s"), F.col("l_linenumber").alias("p"), F.col("l_partkey").alias("n"))).alias("xs"))
    return xs.select(F.col("l_orderkey").alias("o_orderkey"), F.array_join(F.transform(F.slice(F.array_sort("xs"), 1, 5), lambda x: x["n"].cast("string")), "; ").alias("concepts"))


@query("""SELECT p_brand, array_to_string(list_slice(list_distinct_ordered, 1, 3), ';') AS topics FROM (SELECT p_brand, list_transform(list_sort(list_transform(list_distinct(types), lambda t: {'i': list_position(types, t), 't': t})), lambda x: x.t) AS list_distinct_ordered FROM (SELECT p_brand, list(p_type ORDER BY p_partkey) AS types FROM part GROUP BY p_brand))""")
def t6_primary_and_others(spark, sf_dir):
    types = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_type"))), lambda x: x["p_type"]).alias("t"))
    return types.select("p_brand", F.array_join(F.slice(F.array_distinct("t"), 1, 3), ";").alias("topics"))


@query("SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def t7_clamped_limit(spark, sf_dir):
    """A wish for 1,000 rows, clamped to 1 to 25."""
    return table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").select("c_custkey").limit(max(1, min(25, 1000)))


@query("SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS balance FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def u1_union_of_keys(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


def _old_new(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.when(F.col("c_custkey") % 4 == 0, F.lit(1.5)).alias("c_acctbal"), F.lit("NEW").alias("c_mktsegment"))
    return old, new


_OLD_NEW = """WITH o AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey, upper(c_name) AS c_name, CASE WHEN c_custkey % 4 = 0 THEN 1.5::DOUBLE END AS c_acctbal, 'NEW' AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0)"""


@query(_OLD_NEW + """ SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name ELSE o.c_name END AS c_name, CASE WHEN o.c_custkey IS NOT NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
CASE WHEN o.c_custkey IS NOT NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def u2_upsert_subset(spark, sf_dir):
    return ops.merge(*_old_new(spark, sf_dir), ["c_custkey"], update=["c_name"])


@query(_OLD_NEW + """ SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def u3_upsert_coalesce(spark, sf_dir):
    return ops.merge(*_old_new(spark, sf_dir), ["c_custkey"], coalesce=True)


@query(_OLD_NEW + " SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.c_custkey = n.c_custkey)")
def u4_insert_or_ignore(spark, sf_dir):
    return ops.insert_missing(*_old_new(spark, sf_dir), ["c_custkey"])


@query("SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def u5_insert_or_replace(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return ops.last_wins(e, ["user_id", "event_type"], F.struct("ts", "event_id"))


@query("""WITH y AS (SELECT unnest(range(1985, 2021)) AS y), p AS (
SELECT y AS a, least(y + 4, 1999) AS b, 'y' AS h FROM y WHERE y < 2000 AND (y - 1985) % 5 = 0 UNION ALL SELECT y, y + 1, 'y' FROM y WHERE y BETWEEN 2000 AND 2009 AND y % 2 = 0
UNION ALL SELECT y, y, 'y' FROM y WHERE y BETWEEN 2010 AND 2017 UNION ALL SELECT y, y, h FROM y, (SELECT unnest(['H1', 'H2']) AS h) WHERE y >= 2018)
SELECT CASE h WHEN 'H2' THEN a || '-07-01' ELSE a || '-01-01' END AS from_date, CASE h WHEN 'H1' THEN b || '-06-30' ELSE b || '-12-31' END AS until_date, CASE WHEN h <> 'y' THEN a || '-' || h WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END AS label FROM p""")
def u7_date_partitions(spark, sf_dir):
    """Contiguous windows of publication dates, narrower the later they are."""
    years = spark.range(1985, 2021).select(F.col("id").cast("int").alias("y"))
    step = F.when(F.col("y") < 2000, 5).when(F.col("y") < 2010, 2).otherwise(1)
    begin = F.when(F.col("y") < 2000, F.lit(1985)).otherwise(F.lit(2000))
    opens = years.where((F.col("y") - begin) % step == 0).withColumn("z", F.when(F.col("y") < 2000, F.least(F.col("y") + 4, F.lit(1999))).otherwise(F.col("y") + step - 1))
    halves = opens.select("y", "z", F.explode(F.when(F.col("y") >= 2018, F.array(F.lit("H1"), F.lit("H2"))).otherwise(F.array(F.lit("")))).alias("h"))
    label = F.when(F.col("h") != "", F.concat_ws("-", "y", "h")).when(F.col("y") == F.col("z"), F.col("y").cast("string")).otherwise(F.concat_ws("-", "y", "z"))
    return halves.select(F.concat("y", F.when(F.col("h") == "H2", "-07-01").otherwise("-01-01")).alias("from_date"), F.concat("z", F.when(F.col("h") == "H1", "-06-30").otherwise("-12-31")).alias("until_date"), label.alias("label"))


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS chosen FROM events WHERE value > 50 AND user_id < 100 AND props IS NOT NULL AND event_type IN ('click', 'view')")
def p8_p9_dynamic_predicates(spark, sf_dir):
    """Optional filters joined by AND; lists and nulls."""
    wishes = [("user_id < 100", True), ("value > 50", True), ("value > 99", False), ("props IS NOT NULL", True)]
    condition = reduce(lambda a, b: a & b, (F.expr(x) for x, on in wishes if on), F.col("event_type").isin("click", "view"))
    return table(spark, sf_dir, "events").where(condition).select("event_id", F.col("event_type").isin("click", "view").cast("int").alias("chosen"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS \"props.k\" FROM events WHERE event_id % 3 = 0")
def p1_dotted_projection(spark, sf_dir):
    """A dotted key becomes a column whose name has the dot."""
    return table(spark, sf_dir, "events").where("event_id % 3 = 0").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("props.k"))


@query("SELECT c_custkey AS id, c_name AS title, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS subject, CASE WHEN c_mktsegment = 'BUILDING' THEN 'source has none' END AS subject_reason FROM customer")
def p2_field_mapping(spark, sf_dir):
    """Renamed by contract; what is missing is null with a reason."""
    subject = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), subject.alias("subject"), F.when(subject.isNull(), "source has none").alias("subject_reason"))


@query("SELECT c_custkey, contains(n, 'customer') OR contains('customer#000000007x', n) AS matches FROM (SELECT c_custkey, lower(c_name) AS n FROM customer)")
def p6_p7_contains(spark, sf_dir):
    n, q = F.lower("c_name"), F.lit("customer#000000007x")
    return table(spark, sf_dir, "customer").select("c_custkey", (F.contains(n, F.lit("customer")) | F.contains(q, n)).alias("matches"))


@query("SELECT event_id FROM events WHERE minute(ts) % 15 = 0 AND hour(ts) BETWEEN 8 AND 18 AND dayofweek(ts) IN (1, 2, 3, 4, 5)")
def p14_cron(spark, sf_dir):
    from siltstone.functions.web import cron_matches

    return table(spark, sf_dir, "events").where(cron_matches("*/15 8-18 * * 1-5", F.col("ts"))).select("event_id")


@query("SELECT event_id, lower(event_type) IN ('true', '1', 't', 'click') AS truthy FROM events")
def p15_boolean_coercion(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.lower("event_type").isin("true", "1", "t", "click").alias("truthy"))
