"""What Spark brings above the log source, verified on the test tables: joins, windows, sets, aggregates, functions, streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.sources.shared import shared_folder
from siltstone.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("g_join_inner", "SELECT c_mktsegment AS segment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def join_inner(spark, d):
    j = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("g_join_left", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def join_left(spark, d):
    j = read(spark, d, "customer").join(read(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@register("g_join_full", "SELECT a.k AS a, b.k AS b FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey < 15) a FULL JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_nationkey > 5) b ON a.k = b.k")
def join_full(spark, d):
    a = read(spark, d, "customer").where("c_nationkey < 15").select(F.col("c_nationkey").alias("a")).distinct()
    b = read(spark, d, "supplier").where("s_nationkey > 5").select(F.col("s_nationkey").alias("b")).distinct()
    return a.join(b, F.col("a") == F.col("b"), "full")


@register("g_join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_semi(spark, d):
    o = read(spark, d, "orders").where("o_totalprice > 200000")
    return read(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@register("g_join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@register("g_join_range", "SELECT b.lo, count(*) AS n FROM part JOIN (SELECT range AS lo, range + 10 AS hi FROM range(0, 50, 10)) b ON p_size >= lo AND p_size < hi GROUP BY 1")
def join_range(spark, d):
    """A range join as an equi-join on the bucket that a value falls into."""
    buckets = spark.range(0, 50, 10).select(F.col("id").alias("lo"), (F.col("id") + 10).alias("hi"))
    p = read(spark, d, "part").select("p_size", (F.floor(F.col("p_size") / 10) * 10).alias("bucket"))
    j = p.join(F.broadcast(buckets), (F.col("bucket") == F.col("lo")) & (F.col("p_size") >= F.col("lo")) & (F.col("p_size") < F.col("hi")))
    return j.groupBy("lo").agg(F.count("*").alias("n"))


@register("g_join_asof", "SELECT c.event_id, v.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND c.ts >= v.ts")
def join_asof(spark, d):
    """The last view before each click of a user: both sides in one ordered window, with no pairs."""
    e = read(spark, d, "events").where(F.col("event_type").isin("click", "view"))
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == "view", 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, 0)
    seen = e.withColumn("last_view", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w))
    return seen.where("event_type = 'click'").select("event_id", "last_view")


@register("g_window_rank", "SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS dr, lag(o_totalprice) OVER w2 AS before FROM orders WINDOW w AS (PARTITION BY o_orderpriority, o_orderstatus ORDER BY CAST(floor(o_totalprice) AS BIGINT) DESC), w2 AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def window_rank(spark, d):
    w = Window.partitionBy("o_orderpriority", "o_orderstatus").orderBy(F.desc("p"))
    w2 = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = read(spark, d, "orders").withColumn("p", F.floor("o_totalprice"))
    return o.select("o_orderkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"), F.lag("o_totalprice").over(w2).alias("before"))


@register("g_window_frame", "SELECT event_id, sum(user_id) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS s FROM events")
def window_frame(spark, d):
    w = Window.partitionBy("event_type", F.to_date("ts")).orderBy("ts", "event_id").rowsBetween(-2, 0)
    return read(spark, d, "events").select("event_id", F.sum("user_id").over(w).alias("s"))


@register("g_rollup", "SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup(spark, d):
    return read(spark, d, "lineitem").rollup(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(F.count("*").alias("n"))


@register("g_cube", "SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube(spark, d):
    return read(spark, d, "lineitem").cube(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(F.count("*").alias("n"))


@register("g_grouping_sets", "SELECT o_orderstatus AS s, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def grouping_sets(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    return o.groupingSets([["s"], ["p"], []], "s", "p").agg(F.count("*").alias("n"))


@register("g_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def count_distinct(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@register("g_percentile", "SELECT l_returnflag AS f, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY 1")
def percentile(spark, d):
    return read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("f")).agg(F.percentile("l_quantity", 0.5).alias("median"))


@register("g_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(spark, d):
    return read(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@register("g_union", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union(spark, d):
    return read(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(read(spark, d, "supplier").select("s_nationkey")).distinct()


@register("g_intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect(spark, d):
    return read(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(read(spark, d, "supplier").select("s_nationkey"))


@register("g_except", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def except_(spark, d):
    return read(spark, d, "nation").select(F.col("n_nationkey").alias("k")).subtract(read(spark, d, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@register("g_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@register("g_offset", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20")
def offset(spark, d):
    return read(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey").offset(20).limit(10)


@register("g_pivot", "SELECT l_returnflag AS f, CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS BIGINT) AS sf, CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS BIGINT) AS so FROM lineitem GROUP BY 1")
def pivot(spark, d):
    p = read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))
    return p.select(F.col("flag").alias("f"), p["F"].cast("long").alias("sf"), p["O"].cast("long").alias("so"))


@register("g_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@register("g_array", "SELECT vec_id, round(list_sum(embedding), 3) + 0.0 AS total, len(embedding) AS n FROM embeddings")
def array(spark, d):
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return read(spark, d, "embeddings").select("vec_id", (F.round(total, 3) + 0.0).alias("total"), F.size("embedding").cast("long").alias("n"))


@register("g_date", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, strftime(o_orderdate, '%Y-%m-%d') AS day, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS age FROM orders")
def date(spark, d):
    t = F.col("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", F.year(t).cast("long").alias("y"), F.month(t).cast("long").alias("m"), F.date_format(t, "yyyy-MM-dd").alias("day"), F.datediff(F.to_date(t), F.lit("1992-01-01").cast("date")).cast("long").alias("age"))


@register("g_string", "SELECT p_partkey, upper(p_name) AS up, reverse(p_brand) AS rev, length(p_name) AS n, replace(p_type, ' ', '_') AS t, substr(p_name, 1, 3) AS head FROM part")
def string(spark, d):
    return read(spark, d, "part").select("p_partkey", F.upper("p_name").alias("up"), F.reverse("p_brand").alias("rev"), F.length("p_name").alias("n"), F.replace("p_type", F.lit(" "), F.lit("_")).alias("t"), F.substring("p_name", 1, 3).alias("head"))


@register("g_math", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 4) AS charge, CAST(floor(l_quantity / 7) AS BIGINT) AS q FROM lineitem")
def math(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 4).alias("charge"), F.floor(F.col("l_quantity") / 7).alias("q"))


@register("g_map", "SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1")
def map_(spark, d):
    m = read(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    m = m.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m"))  # three states at most
    return m.select("o_custkey", F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n"), F.coalesce(F.col("m")["F"], F.lit(0)).alias("f"))


# streams: each runs over the events as files, to the end of what is there, and its result is read back


@register("s_tumbling", "SELECT CAST(floor(epoch(time_bucket(INTERVAL 1 DAY, ts))) AS BIGINT) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling(spark, d):
    return windows.run(spark, windows.tumbling(windows.events(spark, d), "1 day"), shared_folder(spark), "update", ("start", "event_type"))


@register("s_sliding", "WITH s AS (SELECT event_type, unnest([epoch(time_bucket(INTERVAL 12 HOUR, ts)), epoch(time_bucket(INTERVAL 12 HOUR, ts)) - 43200]) AS a FROM events) SELECT CAST(floor(a) AS BIGINT) AS start, event_type, count(*) AS n FROM s GROUP BY 1, 2")
def sliding(spark, d):
    return windows.run(spark, windows.sliding(windows.events(spark, d), "1 day", "12 hours"), shared_folder(spark), "update", ("start", "event_type"))


@register("s_session", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), n AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM n GROUP BY user_id, k")
def session(spark, d):
    return windows.run(spark, windows.sessions(windows.events(spark, d), "6 hours"), shared_folder(spark), "complete")


@register("s_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def dedup(spark, d):
    return windows.run(spark, windows.events(spark, d).select("user_id", "event_type").dropDuplicates(), shared_folder(spark))
