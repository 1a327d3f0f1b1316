"""Queries over the star schema and the event table: joins, windows, groupings, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.session import table
from quire.streaming import events as V

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1, 2")
def line_summary(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2")
def revenue_by_nation(spark, d):
    l, o, c, n, r = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    line = l.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    x = line.join(o.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).join(c.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    x = x.groupBy("c_nationkey").agg(F.sum("v").alias("v"))
    return x.join(n, F.col("n_nationkey") == F.col("c_nationkey")).join(r, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("n_name", "r_name").agg(F.round(F.sum("v"), 2).alias("revenue"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark, d):
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(grouping(source) * 2 + grouping(lang) AS BIGINT) AS level FROM documents GROUP BY ROLLUP (source, lang)")
def rollup_documents(spark, d):
    return table(spark, d, "documents").rollup("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("level"))


@query("SELECT doc_id, source, score, r FROM (SELECT doc_id, source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS r FROM documents WHERE score IS NOT NULL) WHERE r <= 3")
def top_by_source(spark, d):
    w = Window.partitionBy("source").orderBy(F.desc("score"), "doc_id")
    return table(spark, d, "documents").where("score IS NOT NULL").select("doc_id", "source", "score", F.row_number().over(w).alias("r")).where("r <= 3")


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def hourly_events(spark, d):
    return V.tumbling(table(spark, d, "events"), "1 hour")


@query("WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), c AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n, round(sum(value), 2) AS total FROM c GROUP BY user_id, k")
def user_sessions(spark, d):
    return V.sessions(table(spark, d, "events"), "30 minutes")


@query("SELECT event_type, count(*) AS n, CAST(sum(try_cast(regexp_extract(props, '\"k\":\\s*(\\d+)', 1) AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type")
def event_properties(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def streamed_hourly_events(spark, d):
    plan = lambda s: V.tumbling(s.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "2 hours"), "1 hour")
    return V.run_stream(spark, d, plan, "complete").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT CAST(event_id AS BIGINT) AS event_id, event_type || '/' || CAST(user_id AS VARCHAR) AS result FROM events WHERE value IS NOT NULL")
def streamed_batches(spark, d):
    return V.scored_batches(spark, d)


@query("SELECT user_id, count(*) AS n, round(max(value), 2) AS most FROM events GROUP BY user_id")
def streamed_state(spark, d):
    return V.stateful_totals(spark, d)
