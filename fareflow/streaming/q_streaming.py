"""Streaming operators as queries.

Each query streams the driver's ``events`` file (or changes Spark derives
from the driver's tables) through a Structured Streaming job with an
``availableNow`` trigger into a sink under the shared checkpoint root, and
returns the sink's contents.  Append-mode window results only contain
windows closed by the watermark (S24); the oracles apply the same cut.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.plans.catalog import query
from fareflow.plans.oracle import ratio_sql
from fareflow.plans.q_relational import _SNAP_NEW, _SNAP_OLD, snapshots
from fareflow.session import scratch_path
from fareflow.sources import driver as D
from fareflow.streaming import jobs as S
from fareflow.streaming import trailing as TR


def _events_stream(spark, sf):
    schema = D.table(spark, sf, "events").schema
    return S.event_time(S.file_stream(spark, f"{sf.rstrip('/')}/events.parquet", schema))


def _closed(end_expr: str) -> str:
    return f"{end_expr} <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _sliding_sql(size_min: int, slide_min: int) -> str:
    """Window starts of every sliding window containing ``ts`` (DuckDB)."""
    return (f"unnest(generate_series(time_bucket(INTERVAL {slide_min} MINUTE, ts) - INTERVAL {size_min - slide_min} MINUTE, "
            f"time_bucket(INTERVAL {slide_min} MINUTE, ts), INTERVAL {slide_min} MINUTE))")


def _sliding_sec(size: int, slide: int) -> str:
    """The same for window lengths in seconds."""
    return (f"unnest(generate_series(time_bucket(INTERVAL {slide} SECOND, ts) - INTERVAL {size - slide} SECOND, "
            f"time_bucket(INTERVAL {slide} SECOND, ts), INTERVAL {slide} SECOND))")


@query("str01_tumbling_counts", ids=("STR-01", "STR-02", "STR-03", "SRC-16"),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type FROM events)
GROUP BY 1, 3 HAVING {_closed("window_start + INTERVAL 5 MINUTE")}""")
def str01(spark, sf):
    out = S.tumbling_counts(_events_stream(spark, sf), "ts", "event_type", "5 minutes", "10 minutes")
    return S.run_to_table(out, "str01")


@query("str05_unbounded_count", ids=("STR-05",),
       oracle="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def str05(spark, sf):
    return S.run_to_table(S.count_by_key(_events_stream(spark, sf), "event_type"), "str05", mode="complete")


@query("str06_stateless_clean", ids=("STR-06",),
       oracle="""
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, upper(event_type) AS event_type, round(value, 2) AS value
FROM events WHERE value IS NOT NULL AND value >= 0""")
def str06(spark, sf):
    out = S.stateless_clean(_events_stream(spark, sf)).withColumn("ts", S.to_ntz(F.col("ts")))
    return S.run_to_table(out, "str06")


@query("str08_dedup_within_watermark", ids=("STR-08",),
       oracle="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def str08(spark, sf):
    """Click events are delivered twice (a retrying producer); the repeats
    are dropped."""
    s = _events_stream(spark, sf)
    redelivered = _events_stream(spark, sf).filter(F.col("event_type") == "click")
    deduped = S.dedup_events(s.unionByName(redelivered), ["event_id"], "ts", "10 minutes")
    res = S.run_to_table(deduped, "str08")
    return res.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("str04_foreach_batch_append", ids=("STR-04",),
       oracle="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def str04(spark, sf):
    out, ck = scratch_path(spark, "str04-out"), scratch_path(spark, "str04-ck")
    S.run_foreach_batch(_events_stream(spark, sf), ck, S.idempotent_append(out))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("str12_burst_rule", ids=("STR-12",),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, event_type, count(*) AS attempts
FROM (SELECT {_sliding_sec(60, 30)} AS window_start, event_type FROM events)
GROUP BY 1, 3 HAVING count(*) >= 3 AND {_closed("window_start + INTERVAL 1 MINUTE")}""")
def str12(spark, sf):
    """Three attempts within one minute (windows slide by half a minute); the
    event log has few repeats per user, so the rule runs per event type."""
    out = S.burst_rule(_events_stream(spark, sf), "ts", "event_type", "1 minute", "30 seconds", 3)
    return S.run_to_table(out, "str12")


@query("str13_moving_average_alert", ids=("STR-13", "WIN-06"),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type,
       round(avg(value), 6) AS avg_value, count(*) AS n
FROM (SELECT {_sliding_sql(5, 1)} AS window_start, event_type, value FROM events)
GROUP BY 1, 3 HAVING avg(value) > 20 AND {_closed("window_start + INTERVAL 5 MINUTE")}""")
def str13(spark, sf):
    out = S.moving_average_alert(_events_stream(spark, sf), "ts", "event_type", "value",
                                 "5 minutes", "1 minute", 20.0)
    return S.run_to_table(out, "str13").withColumn("avg_value", F.round("avg_value", 6))


@query("str14_recent_categories", ids=("STR-14",),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, user_id,
       list(DISTINCT event_type ORDER BY event_type) AS categories
FROM (SELECT {_sliding_sql(30, 10)} AS window_start, user_id, event_type FROM events)
GROUP BY 1, 3 HAVING {_closed("window_start + INTERVAL 30 MINUTE")}""")
def str14(spark, sf):
    out = S.recent_categories(_events_stream(spark, sf), "ts", "user_id", "event_type",
                              "30 minutes", "10 minutes")
    return S.run_to_table(out, "str14")


@query("str13_trailing_average", ids=("STR-13", "WIN-06"),
       oracle=f"""
SELECT * FROM (
  SELECT event_type, event_id, ts, round(avg(value) OVER w, 6) AS avg_value, count(value) OVER w AS n
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts
                           RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW))
WHERE {_closed("ts")}""")
def str13_per_event(spark, sf):
    """Average of the event type's last five minutes at every event, from keyed state."""
    out = TR.trailing_average(_events_stream(spark, sf), "ts", "event_type", "event_id", "value")
    with TR.rocksdb_state(spark):
        res = S.run_to_table(out, "str13-events")
    return res.withColumns({"ts": S.to_ntz(F.col("ts")), "avg_value": F.round("avg_value", 6)})


@query("str14_trailing_categories", ids=("STR-14",),
       oracle=f"""
SELECT * FROM (
  SELECT user_id, event_id, ts, list_sort(list_distinct(list(event_type) OVER (
    PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW))) AS categories
  FROM events)
WHERE {_closed("ts")}""")
def str14_per_event(spark, sf):
    """Event types of the user's last thirty minutes at every event."""
    out = TR.trailing_categories(_events_stream(spark, sf), "ts", "user_id", "event_id", "event_type")
    with TR.rocksdb_state(spark):
        res = S.run_to_table(out, "str14-events")
    return res.withColumn("ts", S.to_ntz(F.col("ts")))


@query("str15_log_metrics", ids=("STR-15", "AGG-23", "AGG-24"),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n,
       count(*) FILTER (WHERE event_type = 'error') AS errors, max(value) AS max_latency,
       count(*) FILTER (WHERE event_type = 'error') * 5 > count(*) AS spike, TRUE AS p99_in_range
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, value FROM events)
GROUP BY 1 HAVING {_closed("window_start + INTERVAL 5 MINUTE")}""")
def str15(spark, sf):
    """Errors, spike flag and p99 latency per 5-minute window of the event log
    read as a service log.  The p99 is approximate in the stream, so only its
    range is returned for comparison."""
    out = S.log_metrics(_events_stream(spark, sf), "ts", F.col("event_type") == "error", "value")
    res = S.run_to_table(out, "str15")
    inside = F.col("p99_latency") <= F.col("max_latency")
    return res.select("window_start", "window_end", "n", "errors", "max_latency", "spike",
                      inside.alias("p99_in_range"))


@query("str15_log_error_rate", ids=("STR-15", "AGG-24"),
       oracle=f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n,
       {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", "count(*)")} AS error_rate,
       max(value) AS max_latency
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, value FROM events)
GROUP BY 1 HAVING {_closed("window_start + INTERVAL 5 MINUTE")}""")
def str15b(spark, sf):
    out = S.log_metrics(_events_stream(spark, sf), "ts", F.col("event_type") == "error", "value")
    res = S.run_to_table(out, "str15b")
    return res.select("window_start", "window_end", "n", "error_rate", "max_latency")


@query("str07_ingest_lag", ids=("STR-07",),
       oracle="SELECT event_id, ts, TRUE AS arrived_later FROM events")
def str07(spark, sf):
    """Processing-time lag per event; the lag itself depends on the clock."""
    out = S.with_ingest_lag(_events_stream(spark, sf)).withColumn("ts", S.to_ntz(F.col("ts")))
    res = S.run_to_table(out.select("event_id", "ts", "lag_seconds"), "str07")
    return res.select("event_id", "ts", (F.col("lag_seconds") > 0).alias("arrived_later"))


@query("jon21_stream_static_enrich", ids=("JON-21",),
       oracle="""
SELECT e.event_id, e.event_type, c.c_mktsegment FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def jon21(spark, sf):
    cust = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    out = S.enrich(_events_stream(spark, sf), cust, "user_id")
    return S.run_to_table(out.select("event_id", "event_type", "c_mktsegment"), "jon21")


CUTOFF = "2024-01-20 00:00:00"


@query("str18_new_place_alerts", ids=("STR-18",),
       oracle=f"""
SELECT e.event_id, e.user_id, json_extract_string(e.props, '$.k') AS place FROM events e
WHERE e.ts >= TIMESTAMP '{CUTOFF}' AND NOT EXISTS (
  SELECT 1 FROM events h WHERE h.ts < TIMESTAMP '{CUTOFF}' AND h.user_id = e.user_id
    AND json_extract_string(h.props, '$.k') = json_extract_string(e.props, '$.k'))""")
def str18(spark, sf):
    ev = D.table(spark, sf, "events").withColumn("place", F.get_json_object("props", "$.k"))
    history = ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    profile = S.usual_places(history, "user_id", "place")
    s = (_events_stream(spark, sf).withColumn("place", F.get_json_object("props", "$.k"))
         .filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp")))
    out = S.new_place_alerts(s, profile, "user_id", "place").select("event_id", "user_id", "place")
    return S.run_to_table(out, "str18")


@query("str18_learning_profile", ids=("STR-18",),
       oracle=f"""
SELECT event_id, user_id, place, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, place ORDER BY ts, event_id) AS nth
  FROM (SELECT event_id, user_id, json_extract_string(props, '$.k') AS place, ts FROM events)
  WHERE ts >= TIMESTAMP '{CUTOFF}' AND place IS NOT NULL) e
WHERE nth = 1 AND NOT EXISTS (
  SELECT 1 FROM events h WHERE h.ts < TIMESTAMP '{CUTOFF}' AND h.user_id = e.user_id
    AND json_extract_string(h.props, '$.k') = e.place)""")
def str18_learning(spark, sf):
    """As above, but a place is usual from its first alert on."""
    ev = D.table(spark, sf, "events").withColumn("place", F.get_json_object("props", "$.k"))
    history = ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    s = (_events_stream(spark, sf).withColumn("place", F.get_json_object("props", "$.k"))
         .filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp")))
    out = TR.learning_place_alerts(s, history, "ts", "user_id", "place", "event_id")
    with TR.rocksdb_state(spark):
        res = S.run_to_table(out, "str18-learning")
    return res.withColumn("ts", S.to_ntz(F.col("ts")))


@query("str17_lambda_view", ids=("STR-17",),
       oracle="SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def str17(spark, sf):
    ev = D.table(spark, sf, "events")
    batch_view = (ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
                    .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
    # The stream filters and aggregates; only per-type sums reach its sink.
    recent = _events_stream(spark, sf).filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp"))
    speed = S.run_to_table(recent.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), "str17", mode="complete")
    merged = S.lambda_view(batch_view, speed, "event_type")
    return merged.select("event_type", "n", F.round("total", 2).alias("total"))


@query("str16_cqrs_read_models", ids=("STR-16", "LAY-11"),
       oracle="""
SELECT 'by_type' AS model, event_type AS k, count(*) AS n FROM events GROUP BY 2
UNION ALL SELECT 'by_day', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM events GROUP BY 2""")
def str16(spark, sf):
    root, ck = scratch_path(spark, "str16-out"), scratch_path(spark, "str16-ck")
    models = {
        "by_type": lambda b: b.groupBy(F.col("event_type").alias("k")).agg(
            F.count(F.lit(1)).alias("n")),
        "by_day": lambda b: b.groupBy(F.to_date(S.to_ntz(F.col("ts"))).cast("string").alias("k")).agg(
            F.count(F.lit(1)).alias("n")),
    }
    S.run_foreach_batch(_events_stream(spark, sf), ck, S.multi_sink(models, root))
    parts = [S.read_model(spark, root, m, ["k"], ["n"]).select(F.lit(m).alias("model"), "k", "n")
             for m in models]
    return parts[0].unionByName(parts[1])


def cdc_changes(spark, sf):
    """Change envelopes turning the old customer snapshot into the new one:
    ``c`` for new keys, ``u`` for changed rows, ``d`` for removed keys;
    ``seq`` orders them (a change per key, plus a no-op update first for
    every changed key to exercise ordering inside one batch)."""
    old, new = snapshots(spark, sf)
    o = old.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("o_name"),
                   F.col("c_acctbal").alias("o_bal"))
    n = new.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("n_name"),
                   F.col("c_acctbal").alias("n_bal"))
    j = o.join(n, "id", "full")
    before = F.when(F.col("o_name").isNotNull() | F.col("o_bal").isNotNull(),
                    F.struct(F.col("id"), F.col("o_name").alias("name"), F.col("o_bal").alias("balance")))
    after = F.when(F.col("n_name").isNotNull() | F.col("n_bal").isNotNull(),
                   F.struct(F.col("id"), F.col("n_name").alias("name"), F.col("n_bal").alias("balance")))
    op = (F.when(F.col("o_name").isNull() & F.col("o_bal").isNull(), F.lit("c"))
           .when(F.col("n_name").isNull() & F.col("n_bal").isNull(), F.lit("d"))
           .when(~F.col("o_bal").eqNullSafe(F.col("n_bal")) | ~F.col("o_name").eqNullSafe(F.col("n_name")),
                 F.lit("u")))
    changes = j.select(op.alias("op"), before.alias("before"), after.alias("after"),
                       (F.col("id") * 2 + 1).alias("seq")).filter(F.col("op").isNotNull())
    noop = changes.filter(F.col("op") == "u").select(
        F.lit("u").alias("op"), F.col("before"), F.col("before").alias("after"),
        (F.col("seq") - 1).alias("seq"))
    return changes.unionByName(noop)


@query("str09_cdc_apply", ids=("STR-09", "STR-11"),
       oracle=f"SELECT c_custkey AS id, c_mktsegment AS name, c_acctbal AS balance FROM ({_SNAP_NEW})")
def str09(spark, sf):
    old, _ = snapshots(spark, sf)
    table = scratch_path(spark, "str09-table")
    S.init_cdc_table(old.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"),
                                F.col("c_acctbal").alias("balance")), table)
    # Two landings, the newer changes first: the older ones arrive late and
    # must not win.  One file per micro-batch; a compaction follows.
    landing, ck = scratch_path(spark, "str09-changes"), scratch_path(spark, "str09-ck")
    changes = cdc_changes(spark, sf)
    for part in (changes.filter(F.col("seq") % 2 == 1), changes.filter(F.col("seq") % 2 == 0)):
        part.write.mode("append").parquet(landing)
        stream = S.file_stream(spark, landing, S.CDC_SCHEMA, max_files_per_trigger=1)
        S.run_foreach_batch(stream, ck, S.cdc_writer(table))
    S.compact_cdc(spark, table)
    return S.read_cdc(spark, table)


@query("str10_cdc_audit_history", ids=("STR-10",),
       oracle=f"""
WITH o AS ({_SNAP_OLD}), n AS ({_SNAP_NEW})
SELECT CASE WHEN o.c_custkey IS NULL THEN 'c' WHEN n.c_custkey IS NULL THEN 'd' ELSE 'u' END AS op,
       COALESCE(n.c_custkey, o.c_custkey) AS id, o.c_mktsegment AS before_name, n.c_mktsegment AS after_name
FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal <> n.c_acctbal OR o.c_mktsegment <> n.c_mktsegment
UNION ALL
SELECT 'u', o.c_custkey, o.c_mktsegment, o.c_mktsegment FROM o JOIN n ON o.c_custkey = n.c_custkey
WHERE o.c_acctbal <> n.c_acctbal OR o.c_mktsegment <> n.c_mktsegment""")
def str10(spark, sf):
    landing = scratch_path(spark, "str10-changes")
    cdc_changes(spark, sf).write.parquet(landing)
    stream = S.file_stream(spark, landing, S.CDC_SCHEMA)
    res = S.run_to_table(S.audit_history(stream), "str10")
    return res.drop("seq")
