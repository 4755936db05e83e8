"""Streaming queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import query, rounded, s6, wk
from epipanel.plans import bindings as b
from epipanel.streaming import counts, monitor, runner


def _events(spark, sf):
    return counts.event_stream(spark, f"{sf}/events.parquet")


WEEKLY = f"select {wk('ts')} as epi_sunday, event_type, count(*) as n from events group by all"


@query("t1_weekly_window", WEEKLY)
def q_t1(spark, sf):
    return runner.complete_table(counts.weekly_counts(_events(spark, sf), "event_type"))


@query(
    "t1_weekly_window_closed",
    f"select * from ({WEEKLY}) where epi_sunday + 7 <= (select max(ts) - interval 24 hours from events)",
)
def q_t1_closed(spark, sf):
    return runner.append_to_table(counts.weekly_counts(_events(spark, sf), "event_type"))


@query(
    "t2_hopping_window",
    """select cast(w as date) as window_day, hour(w) as window_hour, event_type, count(*) as n from
       (select event_type, time_bucket(interval 12 hours, ts) - unnest([interval 0 hours, interval 12 hours]) as w from events) group by all""",
)
def q_t2(spark, sf):
    table = runner.complete_table(counts.hopping_counts(_events(spark, sf), "event_type", "24 hours", "12 hours"))
    return table.select(
        F.to_date("window_start").alias("window_day"), F.hour("window_start").cast("long").alias("window_hour"), "event_type", "n"
    )


@query(
    "t3_session_window_complete",
    """with g as (select *, case when ts - lag(ts) over w < interval 30 minutes then 0 else 1 end as fresh from events window w as (partition by user_id order by ts)),
       s as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as sid from g),
       t as (select user_id, min(ts) as a, max(ts) + interval 30 minutes as z, count(*) as n from s group by user_id, sid)
       select user_id, strftime(a, '%Y-%m-%d %H:%M:%S') as session_start, strftime(z, '%Y-%m-%d %H:%M:%S') as session_end, n from t""",
)
def q_t3_complete(spark, sf):
    """Every session, those still open too."""
    table = runner.complete_table(counts.sessions(_events(spark, sf), "user_id"))
    stamp = "yyyy-MM-dd HH:mm:ss"
    return table.select(
        "user_id", F.date_format("session_start", stamp).alias("session_start"), F.date_format("session_end", stamp).alias("session_end"), "n"
    )


@query(
    "t3_session_window",
    """with g as (select *, case when ts - lag(ts) over w < interval 30 minutes then 0 else 1 end as fresh from events window w as (partition by user_id order by ts)),
       s as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as sid from g),
       t as (select user_id, min(ts) as a, max(ts) + interval 30 minutes as z, count(*) as n from s group by user_id, sid)
       select user_id, strftime(a, '%Y-%m-%d %H:%M:%S') as session_start, strftime(z, '%Y-%m-%d %H:%M:%S') as session_end, n from t
       where z <= (select max(ts) - interval 24 hours from events)""",
)
def q_t3(spark, sf):
    merge_early = {"spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition": "true"}
    with runner.stream_conf(spark, **merge_early):
        table = runner.append_to_table(counts.sessions(_events(spark, sf), "user_id"))
    stamp = "yyyy-MM-dd HH:mm:ss"
    return table.select(
        "user_id", F.date_format("session_start", stamp).alias("session_start"), F.date_format("session_end", stamp).alias("session_end"), "n"
    )


@query("t4_watermark_updates", WEEKLY)
def q_t4(spark, sf):
    return runner.upsert_table(counts.weekly_counts(_events(spark, sf), "event_type"), ["epi_sunday", "event_type"])


@query(
    "t5_stream_table_join",
    f"select {wk('ts')} as epi_sunday, n_name as ra, count(*) as n from events join customer on c_custkey = user_id join nation on n_nationkey = c_nationkey group by all",
)
def q_t5(spark, sf):
    who = b.customer_regions(spark, sf).withColumnRenamed("o_custkey", "user_id")
    placed = counts.enrich(_events(spark, sf), who, "user_id", "event_id")
    return runner.complete_table(counts.weekly_counts(placed, "ra"))


@query(
    "t6_stream_stream_join",
    """select a.user_id, a.event_id as first_id, b.event_id as second_id from events a join events b on a.user_id = b.user_id
       and a.event_type = 'click' and b.event_type = 'purchase' and b.ts >= a.ts and b.ts <= a.ts + interval 1 hour""",
)
def q_t6(spark, sf):
    clicks = _events(spark, sf).filter("event_type = 'click'")
    buys = _events(spark, sf).filter("event_type = 'purchase'")
    return runner.append_to_table(counts.followed_within(clicks, buys, "user_id")).select("user_id", "first_id", "second_id")


@query("t7_idempotent_consumption", "select event_id, event_type, value from events")
def q_t7(spark, sf):
    twice = _events(spark, sf).unionByName(_events(spark, sf))
    return runner.append_to_table(counts.once_only(twice)).select("event_id", "event_type", "value")


#: Local level of log counts (prior 0, 1; variances 0.25 and 0.04) and its alarm, window by window.
MONITOR = """with recursive c as (select * from (select event_type as ra, cast(ts as date) as day, count(*)::double as n from events group by 1, 2)
      where day + interval 1 day <= (select max(ts) - interval 24 hours from events)),
    s as (select ra, day, n, ln(1 + n) as y, row_number() over (partition by ra order by day) as i from c),
    f as (select ra, 0::bigint as i, 0.0::double as m, 1.0::double as c, 0.0::double as a, 0.0::double as q, 1.0::double as bf, 1.0::double as l, false as alarm from s where i = 1
      union all
      select ra, i, a + r / q * (y - a), r - pow(r / q, 2) * q, a, q, bf, case when l * bf < 0.05 or l * bf > 1.5 then 1.0::double else l * bf end, l * bf < 0.05 from (
        select *, (exp(-pow(y - a, 2) / (2 * q)) / sqrt(2 * pi() * q)) / (exp(-pow(y - a, 2) / (4 * q)) / sqrt(4 * pi() * q) + 1e-12::double) as bf from (
          select *, r + 0.25::double as q from (
            select s.ra, s.i, s.y, f.m as a, f.c + 0.04::double as r, f.l from f join s on s.ra = f.ra and s.i = f.i + 1))))
    """
JUDGED = {"forecast": "f.a", "forecast_var": "f.q", "residual": "(s.y - f.a) / sqrt(f.q)", "factor": "f.bf", "cumulative": "f.l"}


@query(
    "t8_outbreak_monitor",
    MONITOR + f"select s.ra as series, s.day, s.n as y, {', '.join(s6(v, k) for k, v in JUDGED.items())}, f.alarm from s join f on f.ra = s.ra and f.i = s.i",
)
def q_t8(spark, sf):
    table, progress = runner.folders(spark)
    runner.append_to_table(monitor.window_counts(_events(spark, sf), "event_type"), table, progress)
    with runner.stream_conf(spark, spark__sql__streaming__stateStore__providerClass=monitor.STORE):
        alarms = runner.append_to_table(monitor.outbreak_monitor(monitor.count_stream(spark, table)))
    return rounded(alarms.withColumn("day", F.to_date(counts.wall_clock("day"))), *JUDGED)
