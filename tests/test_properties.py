"""Properties over the bound tables and streams."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from epipanel.operators import experiments, filters, learners, perseries, recursion
from epipanel.plans import bindings as b
from epipanel.plans.features import feature_set
from epipanel.session import reliable_checkpoint
from epipanel.streaming import counts, runner

RF = {"n_estimators": 3, "max_depth": 3}


@pytest.fixture(scope="module")
def panel(spark, sf):
    return reliable_checkpoint(b.full_panel(spark, sf))


def test_totals_are_kept(spark, sf, panel):
    rows = b.table(spark, sf, "orders").filter(b.DEFINITION.mask("probable")).count()
    assert panel.agg(F.sum("cases")).first()[0] == rows


def test_lag_k_is_the_row_k_weeks_before(panel):
    late = panel.select("ra", "epi_sunday", "cases_lag_3")
    early = panel.select("ra", F.date_add("epi_sunday", 21).alias("epi_sunday"), "cases")
    assert late.join(early, ["ra", "epi_sunday"]).filter("cases_lag_3 <> cases").count() == 0


def test_same_result_for_any_partitioning(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, b.full_panel(spark, sf).select("ra", "epi_sunday", "cases", "cases_lag_4", "cases_growth_rate").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


@pytest.mark.parametrize("config", ["lag-only", "lag+clima+RA", "lag+clima+RA+incid-target"])
def test_first_recursive_step_is_the_nowcast(panel, config):
    features = feature_set(config)
    fitted = learners.fit(panel.filter(F.year("epi_sunday") < b.TEST_YEAR), features, "RF", RF)
    closed = recursion.recursive_forecast(panel, fitted, features, b.TEST_YEAR)
    first = panel.filter(F.year("epi_sunday") == b.TEST_YEAR).agg(F.min("epi_sunday")).first()[0]
    now = learners.predict(fitted, panel.filter(F.col("epi_sunday") == F.lit(first)), features)
    both = closed.filter(F.col("epi_sunday") == F.lit(first)).join(now.select("ra", F.col("prediction").alias("p")), "ra").collect()
    assert len(both) == now.count() > 0
    assert all(r.prediction == pytest.approx(r.p) for r in both)
    assert closed.count() == panel.filter(F.year("epi_sunday") == b.TEST_YEAR).count()


def test_rolling_validation_bands(panel):
    out = experiments.rolling_validation(panel, b.TEST_YEAR, "lag-only", params=RF)
    assert out["predictions"].filter("lower_ci < 0 or upper_ci < prediction").count() == 0
    rows = {r.modo: r for r in out["metrics"].collect()}
    assert set(rows) == {"nowcasting_rolling", "forecast_fechado_recursivo"}
    assert all(0 <= r.coverage <= 1 and r.wis >= 0 for r in rows.values())


def test_direct_horizon_targets_line_up(panel):
    out = experiments.direct_multihorizon(panel, "lag-only", "RF", 2, b.TEST_YEAR, RF)
    actual = panel.select("ra", F.col("epi_sunday").alias("target_week"), F.col("cases").alias("y"))
    joined = out["predictions"].join(actual, ["ra", "target_week"])
    assert joined.count() == out["predictions"].count() > 0
    assert joined.filter("y <> cases").count() == 0


def test_ablation_tables(panel):
    out = experiments.ablation(panel, b.TEST_YEAR, {"RF": RF}, ["lag-only", "lag+clima"])
    summary = {r.config: r for r in out["summary"].collect()}
    assert summary["lag-only"].delta_r2 is None and not summary["lag-only"].accepted
    assert (summary["lag-only"].n_features, summary["lag+clima"].n_features) == (7, 32)
    assert out["winner"].count() == 1


def series(spark, values):
    days = [dt.date(2020, 1, 5) + dt.timedelta(days=7 * i) for i in range(len(values))]
    return spark.createDataFrame([("s", d, float(v)) for d, v in zip(days, values)], "unique_id string, ds date, y double")


def test_smoothing_forecasts(spark):
    rows = perseries.smoothing_forecasts(series(spark, np.arange(30)), 3).filter("h > 0").orderBy("h").collect()
    assert [r.holt for r in rows] == pytest.approx([30, 31, 32])
    flat = perseries.smoothing_forecasts(series(spark, [4.0] * 20), 2).filter("h > 0").collect()
    assert all(r.ses == pytest.approx(4) and r.theta == pytest.approx(4) for r in flat)


def test_filters_follow_a_level(spark):
    last = filters.trend_season_climate(series(spark, [5.0] * 80).withColumn("x", F.lit(0.0)), "x").orderBy(F.desc("ds")).first()
    assert last.forecast == pytest.approx(5.0, abs=0.2)
    level = filters.local_level(series(spark, [2, 3] * 30 + [40]), m0=2.5)
    assert [r.alarm for r in filters.alarm_monitor(level).orderBy("ds").collect()][-1]


def test_local_level_by_hand(spark):
    values = [1.0, 2.0, None, 4.0]
    rows = filters.local_level(series(spark, [0.0] * 4).withColumn("y", F.get(F.array(*map(F.lit, values)), (F.datediff("ds", F.lit("2020-01-05")) / 7).cast("int"))), 0.5, 1.0, 0.3, 0.1).orderBy("ds").collect()
    m, c, kept = 0.5, 1.0, []
    for y in values:
        a, r = m, c + 0.1
        q = r + 0.3
        m, c = (a, r) if y is None else (a + r / q * (y - a), r - (r / q) ** 2 * q)
        kept.append((a, r, q, m, c))
    sm, sv = kept[-1][3:]
    smooth = [(sm, sv)]
    for (_, _, _, m, c), (a1, r1, *_) in zip(kept[-2::-1], kept[:0:-1]):
        sm, sv = m + c / r1 * (sm - a1), c + (c / r1) ** 2 * (sv - r1)
        smooth.append((sm, sv))
    for row, (a, _, q, m, c), (sm, sv) in zip(rows, kept, reversed(smooth)):
        assert (row.forecast, row.forecast_var, row.level, row.level_var, row.smoothed, row.smoothed_var) == pytest.approx((a, q, m, c, sm, sv))


def test_filters_do_not_look_ahead(spark):
    """A later value changes nothing before it, but for the smoothed moments."""
    one, other = [3.0, 5, 2, 6, 4, 3], [3.0, 5, 2, 6, 4, 90]
    for run in (
        lambda df: filters.local_level(df).drop("smoothed", "smoothed_var"),
        lambda df: filters.trend_season_climate(df.withColumn("x", F.lit(1.0)), "x"),
        filters.poisson_filter,
        lambda df: filters.alarm_monitor(filters.local_level(df)),
    ):
        a, b = (run(series(spark, v)).orderBy("ds").collect() for v in (one, other))
        assert a[:5] == b[:5] and a[5] != b[5]


def test_monitor_restarts_where_it_stopped(spark, tmp_path):
    """Windows in any order, over several starts of the stream: what one pass over all in order gives."""
    from epipanel.streaming import monitor

    day = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(k)
    schema = "series string, day timestamp, y double"
    values = {(s, k): float((7 * k + len(s) * k * k) % 9 + (60 if k == 11 else 0)) for s in ("a", "bb") for k in range(14)}
    batches = [[("a", 0), ("bb", 1), ("a", 2), ("a", 1), ("bb", 0)], [(s, k) for s in ("bb", "a") for k in (4, 3, 2) if (s, k) != ("a", 2)], [(s, k) for s in ("a", "bb") for k in range(13, 4, -1)]]

    def run(name, groups):
        for n, group in enumerate(groups):
            spark.createDataFrame([(s, day(k), values[s, k]) for s, k in group], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/in")
            with runner.stream_conf(spark, spark__sql__streaming__stateStore__providerClass=monitor.STORE):
                out = runner.append_to_table(monitor.outbreak_monitor(monitor.count_stream(spark, f"{tmp_path}/{name}/in"), late="2 days"), f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/progress")
        return out.orderBy("series", "day").collect()

    parts, whole = run("parts", batches), run("whole", [sum(batches, [])])
    assert parts == whole and len(whole) >= 22 and any(r.alarm for r in whole)
    frame = series(spark, [math.log1p(values["a", k]) for k in range(14)])
    want = filters.alarm_monitor(filters.local_level(frame)).orderBy("ds").collect()
    own = [r for r in whole if r.series == "a"]
    assert [(r.forecast, r.factor, r.cumulative, r.alarm) for r in own] == [(pytest.approx(w.forecast), pytest.approx(w.factor), pytest.approx(w.cumulative), w.alarm) for w in want[: len(own)]]


EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def write_events(spark, folder, rows):
    full = [(i, t, 1, "click", 1.0, "{}") for i, t in rows]
    spark.createDataFrame(full, EVENT).coalesce(1).write.mode("append").parquet(f"{folder}/events")


def test_late_rows(spark, tmp_path):
    import time

    day = dt.datetime
    batches = [
        [(1, day(2024, 1, 7, 1)), (2, day(2024, 1, 14, 6))],
        [(3, day(2024, 1, 13, 20))],  # 10 hours late: kept
        [(4, day(2024, 1, 2, 0)), (5, day(2024, 1, 15))],  # two weeks late: dropped
    ]
    for i, rows in enumerate(batches):
        write_events(spark, tmp_path, rows)
        time.sleep(1.1)
    stream = counts.event_stream(spark, f"{tmp_path}/events", files_per_batch=1)
    out = runner.upsert_table(counts.weekly_counts(stream, "event_type"), ["epi_sunday", "event_type"])
    assert {(str(r.epi_sunday), r.n) for r in out.collect()} == {("2024-01-07", 2), ("2024-01-14", 2)}


def test_stream_reads_its_own_path_only(spark, tmp_path):
    write_events(spark, tmp_path, [(1, dt.datetime(2024, 1, 7))])
    spark.read.parquet(f"{tmp_path}/events").write.parquet(f"{tmp_path}/events_old")
    assert runner.append_to_table(counts.event_stream(spark, f"{tmp_path}/events")).count() == 1


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    write_events(spark, tmp_path, [(1, dt.datetime(2024, 1, 7)), (2, dt.datetime(2024, 1, 7, 1))])
    write_events(spark, tmp_path, [(1, dt.datetime(2024, 1, 7)), (3, dt.datetime(2024, 1, 7, 2))])
    stream = counts.event_stream(spark, f"{tmp_path}/events", files_per_batch=1)
    assert sorted(r.event_id for r in runner.append_to_table(counts.once_only(stream)).collect()) == [1, 2, 3]
