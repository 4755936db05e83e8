"""Conformal calibration and bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.operators import conformal, series, splits
from epipanel.operators.ranks import value_counts
from epipanel.plans import bindings as b
from epipanel.session import reliable_checkpoint

define("preds52all", """select * from (select epi_sunday, ra, cases, lag(cases, 52) over (partition by ra order by epi_sunday) as prediction from grid)
    where prediction is not null""", "grid")
define("cal", """select *, least(row_number() over (partition by ra order by epi_sunday), 4) as horizon from preds52all
    where epi_sunday < date '2000-01-01' and epi_sunday in (select distinct epi_sunday from preds52all where epi_sunday < date '2000-01-01' order by 1 desc limit 26)""", "preds52all")
define("eps", "select greatest(0.10::double, quantile_cont(prediction, 0.10)) as e from cal", "cal")
define("scores", "select horizon, abs(cases - prediction) / (prediction + e) as score from cal, eps", "eps")
define("sizes", "select horizon, count(*) as n from scores group by 1", "scores")
define("pooled", "select z.horizon, s.score from sizes z join scores s on s.horizon = z.horizon or (z.n < 30 and s.horizon >= z.horizon)", "sizes")
define("ordered_scores", """select *, row_number() over (partition by horizon order by score) as rn, count(*) over (partition by horizon) as n from pooled""", "pooled")
define("leveled", "select *, least(1.0::double, ceil((n + 1) * (1.0::double - 0.1::double)) / n) as level from ordered_scores", "ordered_scores")
define("calibration", """select horizon, n, level, lo + (hi - lo) * (pos - floor(pos)) as q from (select horizon, n, level, (n - 1) * level as pos,
    max(case when rn = floor((n - 1) * level) + 1 then score end) as lo, max(case when rn = ceil((n - 1) * level) + 1 then score end) as hi
    from leveled group by horizon, n, level)""", "leveled")
define("banded", """select p.*, greatest(prediction - coalesce(c.q, f.q) * (prediction + e), 0.0::double) as lower_ci, prediction + coalesce(c.q, f.q) * (prediction + e) as upper_ci
    from (select *, row_number() over (partition by ra order by epi_sunday) as horizon from preds52) p left join calibration c on c.horizon = p.horizon,
    eps, (select q from calibration order by horizon desc limit 1) f""", "calibration", "preds52")


def _history(spark, sf):
    w = series.ordered(["ra"], "epi_sunday")
    return b.grid(spark, sf).withColumn("prediction", F.lag("cases", 52).over(w)).filter("prediction is not null")


def calibration_rows(spark, sf):
    train, _ = splits.year_split(_history(spark, sf), b.TEST_YEAR)
    return series.position_horizon(splits.last_weeks(train, 26), ["ra"], "epi_sunday", 4)


@query(
    "c1_calibrate",
    with_ctes("calibration") + f"select cast(horizon as integer) as horizon, n, {s6('level', 'level')}, {s6('q', 'q')}, {s6('(select e from eps)', 'epsilon')} from calibration",
)
def q_c1(spark, sf):
    out = conformal.calibrate(calibration_rows(spark, sf)).select("horizon", "n", "level", "q", "epsilon")
    return rounded(out, "level", "q", "epsilon")


@query("j12_pooled_scores", with_ctes("pooled") + f"select cast(horizon as integer) as horizon, {s6('score', 'score')}, cast(count(*) as double) as n from pooled group by horizon, score")
def q_j12(spark, sf):
    rows = reliable_checkpoint(calibration_rows(spark, sf).select("horizon", "cases", "prediction"))
    eps = conformal.adaptive_epsilon(rows, 0.10)
    scored = rows.select("horizon", conformal.nonconformity(eps).alias("score"))
    return rounded(conformal.pool_horizons(value_counts(scored, ["horizon"], "score")), "score")


BAND_OUT = f"select ra, epi_sunday, {s6('lower_ci', 'lower_ci')}, {s6('upper_ci', 'upper_ci')} from banded"


@query("c2_apply_bands", with_ctes("banded") + BAND_OUT)
def q_c2(spark, sf):
    placed = series.position_horizon(b.naive_predictions(spark, sf, 52), ["ra"], "epi_sunday", None)
    out = conformal.apply_bands(placed, conformal.calibrate(calibration_rows(spark, sf)))
    return rounded(out.select("ra", "epi_sunday", "lower_ci", "upper_ci"), "lower_ci", "upper_ci")


@query(
    "j10_quantile_lookup",
    with_ctes("banded") + f"select distinct cast(horizon as integer) as horizon, {s6('coalesce((select q from calibration c where c.horizon = b.horizon), (select q from calibration order by horizon desc limit 1))', 'q')} from banded b",
)
def q_j10(spark, sf):
    cal = conformal.calibrate(calibration_rows(spark, sf))
    placed = series.position_horizon(b.naive_predictions(spark, sf, 52), ["ra"], "epi_sunday", None).select("horizon").distinct()
    last_q = cal.agg(F.max_by("q", "horizon")).scalar()
    return placed.join(cal.select("horizon", "q"), "horizon", "left").select("horizon", r6(F.coalesce("q", last_q)).alias("q"))


@query("c4_null_bands", with_ctes("preds52") + "select ra, epi_sunday, prediction, cast(null as double) as lower_ci, cast(null as double) as upper_ci from preds52")
def q_c4(spark, sf):
    preds = b.naive_predictions(spark, sf, 52).withColumn("horizon", F.lit(1))
    unusable = preds.withColumn("prediction", F.lit(None).cast("double"))
    return conformal.bands_or_null(preds, unusable).select("ra", "epi_sunday", "prediction", "lower_ci", "upper_ci")


@query(
    "d19_rolling_calibration",
    with_ctes(
        "preds52all",
        s="select epi_sunday, abs(cases - prediction) / (prediction + 0.1::double) as score from preds52all",
        w="select t.epi_sunday, s.score from (select distinct epi_sunday from s) t join s on s.epi_sunday < t.epi_sunday and s.epi_sunday >= t.epi_sunday - 182",
        o="select *, row_number() over (partition by epi_sunday order by score) as rn, count(*) over (partition by epi_sunday) as n from w",
        l="select *, (n - 1) * least(1.0::double, ceil((n + 1) * (1.0::double - 0.1::double)) / n) as pos from o",
    )
    + f"""select epi_sunday, n, {s6('max(case when rn = floor(pos) + 1 then score end) + (max(case when rn = ceil(pos) + 1 then score end) - max(case when rn = floor(pos) + 1 then score end)) * (max(pos) - floor(max(pos)))', 'q')} from l group by epi_sunday, n""",
)
def q_d19(spark, sf):
    return rounded(conformal.rolling_calibration(_history(spark, sf), 26), "q")
