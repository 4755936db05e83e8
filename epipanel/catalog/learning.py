"""Model and experiment queries on the panel.

Those of two one-split trees have SQL that repeats the fit. Forests have the operators' default size but in tuning and ablation;
where models have fewer or smaller trees than the defaults, the README gives the time of the full size.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from epipanel.catalog.forecasts import _split
from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.operators import experiments, learners, recursion
from epipanel.operators.metrics import rmse
from epipanel.plans import bindings as b
from epipanel.plans.features import FeatureSet, feature_set
from epipanel.session import reliable_checkpoint

#: Fewer than the defaults where a query grows a dozen models; ``None`` stands for the defaults.
RF = {"n_estimators": 10, "max_depth": 5}
BOOST = {"n_estimators": 20}
YEAR = b.TEST_YEAR


def _panel(spark, sf):
    return reliable_checkpoint(b.full_panel(spark, sf))


COMPLETE = " and ".join(f"{c} is not null" for c in feature_set("lag+clima+RA").numeric_columns())


def _hot(width: int):
    """Where the region's 1 sits in the vector and how wide the vector is."""
    v = vector_to_array(learners.VECTOR)
    tail = F.slice(v, width + 1, F.size(v) - width)
    return [F.size(v).alias("width"), F.aggregate(tail, F.lit(0.0), lambda a, x: a + x).alias("hot"), v[0].alias("first_lag"), r6("y").alias("y")]


@query(
    "m1_encoded_features",
    with_ctes("panel") + f"select ra, epi_sunday, cast(32 + (select count(*) from nation) as integer) as width, 1.0::double as hot, cases_lag_1 as first_lag, {s6('ln(1 + cases)', 'y')} from panel where {COMPLETE}",
)
def q_m1(spark, sf):
    features = feature_set("lag+clima+RA")
    out = learners.design_matrix(b.full_panel(spark, sf), features)
    return out.select("ra", "epi_sunday", *_hot(len(features.numeric_columns())))


@query(
    "m3_aligned_design_matrix",
    with_ctes("panel") + f"select ra, epi_sunday, cast(52 as integer) as width, case when cast(replace(ra, 'NATION_', '') as integer) < 20 then 1.0::double else 0.0::double end as hot, cases_lag_1 as first_lag, {s6('ln(1 + cases)', 'y')} from panel where {COMPLETE}",
)
def q_m3(spark, sf):
    features = feature_set("lag+clima+RA")
    labels = [f"NATION_{i}" for i in range(20)]
    out = learners.design_matrix(b.full_panel(spark, sf), features, labels)
    return out.select("ra", "epi_sunday", *_hot(len(features.numeric_columns())))


@query(
    "m2_target_transform",
    with_ctes("grid") + f"select ra, epi_sunday, {s6('ln(1 + cases)', 'target')}, {s6('greatest(exp(ln(1 + cases) * 0.9::double) - 1, 0)', 'restored')} from grid",
)
def q_m2(spark, sf):
    target = F.log1p("cases")
    restored = learners.to_cases(target * 0.9, feature_set("lag-only"))
    return b.grid(spark, sf).select("ra", "epi_sunday", r6(target).alias("target"), r6(restored).alias("restored"))


@query("m5_fit_predict")
def q_m5(spark, sf):
    """At full size: 150 trees of depth 15."""
    return learners.fit_and_predict(_panel(spark, sf), feature_set("lag-only"), "RF", None, YEAR).predictions


ONE_LAG = FeatureSet("one-lag", "cases", ("cases_lag_1",))
define("onelag", "select ra, epi_sunday, cases, ln(1 + cases) as y, cases_lag_1 as x from lagged where cases_lag_1 is not null and populacao is not null", "lagged")
BACK = "greatest(exp(a + b * x) - 1, 0.0::double)"


@query(
    "m5_least_squares",
    with_ctes("onelag", w="select regr_intercept(y, x) as a, regr_slope(y, x) as b from onelag where epi_sunday < date '2000-01-01'")
    + f"select ra, epi_sunday, cases, {s6(BACK, 'prediction')} from onelag, w where year(epi_sunday) = 2000",
)
def q_m5_lin(spark, sf):
    """The same fit and prediction with a model whose result SQL has too."""
    out = learners.fit_and_predict(_panel(spark, sf), ONE_LAG, "LIN", None, YEAR).predictions
    return out.select("ra", "epi_sunday", "cases", r6("prediction").alias("prediction"))


@query(
    "m7_cv_least_squares",
    with_ctes(
        "onelag",
        d="select epi_sunday, row_number() over (order by epi_sunday) - 1 as i, count(*) over () as n from (select distinct epi_sunday from lagged where epi_sunday < date '2000-01-01')",
        f="select fold, i, epi_sunday, n - (6 - fold) * (n // 6) as start, n // 6 as size from d cross join (select unnest(range(1, 6)) as fold)",
        w="select fold, regr_intercept(y, x) as a, regr_slope(y, x) as b from f join onelag using (epi_sunday) where i < start - 4 group by fold",
        e=f"select fold, sqrt(avg(pow(cases - {BACK}, 2))) as rmse from f join onelag using (epi_sunday) join w using (fold) where i >= start and i < start + size group by fold",
    )
    + f"select 'LIN' as modelo, {s6('avg(rmse)', 'cv_rmse')} from e",
)
def q_m7_lin(spark, sf):
    train = _panel(spark, sf).filter(F.year("epi_sunday") < YEAR)
    score = experiments.cv_score(train, ONE_LAG, "LIN")
    return spark.createDataFrame([("LIN", score)], "modelo string, cv_rmse double").withColumn("cv_rmse", r6("cv_rmse"))


#: Two trees of one split: few enough to be repeated in SQL.
STUMPS = {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.5}
ONE_RATE = FeatureSet("one-rate", "incidencia_100k", ("cases_lag_1",))


def _split_sql(rows: str, margin: str, trees: str, rate: str, name: str) -> dict[str, str]:
    """The best cut of ``rows`` (grp, x, y) by second-order gain, penalty 1, and its two leaves."""
    return {
        f"{name}v": f"select grp, x, sum({margin} - y) as g, count(*)::double as h from {rows} join {trees} using (grp) group by all",
        f"{name}k": f"select grp, x, sum(g) over w as lg, sum(h) over w as lh, sum(g) over (partition by grp) as tg, sum(h) over (partition by grp) as th from {name}v window w as (partition by grp order by x)",
        f"{name}b": f"""select grp, x as c, -{rate} * lg / (lh + 1) as l, -{rate} * (tg - lg) / (th - lh + 1) as r,
            lg * lg / (lh + 1) + pow(tg - lg, 2) / (th - lh + 1) - tg * tg / (th + 1) as gain from {name}k where th > lh
            qualify row_number() over (partition by grp order by gain desc, x) = 1""",
        name: f"select t.*, b.c as {name}c, b.l as {name}l, b.r as {name}r from {trees} t join {name}b b using (grp)",
    }


def stumps_sql(rows: str, rate: str = "0.5::double") -> dict[str, str]:
    """``second`` has a row for each grp: the start value and the cuts and leaves of two rounds."""
    return {
        "start": f"select grp, avg(y) as s from {rows} group by grp",
        **_split_sql(rows, "s", "start", rate, "first"),
        **_split_sql(rows, "(s + case when x <= firstc then firstl else firstr end)", "first", rate, "second"),
    }


def raw_sql(x: str) -> str:
    return f"(s + case when {x} <= firstc then firstl else firstr end + case when {x} <= secondc then secondl else secondr end)"


def cases_sql(x: str) -> str:
    return f"greatest(exp({raw_sql(x)}) - 1, 0.0::double)"


define("onerate", "select ra, epi_sunday, cases, populacao, ln(1 + incidencia_100k) as y, cases_lag_1 as x from lagged where cases_lag_1 is not null and populacao is not null and incidencia_100k is not null", "lagged")


@query(
    "m5_stumps",
    with_ctes("onelag", tr="select 1 as grp, * from onelag where epi_sunday < date '2000-01-01'", **stumps_sql("tr"))
    + f"select ra, epi_sunday, cases, {s6(cases_sql('x'), 'prediction')} from onelag, second where year(epi_sunday) = 2000",
)
def q_m5_stumps(spark, sf):
    """Two rounds of second-order boosting with one split each."""
    out = learners.fit_and_predict(_panel(spark, sf), ONE_LAG, "XGB", STUMPS, YEAR).predictions
    return out.select("ra", "epi_sunday", "cases", r6("prediction").alias("prediction"))


@query(
    "m6_rate_stumps",
    with_ctes("onerate", tr="select 1 as grp, * from onerate where epi_sunday < date '2000-01-01'", **stumps_sql("tr"))
    + f"select ra, epi_sunday, cases, {s6(cases_sql('x') + ' * populacao / 100000.0::double', 'prediction')} from onerate, second where year(epi_sunday) = 2000",
)
def q_m6_stumps(spark, sf):
    out = learners.fit_and_predict(_panel(spark, sf), ONE_RATE, "XGB", STUMPS, YEAR).predictions
    return out.select("ra", "epi_sunday", "cases", r6("prediction").alias("prediction"))


@query("m6_rate_to_cases")
def q_m6(spark, sf):
    features = feature_set("lag+clima+RA+incid-target")
    return learners.fit_and_predict(_panel(spark, sf), features, "XGB", BOOST, YEAR).predictions


FOLDS = {
    "d": "select epi_sunday, row_number() over (order by epi_sunday) - 1 as i, count(*) over () as n from (select distinct epi_sunday from lagged where epi_sunday < date '2000-01-01')",
    "f": "select fold, i, epi_sunday, n - (6 - fold) * (n // 6) as start_, n // 6 as size from d cross join (select unnest(range(1, 6)) as fold)",
    "tr": "select fold as grp, x, y from f join onelag using (epi_sunday) where i < start_ - 4",
    "va": "select fold as grp, x, cases from f join onelag using (epi_sunday) where i >= start_ and i < start_ + size",
}
RMSE = f"select avg(e) as cv_rmse from (select grp, sqrt(avg(pow(cases - {cases_sql('x')}, 2))) as e from va join second using (grp) group by grp)"


@query("m7_cv_stumps", with_ctes("onelag", **FOLDS, **stumps_sql("tr"), sc=RMSE) + f"select 'XGB' as modelo, {s6('cv_rmse', 'cv_rmse')} from sc")
def q_m7_stumps(spark, sf):
    """Five folds, grown in one batch."""
    train = _panel(spark, sf).filter(F.year("epi_sunday") < YEAR)
    score = experiments.cv_score(train, ONE_LAG, "XGB", STUMPS)
    return spark.createDataFrame([("XGB", score)], "modelo string, cv_rmse double").withColumn("cv_rmse", r6("cv_rmse"))


@query("m7_cv_score")
def q_m7(spark, sf):
    """One row per model: mean validation RMSE over the expanding folds, the forest at full size."""
    train = _panel(spark, sf).filter(F.year("epi_sunday") < YEAR)
    rows = [(m, experiments.cv_score(train, feature_set("lag-only"), m, p)) for m, p in (("RF", None), ("XGB", BOOST))]
    return spark.createDataFrame(rows, "modelo string, cv_rmse double")


def _tuned_sql(rate: str, name: str) -> str:
    inner = with_ctes("onelag", **FOLDS, **stumps_sql("tr", f"{rate}::double"), sc=RMSE)
    return f"select 'XGB' as modelo, 'one-lag' as config, {s6('cv_rmse', 'cv_rmse')}, '{{\"learning_rate\": {rate}, \"max_depth\": 1, \"n_estimators\": 2}}' as params from ({inner} select * from sc) {name}"


@query("m8_tuning_stumps", _tuned_sql("0.5", "a") + " union all " + _tuned_sql("0.25", "b"))
def q_m8_stumps(spark, sf):
    """Two grid points of five folds: ten fits in one batch."""
    grids = {"XGB": {"n_estimators": [2], "max_depth": [1], "learning_rate": [0.5, 0.25]}}
    return rounded(experiments.tune(b.full_panel(spark, sf), ONE_LAG, grids, YEAR)[0], "cv_rmse")


@query("m8_tuning")
def q_m8(spark, sf):
    grids = {"RF": {"n_estimators": [5, 10], "max_depth": [3, 5]}, "XGB": {"n_estimators": [3, 5], "max_depth": [3], "colsample_bytree": [0.8]}}
    return experiments.tune(b.full_panel(spark, sf), "lag-only", grids, YEAR)[0]


@query(
    "m9_ablation_stumps",
    with_ctes("onelag", "onerate", tr="""select 0 as grp, x, y from onelag where epi_sunday < date '2000-01-01' union all select 1, x, y from onerate where epi_sunday < date '2000-01-01'""", **stumps_sql("tr"))
    + f"""select 'one-lag' as config, 'XGB' as modelo, ra, epi_sunday, {s6(cases_sql('x'), 'prediction')} from onelag join second on grp = 0 where year(epi_sunday) = 2000
      union all select 'one-rate', 'XGB', ra, epi_sunday, {s6(cases_sql('x') + ' * populacao / 100000.0::double')} from onerate join second on grp = 1 where year(epi_sunday) = 2000""",
)
def q_m9_stumps(spark, sf):
    """Two configurations of different targets, grown in one batch."""
    out = experiments.ablation(b.full_panel(spark, sf), YEAR, {"XGB": STUMPS}, [ONE_LAG, ONE_RATE])["predictions"]
    return out.select("config", "modelo", "ra", "epi_sunday", r6("prediction").alias("prediction"))


@query("m9_ablation")
def q_m9(spark, sf):
    out = experiments.ablation(b.full_panel(spark, sf), YEAR, {"RF": RF, "XGB": BOOST})
    return out["summary"]


@query(
    "m10_rolling_stumps",
    with_ctes(
        "onelag", hw="select distinct epi_sunday from lagged where epi_sunday < date '2000-01-01' order by 1 desc limit 26",
        tr="select 1 as grp, x, y from onelag where epi_sunday < (select min(epi_sunday) from hw)", **stumps_sql("tr"),
        held=f"select ra, cases, least(row_number() over (partition by ra order by epi_sunday), 4) as k, {cases_sql('x')} as p from onelag join hw using (epi_sunday), second",
        eps="select greatest(0.1::double, quantile_cont(p, 0.1)) as e from held",
        sc="select k, abs(cases - p) / (p + e) as v from held, eps",
        sz="select k, count(*) as n from sc group by k",
        pool="select sz.k, list_sort(list(v)) as l from sz join sc on sc.k = sz.k or (sz.n < 30 and sc.k >= sz.k) group by sz.k",
        lv="select k, l, (len(l) - 1) * least(1.0::double, ceil((len(l) + 1) * 0.9::double) / len(l)) as place from pool",
        q="select k, l[cast(floor(place) as bigint) + 1] + (l[cast(ceil(place) as bigint) + 1] - l[cast(floor(place) as bigint) + 1]) * (place - floor(place)) as q from lv",
        h="select ra, arg_max(cases, epi_sunday) as last from rated where epi_sunday < date '2000-01-01' group by ra",
        t="select ra, epi_sunday, row_number() over (partition by ra order by epi_sunday) as i from rated where year(epi_sunday) = 2000",
        r=f"select ra, 0::bigint as i, last as p from h union all select r.ra, r.i + 1, {cases_sql('r.p')} from r join t on t.ra = r.ra and t.i = r.i + 1, second",
        modes=f"""select 'nowcasting_rolling' as modo, ra, epi_sunday, 1 as k, {cases_sql('x')} as p from onelag, second where year(epi_sunday) = 2000
          union all select 'forecast_fechado_recursivo', ra, epi_sunday, least(i, 4), p from t join r using (ra, i)""",
    ).replace("with ", "with recursive ", 1).replace("\nsecond as (", "\nsecond as materialized (").replace("\nlagged as (", "\nlagged as materialized (")
    + f"""select modo, ra, epi_sunday, {s6('p', 'prediction')}, {s6('greatest(p - q * (p + e), 0)', 'lower_ci')}, {s6('p + q * (p + e)', 'upper_ci')} from modes join q using (k), eps""",
)
def q_m10_stumps(spark, sf):
    """One-step and closed forecasts with bands from held-out weeks."""
    out = experiments.rolling_validation(b.full_panel(spark, sf), YEAR, ONE_LAG, "XGB", STUMPS)["predictions"]
    return rounded(out.select("modo", "ra", "epi_sunday", "prediction", "lower_ci", "upper_ci"), "prediction", "lower_ci", "upper_ci")


@query("m10_rolling_validation")
def q_m10(spark, sf):
    """At full size: 150 trees of depth 15."""
    return experiments.rolling_validation(b.full_panel(spark, sf), YEAR)["metrics"]


@query("m11_recursive_forecast")
def q_m11(spark, sf):
    """At full size: 150 trees of depth 15."""
    panel, features = _panel(spark, sf), feature_set("lag-only")
    fitted = learners.fit(panel.filter(F.year("epi_sunday") < YEAR), features, "RF", None)
    return recursion.recursive_forecast(panel, fitted, features, YEAR)


@query(
    "m11_recursive_stumps",
    with_ctes("onelag", tr="select 1 as grp, * from onelag where epi_sunday < date '2000-01-01'", **stumps_sql("tr")).replace("with ", "with recursive ", 1)
    + f""", h as (select ra, arg_max(cases, epi_sunday) as last from rated where epi_sunday < date '2000-01-01' group by ra),
      t as (select ra, epi_sunday, cases, row_number() over (partition by ra order by epi_sunday) as k from rated where year(epi_sunday) = 2000),
      r as (select ra, 0::bigint as k, last as prediction from h union all select r.ra, r.k + 1, {cases_sql('r.prediction')} from r join t on t.ra = r.ra and t.k = r.k + 1, second)
      select ra, epi_sunday, cases, {s6('prediction', 'prediction')} from t join r using (ra, k)""",
)
def q_m11_stumps(spark, sf):
    """Every week's lag is the week before's own prediction."""
    panel = _panel(spark, sf)
    fitted = learners.fit(panel.filter(F.year("epi_sunday") < YEAR), ONE_LAG, "XGB", STUMPS)
    out = recursion.recursive_forecast(panel, fitted, ONE_LAG, YEAR)
    return out.select("ra", "epi_sunday", "cases", r6("prediction").alias("prediction"))


@query(
    "m12_direct_stumps",
    with_ctes(
        "onelag", w="select *, lead(cases, 1) over v as c1, lead(cases, 2) over v as c2, lead(cases, 3) over v as c3, lead(cases, 4) over v as c4 from onelag window v as (partition by ra order by epi_sunday)",
        lo="select ra, epi_sunday, x, k as grp, [c1, c2, c3, c4][k] as ahead from w cross join (select unnest([1, 2, 3, 4]) as k)",
        tr="select grp, x, ln(1 + ahead) as y from lo where ahead is not null and epi_sunday < date '2000-01-01' - cast(7 * grp as integer)",
        **stumps_sql("tr"),
    )
    + f"""select ra, epi_sunday, epi_sunday + cast(7 * grp as integer) as target_week, ahead as cases, {s6(cases_sql('x'), 'prediction')}, grp as horizon
      from lo join second using (grp) where year(epi_sunday) = 2000 and ahead is not null""",
)
def q_m12_stumps(spark, sf):
    """Four horizons, grown in one batch."""
    out = experiments.direct_multihorizon(b.full_panel(spark, sf), ONE_LAG, "XGB", 4, YEAR, STUMPS)["predictions"]
    return out.select("ra", "epi_sunday", "target_week", "cases", r6("prediction").alias("prediction"), "horizon")


@query("m12_direct_multihorizon")
def q_m12(spark, sf):
    return experiments.direct_multihorizon(b.full_panel(spark, sf), "lag-only", "RF", 4, YEAR)["metrics"]


@query("m14_global_model")
def q_m14(spark, sf):
    train = reliable_checkpoint(_split(spark, sf)[0].select("unique_id", "ds", "y"))
    return recursion.global_model(train, 52, BOOST)[1]


@query(
    "m18_legacy_stumps",
    with_ctes("onelag", tr="select 1 as grp, * from onelag where epi_sunday < date '2000-01-01'", **stumps_sql("tr"),
              p=f"select cases, {cases_sql('x')} as p from onelag, second where epi_sunday >= date '2000-01-01'")
    + f"""select 'XGB' as modelo, {s6('1 - sum(pow(cases - p, 2)) / (var_pop(cases) * count(*))', 'r2')}, {s6('avg(abs(cases - p))', 'mae')}, {s6('sqrt(avg(pow(cases - p, 2)))', 'rmse')}, count(*) as n_rows from p""",
)
def q_m18_stumps(spark, sf):
    return rounded(experiments.legacy_evaluation(b.full_panel(spark, sf), YEAR, {"XGB": STUMPS}, ONE_LAG), "r2", "mae", "rmse")


@query(
    "m4_model_factory",
    with_ctes("onelag", tr="select 1 as grp, * from onelag where epi_sunday < date '2000-01-01'", **stumps_sql("tr"), w="select regr_intercept(y, x) as a, regr_slope(y, x) as b from tr")
    + f"""select 'LIN' as modelo, count(*) as n, {s6(f'sqrt(avg(pow(cases - {BACK}, 2)))', 'rmse')} from onelag, w where year(epi_sunday) = 2000
      union all select 'XGB', count(*), {s6(f"sqrt(avg(pow(cases - {cases_sql('x')}, 2)))")} from onelag, second where year(epi_sunday) = 2000""",
)
def q_m4(spark, sf):
    """Models by name, with overrides, through one call."""
    panel, rows = _panel(spark, sf), []
    for name, params in (("LIN", None), ("XGB", STUMPS)):
        out = learners.fit_and_predict(panel, ONE_LAG, name, params, YEAR).predictions
        rows.append(out.groupBy(F.lit(name).alias("modelo")).agg(F.count("*").alias("n"), r6(rmse()).alias("rmse")))
    return rows[0].unionByName(rows[1])


define("waves", "select unique_id, ds, y, lag(y) over (partition by unique_id order by ds) as x0, cast(week(ds) as double) as x1, cast(month(ds) as double) as x2 from train", "train")


def _three_sql(margin: str, trees: str, name: str) -> dict[str, str]:
    """The best cut among three inputs (lowest input, then lowest value on ties), penalty 1, rate 0.5."""
    return {
        f"{name}v": f"select f, [x0, x1, x2][f + 1] as x, sum({margin} - y) as g, count(*)::double as h from waves, {trees}, (select unnest([0, 1, 2]) as f) where x0 is not null group by all",
        f"{name}k": f"select f, x, sum(g) over w as lg, sum(h) over w as lh, sum(g) over (partition by f) as tg, sum(h) over (partition by f) as th from {name}v window w as (partition by f order by x)",
        f"{name}b": f"""select f as {name}f, x as {name}c, -0.5::double * lg / (lh + 1) as {name}l, -0.5::double * (tg - lg) / (th - lh + 1) as {name}r from {name}k where th > lh
            order by lg * lg / (lh + 1) + pow(tg - lg, 2) / (th - lh + 1) - tg * tg / (th + 1) desc, f, x limit 1""",
        name: f"select * from {trees}, {name}b",
    }


def _leaf_sql(name: str, lag: str, ds: str) -> str:
    return f"case when [{lag}, cast(week({ds}) as double), cast(month({ds}) as double)][{name}f + 1] <= {name}c then {name}l else {name}r end"


@query(
    "m14_global_stumps",
    with_ctes(
        "waves", start="select avg(y) as s from waves where x0 is not null",
        **_three_sql("s", "start", "one"), **_three_sql(f"(s + {_leaf_sql('one', 'x0', 'ds')})", "one", "two"),
    ).replace("with ", "with recursive ", 1).replace("\ntrain as (", "\ntrain as materialized (").replace("\ntwo as (", "\ntwo as materialized (")
    + f""", r as (select unique_id, max(ds) as ds, 0 as h, arg_max(y, ds)::double as prediction from train group by 1 union all
      select unique_id, ds + 7, h + 1, s + {_leaf_sql('one', 'prediction', '(ds + 7)')} + {_leaf_sql('two', 'prediction', '(ds + 7)')} from r, two where h < 52)
      select unique_id, ds, h, {s6('prediction', 'prediction')} from r where h > 0""",
)
def q_m14_stumps(spark, sf):
    """Two rounds over all series; every step's lag is the step before's own prediction."""
    train = reliable_checkpoint(_split(spark, sf)[0].select("unique_id", "ds", "y"))
    return rounded(recursion.global_model(train, 52, STUMPS, (1,))[1], "prediction")


@query("m18_legacy_evaluation")
def q_m18(spark, sf):
    return experiments.legacy_evaluation(b.full_panel(spark, sf), YEAR, {"RF": None, "XGB": BOOST})


@query("k6_importances")
def q_k6(spark, sf):
    features = feature_set("lag+clima+RA")
    fitted = learners.fit(_panel(spark, sf).filter(F.year("epi_sunday") < YEAR), features, "RF", None)
    return spark.createDataFrame(learners.importances(fitted, features), "feature string, importance double")
