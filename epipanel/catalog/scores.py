"""Accuracy metrics on deterministic predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.functions import text
from epipanel.operators import metrics, ranks
from epipanel.plans import bindings as b

define("tot52", "select epi_sunday, sum(cases) as cases, sum(prediction) as prediction from preds52 group by 1", "preds52")
define("band52", "select *, greatest(prediction - 1.5::double, 0.0::double) as lower_ci, prediction + 1.5::double as upper_ci from preds52", "preds52")

R2 = "case when count(*) >= 2 and var_pop(cases) > 1e-8 then 1 - sum(pow(cases - prediction, 2)) / (var_pop(cases) * count(*)) end"
RMSE = "sqrt(avg(pow(cases - prediction, 2)))"
MAE = "avg(abs(cases - prediction))"
MAPE = "avg(case when cases > 0 then abs(cases - prediction) / cases * 100 end)"
SMAPE = "avg(200 * abs(cases - prediction) / (abs(cases) + abs(prediction) + 1e-8))"
COVER = "avg(cast(cases >= lower_ci and cases <= upper_ci as integer))"
WIS = "avg((upper_ci - lower_ci) + 2 / 0.1::double * (greatest(lower_ci - cases, 0) + greatest(cases - upper_ci, 0)))"


def _totals(spark, sf, lag=52):
    return metrics.weekly_totals(b.naive_predictions(spark, sf, lag))


def _banded(spark, sf):
    preds = b.naive_predictions(spark, sf, 52)
    low = F.greatest(F.col("prediction") - 1.5, F.lit(0.0))
    return preds.withColumns({"lower_ci": low, "upper_ci": F.col("prediction") + 1.5})


@query("e1_r2", with_ctes("tot52") + f"select {s6(R2, 'r2')} from tot52")
def q_e1(spark, sf):
    return _totals(spark, sf).agg(r6(metrics.r2()).alias("r2"))


@query("e2_rmse", with_ctes("tot52") + f"select {s6(RMSE, 'rmse')} from tot52")
def q_e2(spark, sf):
    return _totals(spark, sf).agg(r6(metrics.rmse()).alias("rmse"))


@query("e3_mae", with_ctes("tot52") + f"select {s6(MAE, 'mae')} from tot52")
def q_e3(spark, sf):
    return _totals(spark, sf).agg(r6(metrics.mae()).alias("mae"))


@query("e4_mape", with_ctes("preds52") + f"select ra, {s6(MAPE, 'mape')} from preds52 group by ra")
def q_e4(spark, sf):
    return b.naive_predictions(spark, sf, 52).groupBy("ra").agg(r6(metrics.mape()).alias("mape"))


@query("e5_smape", with_ctes("preds52") + f"select ra, {s6(SMAPE, 'smape')} from preds52 group by ra")
def q_e5(spark, sf):
    return b.naive_predictions(spark, sf, 52).groupBy("ra").agg(r6(metrics.smape()).alias("smape"))


HIT = "(select count_if(cases >= t and prediction >= t)::double / nullif(count_if(cases >= t), 0) from {0}, (select quantile_cont(cases, 0.75) as t from {0}))"


@query("e6_peak_hit_rate", with_ctes("tot52") + f"select {s6('quantile_cont(cases, 0.75)', 'peak_value')}, {s6(HIT.format('tot52'), 'hit_rate')} from tot52")
def q_e6(spark, sf):
    return rounded(metrics.point_metrics(_totals(spark, sf)).select("peak_value", "hit_rate"), "peak_value", "hit_rate")


@query("e7_coverage", with_ctes("band52") + f"select ra, {s6(COVER, 'coverage')} from band52 group by ra")
def q_e7(spark, sf):
    return _banded(spark, sf).groupBy("ra").agg(r6(metrics.coverage()).alias("coverage"))


@query(
    "p14_schema_contract",
    with_ctes("band52") + f"""select 'bands' as given, false as refused, {s6(COVER, 'coverage')} from band52 union all
      select 'no bands', true, null from (select count(*) as n from band52) where n >= 0""",
)
def q_p14(spark, sf):
    """Coverage where the columns are there; without them the strict form refuses and the lenient one is null."""
    banded = _banded(spark, sf)
    plain = banded.drop("lower_ci", "upper_ci")
    try:
        refused = metrics.interval_coverage(plain) is None
    except ValueError:
        refused = True
    whole = metrics.interval_coverage(banded).select(F.lit("bands").alias("given"), F.lit(False).alias("refused"), r6("coverage").alias("coverage"))
    without = metrics.interval_coverage(plain, strict=False).select(F.lit("no bands").alias("given"), F.lit(refused).alias("refused"), F.col("coverage").cast("double").alias("coverage"))
    return whole.unionByName(without)


@query("e8_wis", with_ctes("band52") + f"select ra, {s6(WIS, 'wis')} from band52 group by ra")
def q_e8(spark, sf):
    return _banded(spark, sf).groupBy("ra").agg(r6(metrics.interval_score(0.1)).alias("wis"))


@query("e9_calibration_error", with_ctes("band52") + f"select {s6(f'abs({COVER} - 0.9::double)', 'calibration_error')} from band52")
def q_e9(spark, sf):
    return _banded(spark, sf).agg(r6(metrics.calibration_error(metrics.coverage(), 0.1)).alias("calibration_error"))


CONSOLIDATED = ["r2", "mae", "rmse", "mape", "smape", "peak_value", "hit_rate", "coverage", "wis", "calibration_error", "r2_mean_ra", "mae_mean_ra", "rmse_mean_ra"]


@query(
    "e10_consolidated",
    with_ctes("band52", "tot52", reg=f"select ra, {R2} as r2, {MAE} as mae, {RMSE} as rmse from preds52 group by ra")
    + f"""select {s6(R2, 'r2')}, {s6(MAE, 'mae')}, {s6(RMSE, 'rmse')}, {s6(MAPE, 'mape')}, {s6(SMAPE, 'smape')}, {s6('quantile_cont(cases, 0.75)', 'peak_value')},
      {s6(HIT.format('tot52'), 'hit_rate')}, {s6(f'(select {COVER} from band52)', 'coverage')}, {s6(f'(select {WIS} from band52)', 'wis')},
      {s6(f'(select abs({COVER} - 0.9::double) from band52)', 'calibration_error')}, {s6('(select avg(r2) from reg)', 'r2_mean_ra')},
      {s6('(select avg(mae) from reg)', 'mae_mean_ra')}, {s6('(select avg(rmse) from reg)', 'rmse_mean_ra')} from tot52""",
)
def q_e10(spark, sf):
    return rounded(metrics.consolidated(_banded(spark, sf)), *CONSOLIDATED)


@query(
    "e10_region_table",
    with_ctes("preds52") + f"select ra, {s6(R2, 'r2_ra')}, {s6(MAE, 'mae_ra')}, {s6(RMSE, 'rmse_ra')} from preds52 group by ra",
)
def q_e10_regions(spark, sf):
    return rounded(metrics.region_metrics(b.naive_predictions(spark, sf, 52)), "r2_ra", "mae_ra", "rmse_ra")


@query(
    "e10_region_bands",
    with_ctes("band52") + f"select ra, {s6(R2, 'r2_ra')}, {s6(MAE, 'mae_ra')}, {s6(RMSE, 'rmse_ra')}, {s6(COVER, 'coverage_ra')}, {s6(WIS, 'wis_ra')} from band52 group by ra",
)
def q_e10_region_bands(spark, sf):
    return rounded(metrics.region_metrics(_banded(spark, sf)), "r2_ra", "mae_ra", "rmse_ra", "coverage_ra", "wis_ra")


@query(
    "e11_metrics_per_model",
    with_ctes("preds52", "preds1", p="select 'lag52' as modelo, * from preds52 union all select 'lag1', * from preds1",
              t="select modelo, epi_sunday, sum(cases) as cases, sum(prediction) as prediction from p group by all")
    + f"""select modelo, {s6(R2, 'r2')}, {s6(MAE, 'mae')}, {s6(RMSE, 'rmse')}, {s6(MAPE, 'mape')}, {s6(SMAPE, 'smape')} from t group by modelo""",
)
def q_e11(spark, sf):
    both = b.naive_predictions(spark, sf, 52).withColumn("modelo", F.lit("lag52")).unionByName(
        b.naive_predictions(spark, sf, 1).withColumn("modelo", F.lit("lag1"))
    )
    out = metrics.consolidated(both, "modelo").select("modelo", "r2", "mae", "rmse", "mape", "smape")
    return rounded(out, "r2", "mae", "rmse", "mape", "smape")


AUC = """select {1} from (select toxic, rank() over (order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0::double as r from documents join labels using (doc_id))"""
AUC_EXPR = "(sum(case when toxic = 1 then r end) - count_if(toxic = 1)::double * (count_if(toxic = 1) + 1) / 2) / (count_if(toxic = 1)::double * count_if(toxic = 0))"


@query("e13_auc", AUC.format("n_chars", s6(AUC_EXPR, "auc") + ", cast(count_if(toxic = 1) as bigint) as n_pos, cast(count_if(toxic = 0) as bigint) as n_neg"))
def q_e13(spark, sf):
    scored = b.labelled_documents(spark, sf).select(F.col("n_chars").cast("double").alias("score"), "toxic")
    return rounded(ranks.roc_auc(scored, [], "score", "toxic"), "auc")


@query(
    "e13_auc_comparison",
    "with a as (" + AUC.format("n_chars", AUC_EXPR + " as auc") + "), b as ("
    + AUC.format("length(regexp_replace(text, '[^!?]', '', 'g'))", AUC_EXPR + " as auc") + ")"
    + f" select 'chars' as model, {s6('auc', 'auc')} from a union all select 'marks', {s6('auc', 'auc')} from b",
)
def q_e13_compare(spark, sf):
    docs = b.labelled_documents(spark, sf)
    marks = F.length(F.regexp_replace("text", "[^!?]", ""))
    scored = docs.select("toxic", F.col("n_chars").cast("double").alias("chars"), marks.cast("double").alias("marks"))
    long = scored.unpivot(["toxic"], ["chars", "marks"], "model", "score")
    return rounded(ranks.roc_auc(long, ["model"], "score", "toxic").select("model", "auc"), "auc")
