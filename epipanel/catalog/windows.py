"""Lags, leads, interpolation, folds and other ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import query, r6, rounded, s6, with_ctes
from epipanel.operators import decisions, panel, regions, series, splits
from epipanel.operators.metrics import region_metrics, rmse
from epipanel.plans import bindings as b

LAG_COLS = [f"{c}_lag_{n}" for c in ("cases", "incidencia_100k") for n in range(1, 5)]


@query(
    "w1_case_lags",
    with_ctes("lagged") + "select ra, epi_sunday, " + ", ".join(c if c.startswith("cases") else s6(c, c) for c in LAG_COLS) + " from lagged",
)
def q_w1(spark, sf):
    rated = panel.add_population(b.grid(spark, sf), b.population(spark, sf))
    lagged = series.add_lags(rated, ["ra"], "epi_sunday", ("cases", "incidencia_100k"), range(1, 5))
    return rounded(lagged.select("ra", "epi_sunday", *LAG_COLS), *LAG_COLS[4:])


CLIM = [f"{c}_lag_{n}" for c in ("precip_sum", "temp_mean", "umidmed") for n in range(2, 9)]


@query("w2_climate_lags", with_ctes("climlag") + "select epi_sunday, " + ", ".join(s6(c, c) for c in CLIM) + " from climlag")
def q_w2(spark, sf):
    return rounded(panel.climate_lags(b.climate(spark, sf)).select("epi_sunday", *CLIM), *CLIM)


@query(
    "w3_trend",
    with_ctes("panel") + f"select ra, epi_sunday, cases_delta_1, cases_delta_2, {s6('cases_growth_rate', 'cases_growth_rate')} from panel",
)
def q_w3(spark, sf):
    lagged = series.add_lags(b.grid(spark, sf), ["ra"], "epi_sunday", ["cases"], range(1, 4))
    out = series.add_trend(lagged).select("ra", "epi_sunday", "cases_delta_1", "cases_delta_2", "cases_growth_rate")
    return rounded(out, "cases_growth_rate")


@query(
    "weekly_panel_lags",
    with_ctes("panel") + "select ra, epi_sunday, ano, cases, populacao, week_of_year, month, "
    + ", ".join(s6(c, c) for c in ["incidencia_100k", *LAG_COLS, *CLIM, "cases_growth_rate", "sin_week", "cos_week", "sin_month", "cos_month"])
    + ", cases_delta_1, cases_delta_2 from panel",
)
def q_weekly_panel(spark, sf):
    full = b.full_panel(spark, sf)
    doubles = ["incidencia_100k", *LAG_COLS, *CLIM, "cases_growth_rate", "sin_week", "cos_week", "sin_month", "cos_month"]
    keep = ["ra", "epi_sunday", "ano", "cases", "populacao", "week_of_year", "month", "cases_delta_1", "cases_delta_2"]
    return rounded(full.select(*keep, *doubles), *doubles)


for _k in (1, 4):

    @query(
        f"w4_lead_target_{_k}",
        with_ctes("grid") + f"select * from (select ra, epi_sunday, cases, lead(cases, {_k}) over (partition by ra order by epi_sunday) as target from grid) where target is not null",
    )
    def q_w4(spark, sf, k=_k):
        return series.lead_target(b.grid(spark, sf), ["ra"], "epi_sunday", "cases", k, "target").select("ra", "epi_sunday", "cases", "target")


@query(
    "w5_position_horizon",
    with_ctes("preds1") + "select ra, epi_sunday, cast(least(row_number() over (partition by ra order by epi_sunday), 4) as integer) as horizon from preds1",
)
def q_w5(spark, sf):
    return series.position_horizon(b.naive_predictions(spark, sf, 1), ["ra"], "epi_sunday").select("ra", "epi_sunday", "horizon")


@query("w6_interpolate", with_ctes("climate") + f"select epi_sunday, {s6('umidmed', 'umidmed')} from climate")
def q_w6(spark, sf):
    return rounded(b.climate(spark, sf).select("epi_sunday", "umidmed"), "umidmed")


@query(
    "w6_forward_fill",
    with_ctes("climends") + f"select epi_sunday, {s6('case when i0 is not null then v0 when i1 - i <= 4 then v1 end', 'umidmed')} from climends",
)
def q_w6_ffill(spark, sf):
    filled = series.interpolate(b.weekly_climate(spark, sf), ["station_id"], "epi_sunday", "umidmed", mode="ffill")
    return rounded(filled.select("epi_sunday", "umidmed"), "umidmed")


@query(
    "w7_pct_change",
    with_ctes("pop") + f"select ano, populacao, {s6('(populacao::double / lag(populacao) over (order by ano) - 1) * 100', 'populacao_pct_change')} from (select ano, cast(sum(populacao) as bigint) as populacao from pop group by ano)",
)
def q_w7(spark, sf):
    yearly = regions.population_by_year(b.population(spark, sf))
    return rounded(series.pct_change(yearly, [F.lit(0)], "ano", "populacao"), "populacao_pct_change")


@query(
    "w8_holdout_tail",
    with_ctes("leaves") + "select nation, ds, y, rn <= 52 as is_test from (select nation, ds, y, row_number() over (partition by nation order by ds desc) as rn from leaves)",
)
def q_w8(spark, sf):
    train, test = series.holdout_tail(b.hierarchy_leaves(spark, sf).select("nation", "ds", "y"), ["nation"], "ds", 52)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


CONFIG_LAGS = (1, 2, 4, 52)
CONFIG_PREDS = " union all ".join(
    f"select {i} as config_ord, 'lag{n}' as config, ra, epi_sunday, cases, p{n} as prediction from wide where p{n} is not null"
    for i, n in enumerate(CONFIG_LAGS)
)
CONFIGS = dict(
    wide="select * from (select ra, epi_sunday, cases, "
    + ", ".join(f"lag(cases, {n}) over (partition by ra order by epi_sunday) as p{n}" for n in CONFIG_LAGS)
    + " from grid) where year(epi_sunday) = 2000",
    cpreds=CONFIG_PREDS,
    tot="select config_ord, config, epi_sunday, sum(cases) as cases, sum(prediction) as prediction from cpreds group by all",
    gsc="select config_ord, config, 1 - sum(pow(cases - prediction, 2)) / (var_pop(cases) * count(*)) as r2, sqrt(avg(pow(cases - prediction, 2))) as rmse from tot group by all",
    reg="select config_ord, config, ra, sqrt(avg(pow(cases - prediction, 2))) as rmse_ra from cpreds group by all",
    delta="""select g.config, g.config_ord, g.r2, g.rmse, g.r2 - lag(g.r2) over (order by g.config_ord) as delta_r2,
      (select avg(cast(c.rmse_ra < p.rmse_ra as integer)) from reg c join reg p on p.ra = c.ra and p.config_ord = g.config_ord - 1 where c.config_ord = g.config_ord) as improved from gsc g""",
)


def config_predictions(spark, sf):
    w = series.ordered(["ra"], "epi_sunday")
    wide = b.grid(spark, sf).withColumns({f"lag{n}": F.lag("cases", n).over(w) for n in CONFIG_LAGS})
    year = wide.filter(F.year("epi_sunday") == b.TEST_YEAR)
    names = [f"lag{n}" for n in CONFIG_LAGS]
    long = year.unpivot(["ra", "epi_sunday", "cases"], names, "config", "prediction").filter("prediction is not null")
    order = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return long.select("*", order[F.col("config")].alias("config_ord"), F.lit("naive").alias("modelo"))


@query(
    "w9_config_delta",
    with_ctes("grid", **CONFIGS) + f"select config, {s6('r2', 'r2')}, {s6('delta_r2', 'delta_r2')}, {s6('improved', 'improved_share')}, coalesce(delta_r2 > 0.05 or improved > 0.70, false) as accepted from delta",
)
def q_w9(spark, sf):
    out = decisions.config_steps(config_predictions(spark, sf))
    return rounded(out.select("config", "r2", "delta_r2", "improved_share", "accepted"), "r2", "delta_r2", "improved_share")


@query(
    "j9_aligned_regions",
    with_ctes("grid", **CONFIGS) + f"select c.config, c.ra, {s6('c.rmse_ra', 'rmse_cur')}, {s6('p.rmse_ra', 'rmse_prev')}, c.rmse_ra < p.rmse_ra as improved from reg c join reg p on p.ra = c.ra and p.config_ord = c.config_ord - 1",
)
def q_j9(spark, sf):
    regional = region_metrics(config_predictions(spark, sf), "modelo", "config", "config_ord")
    out = decisions.aligned_regions(regional)
    return rounded(out.select("config", "ra", "rmse_cur", "rmse_prev", "improved"), "rmse_cur", "rmse_prev")


@query(
    "m9_winner_rule",
    with_ctes(
        "grid", **CONFIGS,
        best="select * from gsc order by r2 desc, config_ord limit 1",
        base="select * from gsc where config = 'lag1'",
        share="select avg(cast(c.rmse_ra < p.rmse_ra as integer)) as improved from reg c join reg p on p.ra = c.ra where c.config = (select config from best) and p.config = 'lag1'",
    )
    + f"""select case when ok then best_config else 'lag1' end as config, best_config, {s6('d', 'best_delta_r2')}, {s6('improved', 'best_improved_share')}, ok as accepted
      from (select best.config as best_config, best.r2 - base.r2 as d, improved, coalesce(best.r2 - base.r2 > 0.05 or improved > 0.70, false) as ok from best, base, share)""",
)
def q_m9_rule(spark, sf):
    out = decisions.winner(config_predictions(spark, sf), baseline="lag1")
    cols = ["config", "best_config", "best_delta_r2", "best_improved_share", "accepted"]
    return rounded(out.select(*cols), "best_delta_r2", "best_improved_share")


@query("k4_best_config", with_ctes("grid", **CONFIGS) + f"select config, {s6('r2', 'r2')} from gsc order by r2 desc, config_ord limit 1")
def q_k4(spark, sf):
    scored = decisions.config_scores(config_predictions(spark, sf))
    return rounded(scored.orderBy(F.desc("r2"), "config_ord").limit(1).select("config", "r2"), "r2")


@query(
    "k4_worst_region",
    with_ctes("grid", **CONFIGS) + f"select config, ra, {s6('rmse_ra', 'rmse_ra')} from (select *, row_number() over (partition by config order by rmse_ra desc, ra) as rn from reg) where rn = 1",
)
def q_k4_region(spark, sf):
    regional = region_metrics(config_predictions(spark, sf), "config").select("config", "ra", "rmse_ra")
    return rounded(series.best_row(regional, ["config"], -F.col("rmse_ra"), F.col("ra")), "rmse_ra")


@query("k5_tuning_order", with_ctes("grid", **CONFIGS) + f"select config, {s6('rmse', 'cv_rmse')} from gsc order by rmse, config_ord")
def q_k5(spark, sf):
    scored = decisions.config_scores(config_predictions(spark, sf))
    return scored.select("config", r6("rmse").alias("cv_rmse"), "config_ord").orderBy("cv_rmse", "config_ord").drop("config_ord")


@query(
    "w10_best_per_group",
    """select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn = 1""",
)
def q_w10(spark, sf):
    rows = b.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return series.best_row(rows, ["o_custkey"], -F.col("o_totalprice"), F.col("o_orderkey"))


LAST26 = "(select distinct epi_sunday from grid order by 1 desc limit 26)"


@query("w11_last_weeks", with_ctes("grid") + f"select ra, epi_sunday, cases from grid where epi_sunday in {LAST26}")
def q_w11(spark, sf):
    return splits.last_weeks(b.grid(spark, sf), 26).select("ra", "epi_sunday", "cases")


@query("j11_semi_anti_dates", with_ctes("grid") + f"select ra, epi_sunday, cases from grid where epi_sunday not in {LAST26}")
def q_j11(spark, sf):
    grid = b.grid(spark, sf)
    recent = splits.last_weeks(grid, 26).select("epi_sunday").distinct()
    return grid.join(recent, "epi_sunday", "left_anti").select("ra", "epi_sunday", "cases")


FOLDS = dict(
    tr="select * from grid where epi_sunday < date '2000-01-01'",
    d="select epi_sunday, row_number() over (order by epi_sunday) - 1 as idx, count(*) over () as n from (select distinct epi_sunday from tr)",
    f="select epi_sunday, idx, n, fold, n // 6 as t, n - (6 - fold) * (n // 6) as start from d, (select unnest(range(1, 6)) as fold)",
    member="""select epi_sunday, cast(fold as integer) as fold, case when idx >= start and idx < start + t then 'validation' when idx < start - 4 then 'train' end as role from f
      where (idx >= start and idx < start + t) or idx < start - 4""",
)


@query(
    "w12_folds",
    with_ctes("grid", **FOLDS) + "select fold, role, min(epi_sunday) as first_week, max(epi_sunday) as last_week, count(*) as n_weeks from member group by all",
)
def q_w12(spark, sf):
    train, _ = splits.year_split(b.grid(spark, sf), b.TEST_YEAR)
    return splits.fold_bounds(train)


@query("j13_fold_rows", with_ctes("grid", **FOLDS) + "select fold, role, ra, epi_sunday, cases from tr join member using (epi_sunday)")
def q_j13(spark, sf):
    train, _ = splits.year_split(b.grid(spark, sf), b.TEST_YEAR)
    return train.join(splits.expanding_folds(train), "epi_sunday").select("fold", "role", "ra", "epi_sunday", "cases")


@query(
    "w13_first_row_per_key",
    "select o_custkey, cast(o_orderdate as date) as day, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders) where rn = 1",
)
def q_w13(spark, sf):
    rows = b.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return series.best_row(rows, ["o_custkey"], F.col("day"), F.col("o_orderkey"))


GLOBAL_LAGS = (1, 4, 8, 13, 26, 52)


@query(
    "w14_series_lags",
    with_ctes("leaves") + "select nation, ds, y, " + ", ".join(f"lag(y, {n}) over (partition by nation order by ds) as y_lag_{n}" for n in GLOBAL_LAGS) + " from leaves",
)
def q_w14(spark, sf):
    leaves = b.hierarchy_leaves(spark, sf).select("nation", "ds", "y")
    return series.add_lags(leaves, ["nation"], "ds", ["y"], GLOBAL_LAGS)


@query("w15_projection", with_ctes("pop") + "select ra, ano, populacao from pop")
def q_w15(spark, sf):
    return b.population(spark, sf)


@query(
    "e2_cv_rmse",
    with_ctes("grid", **FOLDS, p="select epi_sunday, ra, cases, lag(cases, 1) over (partition by ra order by epi_sunday) as prediction from grid")
    + f"select fold, {s6('sqrt(avg(pow(cases - prediction, 2)))', 'rmse')} from p join member using (epi_sunday) where role = 'validation' and prediction is not null group by fold",
)
def q_cv_rmse(spark, sf):
    w = series.ordered(["ra"], "epi_sunday")
    preds = b.grid(spark, sf).withColumn("prediction", F.lag("cases", 1).over(w))
    train, _ = splits.year_split(preds, b.TEST_YEAR)
    held = splits.expanding_folds(train).filter("role = 'validation'")
    return train.join(held, "epi_sunday").filter("prediction is not null").groupBy("fold").agg(r6(rmse()).alias("rmse"))
