"""Drift, diagnostics, alerts and filters on the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.catalog.scores import _banded
from epipanel.functions import scalars
from epipanel.functions.calendar import fourier_terms
from epipanel.operators import diagnostics, drift, filters, ranks, series
from epipanel.plans import bindings as b

SPLIT = "2000-01-01"


def _current(day="l_shipdate"):
    return F.col(day) >= F.lit(SPLIT).cast("timestamp_ntz")


PSI = {
    f: f"""select '{f}' as feature, sum((c + 1e-8 - r - 1e-8) * ln((c + 1e-8) / (r + 1e-8))) as psi from (
      select s.k, count(i.cur) filter (i.cur = 1)::double / max(nc) as c, count(i.cur) filter (i.cur = 0)::double / max(nr) as r
      from (select unnest(range(1, 11)) as k) s cross join (select count_if(cur = 1) as nc, count_if(cur = 0) as nr from li) z
      left join (select l.cur, case when v = list_extract(e, 11) then 10 else len(list_filter(e, lambda x: x <= v)) end as k
        from (select cur, {f} as v from li) l cross join (select quantile_cont({f}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as e from li where cur = 0) q
        where v >= list_extract(e, 1) and v <= list_extract(e, 11)) i on i.k = s.k group by s.k)"""
    for f in ("l_quantity", "l_extendedprice")
}


@query(
    "d1_stability_index",
    "with li as (select *, cast(l_shipdate >= timestamp '2000-01-01' as integer) as cur from lineitem), p as ("
    + " union all ".join(PSI.values()) + f") select feature, {s6('psi', 'psi')}, psi > 0.2 as alert from p",
)
def q_d1(spark, sf):
    out = drift.stability_index(b.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], _current())
    return rounded(out, "psi")


@query(
    "d2_recent_coverage",
    with_ctes("band52") + f"""select {s6('c', 'coverage')}, c < 0.85 as alert from (select avg(cast(cases >= lower_ci and cases <= upper_ci as integer)) as c from band52
      where epi_sunday in (select distinct epi_sunday from band52 order by 1 desc limit 12))""",
)
def q_d2(spark, sf):
    return rounded(drift.recent_coverage(_banded(spark, sf), 12), "coverage")


@query(
    "d3_ks_distance",
    f"""with v as (select l_extendedprice as x, cast(l_shipdate >= timestamp '2000-01-01' as integer) as cur from lineitem),
      d as (select x, count_if(cur = 1) as b, count_if(cur = 0) as a from v group by x),
      r as (select sum(a) over (order by x)::double / (select count_if(cur = 0) from v) as fa, sum(b) over (order by x)::double / (select count_if(cur = 1) from v) as fb from d)
      select {s6('max(abs(fa - fb))', 'ks')} from r""",
)
def q_d3(spark, sf):
    return rounded(ranks.ks_distance(b.table(spark, sf, "lineitem"), [], "l_extendedprice", _current()), "ks")


define("bench", """select ra, epi_sunday, cases, lag(cases) over w as naive, lag(cases, 52) over w as seasonal_naive,
    avg(cases) over (w rows between unbounded preceding and 1 preceding) as mean,
    lag(cases) over w + (lag(cases) over w - first_value(cases) over w) / nullif(row_number() over w - 2, 0) as drift0, row_number() over w as rn
    from grid window w as (partition by ra order by epi_sunday)""", "grid")


@query(
    "d4_benchmark_forecasts",
    with_ctes("bench") + f"select ra, epi_sunday, naive, seasonal_naive, {s6('mean', 'mean')}, {s6('case when rn > 2 then drift0 end', 'drift')} from bench",
)
def q_d4(spark, sf):
    out = diagnostics.benchmark_forecasts(b.grid(spark, sf), ["ra"], "epi_sunday", "cases")
    return rounded(out.select("ra", "epi_sunday", "naive", "seasonal_naive", "mean", "drift"), "mean", "drift")


@query(
    "d5_mase",
    with_ctes("bench", e="select ra, cases, abs(cases - naive) as e, abs(cases - seasonal_naive) as s from bench where naive is not null and seasonal_naive is not null",
              q="select ra, quantile_cont(cases, 0.75) as cut from grid group by ra")
    + f"""select ra, {s6('avg(e) / nullif(avg(s), 0)', 'mase')}, {s6('avg(case when cases > cut then e end) / nullif(avg(s), 0)', 'mase_high')},
      {s6('avg(case when cases <= cut then e end) / nullif(avg(s), 0)', 'mase_low')} from e join q using (ra) group by ra""",
)
def q_d5(spark, sf):
    preds = b.grid(spark, sf).withColumn("prediction", F.lag("cases").over(series.ordered(["ra"], "epi_sunday")))
    return rounded(diagnostics.mase(preds, ["ra"], "epi_sunday", "cases", "prediction"), "mase", "mase_high", "mase_low")


def _pinball(col: str, q: float) -> str:
    return f"greatest((cases - {col}) * {q}::double, (cases - {col}) * ({q}::double - 1))"


PINBALL = " + ".join(_pinball(c, q) for c, q in (("lower_ci", 0.05), ("prediction", 0.5), ("upper_ci", 0.95)))


@query("d6_quantile_score", with_ctes("band52") + f"select ra, {s6(f'avg(2 * ({PINBALL}) / 3)', 'quantile_score')} from band52 group by ra")
def q_d6(spark, sf):
    preds = _banded(spark, sf)
    score = diagnostics.quantile_score(preds, "cases", {0.05: "lower_ci", 0.5: "prediction", 0.95: "upper_ci"})
    return preds.groupBy("ra").agg(r6(score).alias("quantile_score"))


ACF = dict(
    z="select ra, epi_sunday, cases - avg(cases) over (partition by ra) as z, row_number() over (partition by ra order by epi_sunday) as i, count(*) over (partition by ra) as n from grid",
    acf="""select a.ra, max(a.n) as n, k.lag, sum(a.z * c.z) / max(s.ss) as acf from z a cross join (select unnest(range(0, 105)) as lag) k
      join z c on c.ra = a.ra and c.i = a.i - k.lag join (select ra, sum(z * z) as ss from z group by ra) s on s.ra = a.ra group by a.ra, k.lag""",
)


@query("d7_autocorrelation", with_ctes("grid", **ACF) + f"select ra, n, cast(lag as integer) as lag, {s6('acf', 'acf')} from acf")
def q_d7(spark, sf):
    return rounded(diagnostics.autocorrelation(b.grid(spark, sf), ["ra"], "epi_sunday", "cases", 104), "acf")


@query(
    "d7_ljung_box",
    with_ctes("grid", **ACF) + f"select ra, cast(max(lag) as integer) as lags, {s6('max(n) * (max(n) + 2)::double * sum(acf * acf / (n - lag))', 'q')} from acf where lag between 1 and 52 group by ra",
)
def q_d7_lb(spark, sf):
    acf = diagnostics.autocorrelation(b.grid(spark, sf), ["ra"], "epi_sunday", "cases", 52)
    return rounded(diagnostics.ljung_box(acf, ["ra"]).select("ra", "lags", "q"), "q")


@query(
    "d8_cross_correlation",
    with_ctes("grid", "climate", j="select g.ra, g.epi_sunday, cases, precip_sum from grid g join climate c on c.epi_sunday = g.epi_sunday",
              z="select ra, row_number() over (partition by ra order by epi_sunday) as i, cases - avg(cases) over (partition by ra) as y, precip_sum - avg(precip_sum) over (partition by ra) as x from j",
              s="select ra, sqrt(sum(x * x) * sum(y * y)) as sc from z group by ra")
    + f"""select a.ra, cast(k.lag as integer) as lag, {s6('sum(a.y * c.x) / nullif(max(s.sc), 0)', 'ccf')} from z a cross join (select unnest(range(0, 13)) as lag) k
      join z c on c.ra = a.ra and c.i = a.i - k.lag join s on s.ra = a.ra group by a.ra, k.lag""",
)
def q_d8(spark, sf):
    joined = b.grid(spark, sf).join(b.climate(spark, sf).select("epi_sunday", "precip_sum"), "epi_sunday")
    out = diagnostics.cross_correlation(joined, ["ra"], "epi_sunday", "precip_sum", "cases", 12)
    return rounded(out.select("ra", "lag", "ccf"), "ccf")


@query(
    "d9_differencing",
    with_ctes("grid") + """select ra, epi_sunday, cases - lag(cases) over w as cases_diff_1, cases - lag(cases, 52) over w as cases_diff_52
      from grid window w as (partition by ra order by epi_sunday)""",
)
def q_d9(spark, sf):
    once = series.differenced(b.grid(spark, sf), ["ra"], "epi_sunday", "cases", 1)
    return series.differenced(once, ["ra"], "epi_sunday", "cases", 52).drop("cases")


@query(
    "d10_box_cox_fourier",
    with_ctes("grid") + f"""select ra, epi_sunday, {s6('(pow(cases + 1, 0.3::double) - 1) / 0.3::double', 'transformed')}, {s6('pow((pow(cases + 1, 0.3::double) - 1) / 0.3::double * 0.3::double + 1, 1 / 0.3::double)', 'back')}, {s6('ln(cases + 1)', 'logged')}, """
    + ", ".join(f"{s6(f'sin(2 * pi() * {k} / 52.0::double * week(epi_sunday))', f'sin_{k}')}, {s6(f'cos(2 * pi() * {k} / 52.0::double * week(epi_sunday))', f'cos_{k}')}" for k in range(1, 7))
    + " from grid",
)
def q_d10(spark, sf):
    shifted = F.col("cases") + 1.0
    terms = fourier_terms(F.weekofyear("epi_sunday"), 52.0, 6)
    return b.grid(spark, sf).select(
        "ra", "epi_sunday", r6(scalars.box_cox(shifted, 0.3)).alias("transformed"),
        r6(scalars.box_cox_inverse(scalars.box_cox(shifted, 0.3), 0.3)).alias("back"), r6(scalars.box_cox(shifted, 0)).alias("logged"),
        *[r6(c).alias(n) for n, c in terms.items()],
    )


@query(
    "d11_count_profile",
    with_ctes("grid") + f"""select ra, {s6('m', 'mean_level')}, {s6('d', 'dispersion')}, {s6('z', 'zero_share')}, case when z > 0.2 and m >= 10 then 'hurdle_negative_binomial' when z > 0.2 then 'zero_inflated'
        when m > 50 and d > 1 then 'log_gaussian' when d > 1.5 then 'negative_binomial' else 'poisson' end as family
      from (select ra, avg(cases) as m, var_samp(cases) / nullif(avg(cases), 0) as d, avg(cast(cases = 0 as integer)) as z from grid group by ra)""",
)
def q_d11(spark, sf):
    return rounded(diagnostics.count_profile(b.grid(spark, sf), ["ra"], "cases"), "mean_level", "dispersion", "zero_share")


PROFILE = dict(
    prof="select ra, week(epi_sunday) as w, avg(cases) as profile from grid group by all",
    res="select g.ra, epi_sunday, cases, cases - profile as residual from grid g join prof p on p.ra = g.ra and p.w = week(epi_sunday)",
    cuts="select ra, quantile_cont(residual, 0.25) as q1, quantile_cont(residual, 0.75) as q3 from res group by ra",
)


@query("d12_seasonal_profile", with_ctes("grid", **PROFILE) + f"select ra, cast(w as integer) as week_of_year, {s6('profile', 'profile')} from prof")
def q_d12(spark, sf):
    return rounded(diagnostics.seasonal_profile(b.grid(spark, sf), ["ra"], "epi_sunday", "cases"), "profile")


@query(
    "d12_seasonal_outliers",
    with_ctes("grid", **PROFILE) + f"select ra, epi_sunday, cases, {s6('residual', 'residual')} from res join cuts using (ra) where abs(residual) > 3 * (q3 - q1)",
)
def q_d12_outliers(spark, sf):
    out = diagnostics.seasonal_outliers(b.grid(spark, sf), ["ra"], "epi_sunday", "cases")
    return rounded(out.select("ra", "epi_sunday", "cases", "residual"), "residual")


@query(
    "d13_delay_correction",
    with_ctes("grid") + f"""select ra, epi_sunday, cases, {s6('cases / case rk when 1 then 0.4::double when 2 then 0.7::double when 3 then 0.85::double when 4 then 0.95::double else 1.0::double end', 'corrected')}
      from (select *, row_number() over (partition by ra order by epi_sunday desc) as rk from grid)""",
)
def q_d13(spark, sf):
    out = drift.delay_correction(b.grid(spark, sf), ["ra"], "epi_sunday", {1: 0.4, 2: 0.7, 3: 0.85, 4: 0.95})
    return rounded(out.select("ra", "epi_sunday", "cases", "corrected"), "corrected")


@query(
    "d14_alert_levels",
    with_ctes("grid", q="select ra, quantile_cont(cases, 0.75) as p75, quantile_cont(cases, 0.90) as p90, quantile_cont(cases, 0.95) as p95 from grid where epi_sunday < date '2000-01-01' group by ra")
    + "select ra, epi_sunday, cases, cast(case when cases >= p95 then 3 when cases >= p90 then 2 when cases >= p75 then 1 else 0 end as integer) as alert_level from grid join q using (ra) where epi_sunday >= date '2000-01-01'",
)
def q_d14(spark, sf):
    grid = b.grid(spark, sf)
    cut = F.lit(SPLIT).cast("date")
    out = drift.alert_levels(grid.filter(F.col("epi_sunday") >= cut), grid.filter(F.col("epi_sunday") < cut), ["ra"])
    return out.select("ra", "epi_sunday", "cases", "alert_level")


ENS = "select ra, epi_sunday, cases, lag(cases) over w as a, lag(cases, 52) over w as c from grid window w as (partition by ra order by epi_sunday)"


@query(
    "d14_weighted_ensemble",
    with_ctes("grid", p=f"select * from ({ENS}) where year(epi_sunday) = 2000 and a is not null and c is not null", e="select ra, avg(abs(cases - a)) as ea, avg(abs(cases - c)) as ec from p group by ra")
    + f"select ra, epi_sunday, {s6('(a + c) / 2', 'equal')}, {s6('(a / nullif(ea, 0) + c / nullif(ec, 0)) / (1 / nullif(ea, 0) + 1 / nullif(ec, 0))', 'weighted')} from p join e using (ra)",
)
def q_d14_ensemble(spark, sf):
    w = series.ordered(["ra"], "epi_sunday")
    preds = b.grid(spark, sf).withColumns({"a": F.lag("cases", 1).over(w), "c": F.lag("cases", 52).over(w)})
    year = preds.filter((F.year("epi_sunday") == b.TEST_YEAR) & F.col("a").isNotNull() & F.col("c").isNotNull())
    errors = year.groupBy("ra").agg(*[F.avg(F.abs(F.col("cases") - F.col(m))).alias(f"{m}_err") for m in ("a", "c")])
    models = {"a": None, "c": None}
    equal = diagnostics.weighted_ensemble(year, ["ra"], models).withColumnRenamed("ensemble", "equal")
    both = diagnostics.weighted_ensemble(equal, ["ra"], models, errors)
    return both.select("ra", "epi_sunday", r6("equal").alias("equal"), r6("ensemble").alias("weighted"))


@query(
    "d14_intervention_dummies",
    with_ctes("grid") + """select ra, epi_sunday, cast(epi_sunday >= date '1998-06-01' as integer) as campaign,
      cast(epi_sunday >= date '1999-01-01' and epi_sunday <= date '1999-03-31' as integer) as spraying from grid""",
)
def q_d14_dummies(spark, sf):
    cols = drift.intervention_dummies("epi_sunday", {"campaign": ("1998-06-01", None), "spraying": ("1999-01-01", "1999-03-31")})
    return b.grid(spark, sf).select("ra", "epi_sunday", *[c.alias(n) for n, c in cols.items()])


@query(
    "d17_rolling_origin",
    with_ctes("grid", t="select *, row_number() over (partition by ra order by epi_sunday) as t from grid",
              f="""select o.ra, h.h, f.cases as y, o.cases as naive, s.cases as snaive from t o cross join (select unnest(range(1, 5)) as h) h
              join t f on f.ra = o.ra and f.t = o.t + h.h join t s on s.ra = o.ra and s.t = o.t + h.h - 52 where o.t >= 156""")
    + f"""select ra, cast(h as integer) as h, count(*) as n, {s6('avg(abs(y - naive))', 'mae_naive')}, {s6('sqrt(avg(pow(y - naive, 2)))', 'rmse_naive')},
      {s6('avg(abs(y - snaive))', 'mae_snaive')}, {s6('sqrt(avg(pow(y - snaive, 2)))', 'rmse_snaive')} from f group by ra, h""",
)
def q_d17(spark, sf):
    out = diagnostics.rolling_origin_errors(b.grid(spark, sf), ["ra"], "epi_sunday", "cases", 156)
    return rounded(out, "mae_naive", "rmse_naive", "mae_snaive", "rmse_snaive")


@query(
    "d18_consecutive_weeks",
    with_ctes("grid", h="select *, datediff('day', date '1970-01-04', epi_sunday) // 7 - row_number() over (partition by ra order by epi_sunday) as g from grid where cases >= 1",
              r="select ra, epi_sunday, count(*) over (partition by ra, g) as n from h")
    + "select g.ra, g.epi_sunday, g.cases, coalesce(r.n >= 3, false) as in_run from grid g left join r on r.ra = g.ra and r.epi_sunday = g.epi_sunday",
)
def q_d18(spark, sf):
    out = series.runs_of(b.grid(spark, sf), ["ra"], "epi_sunday", F.col("cases") >= 1, 3)
    return out.select("ra", "epi_sunday", "cases", "in_run")


def _series(spark, sf):
    return b.grid(spark, sf).select(F.col("ra").alias("unique_id"), F.col("epi_sunday").alias("ds"), F.col("cases").alias("y"))


def _log_series(spark, sf):
    return _series(spark, sf).withColumn("y", F.log1p("y"))


def _recursive(result: str, *parts: str, y: str = "ln(1 + cases)", x: str = "") -> str:
    """``with recursive`` over the dense grid: ``s`` holds numbered series."""
    source = "grid left join climate using (epi_sunday)" if x else "grid"
    numbered = f"s as (select ra, epi_sunday, {y} as y{x and f', {x} as x'}, row_number() over (partition by ra order by epi_sunday) as i from {source})"
    names = with_ctes("grid", "climate") if x else with_ctes("grid")
    return names.rstrip().replace("with ", "with recursive ", 1) + ",\n" + ",\n".join([numbered, *parts]) + result


#: Local level: prior 1, 1; observation variance 0.25, evolution variance 0.04.
LEVEL = (
    """f as (select ra, 0::bigint as i, 0.0::double as f, 0.0::double as r, 0.0::double as q, 1.0::double as m, 1.0::double as c from s where i = 1 union all
        select ra, i, a, r, q, a + gain * (y - a), r - pow(gain, 2) * q from (
          select *, r + 0.25::double as q, r / (r + 0.25::double) as gain from (
            select s.ra, s.i, s.y, f.m as a, f.c + 0.04::double as r from f join s on s.ra = f.ra and s.i = f.i + 1)))""",
    """g as (select f.ra, f.i, f.m as sm, f.c as sv from f join (select ra, max(i) as n from f group by ra) l on l.ra = f.ra and l.n = f.i union all
        select f.ra, f.i, f.m + f.c / n.r * (g.sm - n.f), f.c + pow(f.c / n.r, 2) * (g.sv - n.r)
        from g join f n on n.ra = g.ra and n.i = g.i join f on f.ra = g.ra and f.i = g.i - 1 where f.i >= 1)""",
)
MOMENTS = {"forecast": "f.f", "forecast_var": "f.q", "level": "f.m", "level_var": "f.c", "smoothed": "g.sm", "smoothed_var": "g.sv"}


def _out(columns: dict[str, str]) -> str:
    return ", ".join(s6(sql, name) for name, sql in columns.items())


@query(
    "d15_local_level",
    _recursive(f" select s.ra as unique_id, s.epi_sunday as ds, {_out({'y': 's.y', **MOMENTS})} from s join f on f.ra = s.ra and f.i = s.i join g on g.ra = s.ra and g.i = s.i", *LEVEL),
)
def q_d15_level(spark, sf):
    return rounded(filters.local_level(_log_series(spark, sf), m0=1.0), "y", *MOMENTS)


def _states_sql() -> str:
    """Five states by the update equations, every matrix entry a column."""
    w = "(2 * pi() / 52.0::double)"
    g = [["1", "1", "", "", ""], ["", "1", "", "", ""], ["", "", f"cos({w})", f"sin({w})", ""], ["", "", f"(-sin({w}))", f"cos({w})", ""], ["", "", "", "", "1"]]
    n, block, discount = range(5), (0, 0, 1, 1, 2), ("0.95::double", "0.995::double", "0.98::double")
    prior = [" + ".join(f"{g[i][k]} * m{k}" for k in n if g[i][k]) + f" as a{i}" for i in n]
    for i in n:
        for j in n:
            moved = " + ".join(f"{g[i][k]} * c{k}{m} * {g[j][m]}" for k in n for m in n if g[i][k] and g[j][m])
            prior.append((f"({moved}) / {discount[block[i]]}" if block[i] == block[j] else moved) + f" as r{i}{j}")
    onto = ", ".join(f"r{i}0 + r{i}2 + x * r{i}4 as o{i}" for i in n)
    posterior = [f"a{i} + o{i} / qq * (y - ff)" for i in n] + [f"r{i}{j} - (o{i} / qq) * (o{j} / qq) * qq" for i in n for j in n]
    zero = [f"0.0::double as m{i}" for i in n] + [f"{float(i == j)}::double as c{i}{j}" for i in n for j in n]
    return f"""f as (select ra, 0::bigint as i, {', '.join(zero)}, 0.0::double as f, 0.0::double as q from s where i = 1 union all
        select ra, i, {', '.join(posterior)}, ff, qq from (
          select *, a0 + a2 + x * a4 as ff, o0 + o2 + x * o4 + 0.25::double as qq from (
            select *, {onto} from (
              select s.ra, s.i, s.y, s.x, {', '.join(prior)} from f join s on s.ra = f.ra and s.i = f.i + 1))))"""


STATES = {"forecast": "f.f", "forecast_var": "f.q", "level": "f.m0", "slope": "f.m1", "season": "f.m2", "effect": "f.m4"}


@query(
    "d15_trend_season_climate",
    _recursive(
        f" select s.ra as unique_id, s.epi_sunday as ds, {_out({'y': 's.y', 'temp_mean': 's.x', **STATES})} from s join f on f.ra = s.ra and f.i = s.i",
        _states_sql(),
        x="coalesce(temp_mean, 0.0::double)",
    ),
)
def q_d15_states(spark, sf):
    wet = b.climate(spark, sf).select(F.col("epi_sunday").alias("ds"), F.col("temp_mean"))
    series_ = _log_series(spark, sf).join(wet, "ds", "left").withColumn("temp_mean", F.coalesce("temp_mean", F.lit(0.0)))
    return rounded(filters.trend_season_climate(series_, "temp_mean"), "y", "temp_mean", *STATES)


def _digamma_sql(x: str) -> str:
    z = f"({x} + 12)"
    return "(" + "".join(f"-1 / ({x} + {k}) " for k in range(12)) + f"+ ln({z}) - 1 / (2 * {z}) - 1 / (12 * pow({z}, 2)) + 1 / (120 * pow({z}, 4)) - 1 / (252 * pow({z}, 6)) + 1 / (240 * pow({z}, 8)))"


def _trigamma_sql(x: str) -> str:
    z = f"({x} + 12)"
    return "(" + "".join(f"1 / pow({x} + {k}, 2) + " for k in range(12)) + f"1 / {z} + 1 / (2 * pow({z}, 2)) + 1 / (6 * pow({z}, 3)) - 1 / (30 * pow({z}, 5)) + 1 / (42 * pow({z}, 7)) - 1 / (30 * pow({z}, 9)))"


#: Log rate: prior -0.7, 0.5; discount 0.95.
POISSON = f"""f as (select ra, 0::bigint as i, 0.0::double as e, -0.7::double as m, 0.5::double as c, 0.0::double as rate from s where i = 1 union all
    select ra, i, mu, {_digamma_sql('shape')} - ln(beta + 1), {_trigamma_sql('shape')}, shape / (beta + 1) from (
      select *, mu * beta + y as shape from (
        select *, mu / (exp(2 * a + r) * (exp(r) - 1) + 1e-9::double) as beta from (
          select *, exp(a + r / 2) as mu from (
            select s.ra, s.i, s.y, f.m as a, f.c / 0.95::double as r from f join s on s.ra = f.ra and s.i = f.i + 1)))))"""
RATES = {"expected": "f.e", "log_rate": "f.m", "log_rate_var": "f.c", "rate": "f.rate", "low": "least(exp(f.m - 1.96::double * sqrt(f.c)), 1e6)", "high": "least(exp(f.m + 1.96::double * sqrt(f.c)), 1e6)"}


@query(
    "d15_poisson_filter",
    _recursive(f" select s.ra as unique_id, s.epi_sunday as ds, s.y, {_out(RATES)} from s join f on f.ra = s.ra and f.i = s.i", POISSON, y="1 + cases"),
)
def q_d15_poisson(spark, sf):
    counts = _series(spark, sf).withColumn("y", F.col("y") + 1.0)  # empty weeks in a row would send the log rate to minus infinity
    out = filters.poisson_filter(counts, m0=-0.7, c0=0.5, discount=0.95)
    limits = {c: F.least(F.col(c), F.lit(1e6)) for c in ("low", "high")}  # beyond, only the leading digits mean anything
    return rounded(out.withColumns(limits), *RATES)


def density_sql(y: str, mean: str, var: str) -> str:
    return f"(exp(-pow({y} - {mean}, 2) / (2 * {var})) / sqrt(2 * pi() * {var}))"


#: Alarm threshold 0.05, variance doubled in the alternative, new start above 1.5.
ALARM = (
    f"h as (select s.ra, s.i, {density_sql('s.y', 'f.f', 'f.q')} / ({density_sql('s.y', 'f.f', '(2 * f.q)')} + 1e-12::double) as bf from s join f on f.ra = s.ra and f.i = s.i)",
    """l as (select ra, 0::bigint as i, 1.0::double as bf, 1.0::double as l, false as alarm from s where i = 1 union all
        select h.ra, h.i, h.bf, case when l.l * h.bf < 0.05 or l.l * h.bf > 1.5 then 1.0::double else l.l * h.bf end, l.l * h.bf < 0.05
        from l join h on h.ra = l.ra and h.i = l.i + 1)""",
)
JUDGED = {"forecast": "f.f", "forecast_var": "f.q", "residual": "(s.y - f.f) / sqrt(f.q)", "factor": "l.bf", "cumulative": "l.l"}


@query(
    "d15_alarm_monitor",
    _recursive(
        f" select s.ra as unique_id, s.epi_sunday as ds, {_out({'y': 's.y', **JUDGED})}, l.alarm from s join f on f.ra = s.ra and f.i = s.i join l on l.ra = s.ra and l.i = s.i",
        LEVEL[0],
        *ALARM,
    ),
)
def q_d15_alarm(spark, sf):
    forecasts = filters.local_level(_log_series(spark, sf), m0=1.0).select("unique_id", "ds", "y", "forecast", "forecast_var")
    return rounded(filters.alarm_monitor(forecasts), "y", *JUDGED)
