"""Per-series forecasts on the hierarchy nodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.hierarchies import nodes
from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.operators import perseries, series

H = 52
OFF = 1e-8
define("train", "select * exclude (rn) from (select *, row_number() over (partition by unique_id order by ds desc) as rn from nodes) where rn > 52", "nodes")
define("snaive", """select unique_id, ds + 364 as ds, cast(53 - rn as integer) as h, y as seasonal_naive from
    (select *, row_number() over (partition by unique_id order by ds desc) as rn from train) where rn <= 52""", "train")


def _split(spark, sf):
    return series.holdout_tail(nodes(spark, sf), ["unique_id"], "ds", H)


@query("m13_seasonal_naive", with_ctes("snaive") + "select unique_id, ds, h, seasonal_naive from snaive")
def q_m13_snaive(spark, sf):
    return perseries.seasonal_naive(_split(spark, sf)[0], H)


@query(
    "m13_drift",
    with_ctes("train") + f"""select unique_id, d + cast(h * 7 as integer) as ds, cast(h as integer) as h, {s6('yn + (yn - y1) / (n - 1) * h', 'drift')} from
      (select unique_id, arg_min(y, ds) as y1, arg_max(y, ds) as yn, max(ds) as d, count(*) as n from train group by 1) cross join (select unnest(range(1, 53)) as h)""",
)
def q_m13_drift(spark, sf):
    return rounded(perseries.drift(_split(spark, sf)[0], H), "drift")


def _recursive(*names: str, **local: str) -> str:
    """``with recursive`` whose shared fragments are computed once."""
    text = with_ctes(*names, **local).replace("with ", "with recursive ", 1)
    for name in ("grid", "nodes", "train", "numbered", "lined"):
        text = text.replace(f"\n{name} as (", f"\n{name} as materialized (")
    return text


define("numbered", "select unique_id, ds, y, row_number() over (partition by unique_id order by ds) as i, count(*) over (partition by unique_id) as n from train", "train")
define("lined", """select s.*, level + slope * (i - 1) as line, 2 * y - (level + slope * (i - 1)) as z, level, slope from numbered s join
    (select unique_id, coalesce(regr_slope(y, i - 1), 0) as slope, avg(y) - coalesce(regr_slope(y, i - 1), 0) * avg(i - 1) as level from numbered group by 1) using (unique_id)""", "numbered")


def _ses_sql(value: str, out: str) -> dict[str, str]:
    """One-step fits for every alpha, and those of the best: ``<out>`` has a row more than the series."""
    return {
        f"{out}_all": f"""select unique_id, a, 1::bigint as i, {value}::double as fit, 0.0::double as e from lined cross join (select unnest([0.1, 0.3, 0.5, 0.7, 0.9])::double as a) where i = 1 union all
          select s.unique_id, f.a, f.i + 1, f.a * s.{value} + (1 - f.a) * f.fit, f.e + pow(s.{value} - f.fit, 2) from {out}_all f join lined s on s.unique_id = f.unique_id and s.i = f.i""",
        f"{out}_best": f"select unique_id, arg_min(a, (e, a)) as a from {out}_all f join (select unique_id, max(n) + 1 as i from lined group by 1) using (unique_id, i) group by 1",
        out: f"select unique_id, i, fit from {out}_all join {out}_best using (unique_id, a)",
    }


HOLT = {
    "holt_all": """select s.unique_id, a, b, 1::bigint as i, s.y::double as fit, s.y::double as l, coalesce(t.y - s.y, 0)::double as d, 0.0::double as e from lined s left join lined t on t.unique_id = s.unique_id and t.i = 2
        cross join (select unnest([0.1, 0.3, 0.5, 0.7, 0.9])::double as a) cross join (select unnest([0.05, 0.2])::double as b) where s.i = 1 union all
        select unique_id, a, b, i, fit, level2, b * (level2 - l) + (1 - b) * d, e from (
          select s.unique_id, f.a, f.b, s.i, f.l + f.d as fit, f.a * s.y + (1 - f.a) * (f.l + f.d) as level2, f.l, f.d, f.e + pow(s.y - f.l - f.d, 2) as e
          from holt_all f join lined s on s.unique_id = f.unique_id and s.i = f.i + 1)""",
    "holt_best": "select unique_id, arg_min(a, (e, a, b)) as a, arg_min(b, (e, a, b)) as b from holt_all f join (select unique_id, max(n) as i from lined group by 1) using (unique_id, i) group by 1",
    "holt": "select unique_id, i, fit, l, d from holt_all join holt_best using (unique_id, a, b)",
}


@query(
    "m13_smoothing",
    _recursive("lined", **_ses_sql("y", "ses"), **_ses_sql("z", "theta"), **HOLT, h="select unnest(range(1, 53)) as h",
               last="select l.*, s.fit as ses, t.fit as theta, o.l as hl, o.d as hd from lined l join ses s on s.unique_id = l.unique_id and s.i = n + 1 join theta t on t.unique_id = l.unique_id and t.i = n + 1 join holt o on o.unique_id = l.unique_id and o.i = n where l.i = n")
    + f"""select l.unique_id, l.ds, cast(l.i - n as integer) as h, {s6('s.fit + 1e-8::double', 'ses')}, {s6('o.fit + 1e-8::double', 'holt')}, {s6('(l.line + t.fit) / 2 + 1e-8::double', 'theta')} from lined l
      join ses s on s.unique_id = l.unique_id and s.i = l.i join theta t on t.unique_id = l.unique_id and t.i = l.i join holt o on o.unique_id = l.unique_id and o.i = l.i
      union all select unique_id, ds + cast(7 * h as integer), cast(h as integer), {s6('ses + 1e-8::double')}, {s6('hl + hd * h + 1e-8::double')}, {s6('(level + slope * (n + h - 1) + theta) / 2 + 1e-8::double')} from last cross join h""",
)
def q_m13_smoothing(spark, sf):
    names = ("ses", "holt", "theta")
    off = {c: F.col(c) + OFF for c in names}  # fits of counts are short decimals: off the ties of rounding
    return rounded(perseries.smoothing_forecasts(_split(spark, sf)[0], H).withColumns(off), *names)


WINTERS = {
    "params": "select unnest([0.2, 0.2, 0.5, 0.5])::double as a, unnest([0.1, 0.3, 0.1, 0.3])::double as g, unnest([1, 2, 3, 4]) as k",
    "lv": "select unique_id, avg(ln(1 + y)) as l from numbered where i <= 52 group by 1",
    "st": """select unique_id, l, list(ln(1 + y) - l order by i) || list_transform(range(0, cast(52 - count(*) as bigint)), lambda x: 0.0::double) as s
        from numbered join lv using (unique_id) where i <= 52 group by 1, 2""",
    "w": """select unique_id, k, a, g, 0::bigint as i, 0.0::double as e, l::double as l, 0.0::double as b, s from st cross join params union all
        select unique_id, k, a, g, i, e + pow(y - c - s0, 2), l2, 0.05::double * (l2 - l) + 0.95::double * 0.95::double * b, list_append(s[2:], g * (y - l2) + (1 - g) * s0) from (
          select *, a * (y - s0) + (1 - a) * c as l2 from (
            select w.unique_id, k, a, g, t.i, e, l, b, s, ln(1 + t.y) as y, s[1] as s0, l + 0.95::double * b as c from w join numbered t on t.unique_id = w.unique_id and t.i = w.i + 1))""",
    "fin": "select w.*, t.ds from w join numbered t on t.unique_id = w.unique_id and t.i = w.i where t.i = t.n qualify row_number() over (partition by w.unique_id order by e, k) = 1",
}


@query(
    "d21_holt_winters",
    _recursive("numbered", **WINTERS)
    + f"""select unique_id, ds + cast(7 * h as integer) as ds, cast(h as integer) as h,
      {s6('greatest(exp(l + b * 0.95::double * (1 - pow(0.95::double, h)) / 0.05::double + s[((h - 1) % 52) + 1]) - 1, 0)', 'holt_winters')} from fin cross join (select unnest(range(1, 53)) as h)""",
)
def q_d21(spark, sf):
    return rounded(perseries.holt_winters(_split(spark, sf)[0], H), "holt_winters")


@query(
    "j7_forecast_actuals",
    with_ctes(
        "leaves",
        nodes_="""select unnest([top, concat_ws('/', top, region), concat_ws('/', top, region, nation)]) as unique_id, ds, y from leaves""",
        summed="select unique_id, ds, sum(y) as y, row_number() over (partition by unique_id order by ds desc) as rn from nodes_ group by unique_id, ds",
    ).replace("\nsummed as (", "\nsummed as materialized (").replace("\ngrid as (", "\ngrid as materialized (")
    + "select a.unique_id, a.ds, b.y as seasonal_naive, a.y from summed a join summed b on b.unique_id = a.unique_id and b.rn = a.rn + 52 where a.rn <= 52",
)
def q_j7(spark, sf):
    train, test = _split(spark, sf)
    ahead = perseries.seasonal_naive(train, H).drop("h")
    return ahead.join(test.select("unique_id", "ds", "y"), ["unique_id", "ds"])
