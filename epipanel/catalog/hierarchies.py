"""Hierarchy aggregates and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.registry import define, query, r6, rounded, s6, with_ctes
from epipanel.operators import hierarchy, metrics, series
from epipanel.plans import bindings as b
from epipanel.session import reliable_checkpoint

define("nodes", """select concat_ws('/', top, region, nation) as unique_id, cast(case when grouping(region) = 1 then 1 when grouping(nation) = 1 then 2 else 3 end as integer) as level,
    case when grouping(region) = 1 then null when grouping(nation) = 1 then top else concat_ws('/', top, region) end as parent_id, ds, sum(y) as y
    from leaves group by grouping sets ((top, ds), (top, region, ds), (top, region, nation, ds))""", "leaves")
define("base", """select * from (select *, lag(y, 52) over (partition by unique_id order by ds) * (1 + 0.01::double * level) as yhat from nodes)
    where year(ds) = 2000 and yhat is not null""", "nodes")


def nodes(spark, sf):
    return hierarchy.aggregate_levels(b.hierarchy_leaves(spark, sf), ["top", "region", "nation"])


def base_forecasts(spark, sf):
    w = series.ordered(["unique_id"], "ds")
    hat = F.lag("y", 52).over(w) * (1 + 0.01 * F.col("level"))
    ahead = nodes(spark, sf).withColumn("yhat", hat)
    return ahead.filter((F.year("ds") == b.TEST_YEAR) & F.col("yhat").isNotNull())


@query("a9_hierarchy", with_ctes("nodes") + "select unique_id, level, parent_id, ds, y from nodes")
def q_a9(spark, sf):
    return nodes(spark, sf).drop("ancestors")


define("slashed", """select coalesce(replace(region, '/', chr(92) || '/'), 'NOT GIVEN') as region, replace(nation, '/', chr(92) || '/') as nation, top, ds, y from (
    select 'ALL' as top, case when n_nationkey % 6 = 5 then null else r_name end as region,
      case when n_nationkey % 5 = 0 then r_name else r_name || '/' || n_name end as nation, epi_sunday as ds, cases as y
    from grid join nation on n_name = ra join region on r_regionkey = n_regionkey)""", "grid")


@query(
    "m15_names_with_separator",
    with_ctes("slashed") + """select concat_ws('/', top, region, nation) as unique_id, cast(case when grouping(region) = 1 then 1 when grouping(nation) = 1 then 2 else 3 end as integer) as level,
      ds, sum(y) as rec from slashed group by grouping sets ((top, ds), (top, region, ds), (top, region, nation, ds))""",
)
def q_m15_names(spark, sf):
    """Bottom-up sums where leaf names hold the separator, equal a region's name or have no region."""
    nation = b.table(spark, sf, "nation").select(F.col("n_name").alias("ra"), "n_regionkey", "n_nationkey")
    region = b.table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    name = F.when(F.col("n_nationkey") % 5 == 0, F.col("region")).otherwise(F.concat_ws("/", "region", "ra"))
    leaves = b.grid(spark, sf).join(nation.join(region, "n_regionkey"), "ra").select(
        F.lit("ALL").alias("top"), F.when(F.col("n_nationkey") % 6 != 5, F.col("region")).alias("region"),
        name.alias("nation"), F.col("epi_sunday").alias("ds"), F.col("cases").alias("y"),
    )
    tree = hierarchy.aggregate_levels(leaves, ["top", "region", "nation"])
    return hierarchy.bottom_up(tree, 3, "y").select("unique_id", "level", "ds", "rec")


@query(
    "d20_crossed_totals",
    with_ctes(
        "cases",
        c="""select n_name as nation, o_orderstatus as status, cast(o_orderdate as date) - cast(dayofweek(cast(o_orderdate as date)) as integer) as ds, count(*)::double as y
          from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all""",
    )
    + """select case when grouping(nation) = 1 then '*' else nation end as nation, case when grouping(status) = 1 then '*' else status end as status, ds, sum(y) as y
      from c group by grouping sets ((ds), (nation, ds), (status, ds), (nation, status, ds))""",
)
def q_d20(spark, sf):
    rows = b.orders(spark, sf).withColumnsRenamed({"o_orderstatus": "status", "epi_sunday": "ds"})
    counts = b.counts_by(spark, sf, rows, "ds", "status").withColumnsRenamed({"ra": "nation", "cases": "y"})
    return hierarchy.crossed_totals(counts, ["nation", "status"])


REC = ["unique_id", "ds", "rec"]


@query(
    "m15_bottom_up",
    with_ctes("base") + f"""select p.unique_id, p.ds, {s6('sum(l.yhat)', 'rec')} from base p join base l on l.level = 3 and l.ds = p.ds
      and (l.unique_id = p.unique_id or starts_with(l.unique_id, p.unique_id || '/')) group by all""",
)
def q_m15(spark, sf):
    return rounded(hierarchy.bottom_up(base_forecasts(spark, sf), 3).select(*REC), "rec")


define("shared", "select *, yhat / nullif(sum(yhat) over (partition by parent_id, ds), 0) as share from base", "base")
define("td", """select unique_id, ds, yhat as rec from base where level = 1 union all
    select a.unique_id, a.ds, t.yhat * a.share from shared a join base t on t.level = 1 and t.ds = a.ds where a.level = 2 union all
    select c.unique_id, c.ds, t.yhat * a.share * c.share from shared c join shared a on a.unique_id = c.parent_id and a.ds = c.ds
      join base t on t.level = 1 and t.ds = c.ds where c.level = 3""", "shared")


@query("m16_top_down", with_ctes("td") + f"select unique_id, ds, {s6('rec', 'rec')} from td")
def q_m16(spark, sf):
    base = reliable_checkpoint(base_forecasts(spark, sf))
    return rounded(hierarchy.top_down(base, 3).select(*REC), "rec")


@query(
    "d16_middle_out",
    with_ctes("shared") + f"""select unique_id, ds, {s6('rec', 'rec')} from (
      select 'ALL' as unique_id, ds, sum(yhat) as rec from base where level = 2 group by ds union all
      select unique_id, ds, yhat from base where level = 2 union all
      select c.unique_id, c.ds, p.yhat * c.share from shared c join base p on p.unique_id = c.parent_id and p.ds = c.ds where c.level = 3)""",
)
def q_d16(spark, sf):
    base = reliable_checkpoint(base_forecasts(spark, sf))
    return rounded(hierarchy.middle_out(base, 2, 3).select(*REC), "rec")


@query(
    "d16_average_share",
    with_ctes("base") + f"""select p.unique_id, p.ds, {s6('t.yhat * s.share', 'rec')} from base p join base t on t.level = 1 and t.ds = p.ds join
      (select n.unique_id, avg(n.y / nullif(a.y, 0)) as share from nodes n join nodes a on a.level = 1 and a.ds = n.ds where n.ds < date '2000-01-01' group by 1) s on s.unique_id = p.unique_id""",
)
def q_d16_avg(spark, sf):
    tree = nodes(spark, sf)
    history = tree.filter(F.col("ds") < F.lit("2000-01-01").cast("date"))
    return rounded(hierarchy.average_share_top_down(base_forecasts(spark, sf), history).select(*REC), "rec")


define("variances", """select unique_id, avg(pow(y - f, 2)) as variance from (select unique_id, y, ds, lag(y, 52) over (partition by unique_id order by ds) as f from nodes)
    where ds < date '2000-01-01' and f is not null group by 1""", "nodes")


def residuals(spark, sf):
    w = series.ordered(["unique_id"], "ds")
    fitted = nodes(spark, sf).withColumn("residual", F.col("y") - F.lag("y", 52).over(w))
    return fitted.filter((F.col("ds") < F.lit("2000-01-01").cast("date")) & F.col("residual").isNotNull())


@query(
    "m17_wls_diagonal",
    with_ctes("base", "variances", two="select b.*, v.variance from base b join variances v using (unique_id) where level <= 2",
              g="select ds, max(case when level = 1 then yhat end) - sum(case when level = 2 then yhat end) as d, sum(variance) as v from two group by ds")
    + f"select unique_id, ds, {s6('yhat + d / nullif(v, 0) * variance * case when level = 1 then -1 else 1 end', 'rec')} from two join g using (ds)",
)
def q_m17_wls(spark, sf):
    two = base_forecasts(spark, sf).filter("level <= 2")
    out = hierarchy.wls_two_level(two, hierarchy.residual_variances(residuals(spark, sf)))
    return rounded(out.select(*REC), "rec")


@query(
    "m17_wls_tree",
    with_ctes(
        "base", "variances",
        n="select b.*, v.variance as v from base b join variances v using (unique_id)",
        k3="select parent_id as unique_id, ds, sum(yhat) as kids, sum(v) as kv from n where level = 3 group by all",
        u2="select n.*, kids, kv, coalesce((yhat * kv + kids * v) / nullif(v + kv, 0), kids) as m, coalesce(v * kv / nullif(v + kv, 0), 0) as s from n join k3 using (unique_id, ds) where level = 2",
        k2="select parent_id as unique_id, ds, sum(m) as kids, sum(s) as kv from u2 group by all",
        u1="select n.*, kids, kv, coalesce((yhat * kv + kids * v) / nullif(v + kv, 0), kids) as m from n join k2 using (unique_id, ds) where level = 1",
        d2="select c.*, c.m + coalesce(c.s / nullif(p.kv, 0), 0) * (p.m - p.kids) as rec from u2 c join u1 p on p.unique_id = c.parent_id and p.ds = c.ds",
        d3="select c.unique_id, c.ds, c.yhat + coalesce(c.v / nullif(p.kv, 0), 0) * (p.rec - p.kids) as rec from n c join d2 p on p.unique_id = c.parent_id and p.ds = c.ds where c.level = 3",
    )
    + f"select unique_id, ds, {s6('rec', 'rec')} from (select unique_id, ds, m as rec from u1 union all select unique_id, ds, rec from d2 union all select unique_id, ds, rec from d3)",
)
def q_m17_tree(spark, sf):
    tree = reliable_checkpoint(nodes(spark, sf))
    w = series.ordered(["unique_id"], "ds")
    fitted = tree.withColumns({"yhat": F.lag("y", 52).over(w) * (1 + 0.01 * F.col("level")), "residual": F.col("y") - F.lag("y", 52).over(w)})
    base = fitted.filter((F.year("ds") == b.TEST_YEAR) & F.col("yhat").isNotNull()).drop("residual")
    past = fitted.filter((F.col("ds") < F.lit("2000-01-01").cast("date")) & F.col("residual").isNotNull())
    return rounded(hierarchy.wls_tree(base, hierarchy.residual_variances(past), 3).select(*REC), "rec")


@query("m17_min_trace")
def q_m17_mint(spark, sf):
    base = reliable_checkpoint(base_forecasts(spark, sf))
    return hierarchy.min_trace(base, residuals(spark, sf), 3).select("unique_id", "level", "ds", "yhat", "rec")


def _models(spark, sf):
    """Base, bottom-up and top-down forecasts side by side with actuals."""
    base = reliable_checkpoint(base_forecasts(spark, sf))
    up = hierarchy.bottom_up(base, 3, out="bottom_up").select("unique_id", "ds", "bottom_up")
    down = hierarchy.top_down(base, 3, out="top_down").select("unique_id", "ds", "top_down")
    return base.join(up, ["unique_id", "ds"], "left").join(down, ["unique_id", "ds"], "left")


define("models", """select p.unique_id, p.level, p.ds, p.y, p.yhat, u.rec as bottom_up, t.rec as top_down from base p left join td t on t.unique_id = p.unique_id and t.ds = p.ds
    left join (select p.unique_id, p.ds, sum(l.yhat) as rec from base p join base l on l.level = 3 and l.ds = p.ds and (l.unique_id = p.unique_id or starts_with(l.unique_id, p.unique_id || '/')) group by all) u
    on u.unique_id = p.unique_id and u.ds = p.ds""", "td")


@query("j8_models_side_by_side", with_ctes("models") + f"select unique_id, ds, {s6('yhat', 'yhat')}, {s6('bottom_up', 'bottom_up')}, {s6('top_down', 'top_down')} from models where top_down is not null")
def q_j8(spark, sf):
    out = _models(spark, sf).dropna(subset=["yhat", "bottom_up", "top_down"])
    return rounded(out.select("unique_id", "ds", "yhat", "bottom_up", "top_down"), "yhat", "bottom_up", "top_down")


@query(
    "e12_level_mape",
    with_ctes("models", long="unpivot (select unique_id, level, ds, y, yhat, bottom_up, top_down from models) on yhat, bottom_up, top_down into name model value v",
              ser="select level, unique_id, model, avg(abs(y - v) / nullif(abs(y), 0)) as m from long group by all")
    + f"select cast(level as varchar) as level, model, {s6('avg(m)', 'mape')} from ser group by all union all select 'overall', model, {s6('avg(m)', 'mape')} from ser group by all",
)
def q_e12(spark, sf):
    return rounded(metrics.level_mape(_models(spark, sf), ["yhat", "bottom_up", "top_down"]), "mape")
