"""End-to-end runs as queries."""

from __future__ import annotations

from epipanel.catalog.registry import CTE, define, query, rounded, s6, with_ctes
from epipanel.plans import bindings as b
from epipanel.plans import runs
from epipanel.session import temporary


def _root(spark) -> str:
    return temporary(spark, "run")


def _on_run(name: str) -> str:
    """A reconciliation fragment over the run's forecasts instead of the test year's."""
    return CTE[name].replace("base", "runbase").replace("shared", "runshared").replace("from td", "from runtd")


define("runbase", "select n.unique_id, n.level, n.parent_id, n.ds, n.y, s.seasonal_naive as yhat from snaive s join nodes n on n.unique_id = s.unique_id and n.ds = s.ds", "snaive", "nodes")
define("runshared", _on_run("shared"), "runbase")
define("runtd", _on_run("td"), "runshared")
define("runmodels", """select p.unique_id, p.level, p.ds, p.y, p.yhat, u.rec as bottom_up, t.rec as top_down from runbase p left join runtd t on t.unique_id = p.unique_id and t.ds = p.ds
    left join (select p.unique_id, p.ds, sum(l.yhat) as rec from runbase p join runbase l on l.level = 3 and l.ds = p.ds and (l.unique_id = p.unique_id or starts_with(l.unique_id, p.unique_id || '/')) group by all) u
    on u.unique_id = p.unique_id and u.ds = p.ds""", "runtd")


@query(
    "run_hierarchy",
    with_ctes("runmodels", long="unpivot (select unique_id, level, ds, y, yhat, bottom_up, top_down from runmodels) on yhat, bottom_up, top_down into name model value v",
              ser="select level, unique_id, model, avg(abs(y - v) / nullif(abs(y), 0)) as m from long group by all").replace("runbase as (", "runbase as materialized (").replace("nodes as (", "nodes as materialized (")
    + f"select cast(level as varchar) as level, model, {s6('avg(m)', 'mape')} from ser group by all union all select 'overall', model, {s6('avg(m)', 'mape')} from ser group by all",
)
def q_run_hierarchy(spark, sf):
    out = runs.hierarchy_run(b.hierarchy_leaves(spark, sf), ["top", "region", "nation"], 52, _root(spark), "20240101_0000")
    return rounded(out, "mape")


@query("run_panel")
def q_run_panel(spark, sf):
    grids = {"RF": {"n_estimators": [5], "max_depth": [3, 5]}, "XGB": {"n_estimators": [3], "max_depth": [3]}}
    models = {"RF": {"n_estimators": 5, "max_depth": 5}, "XGB": {"n_estimators": 3, "max_depth": 3}}
    return runs.panel_run(
        b.full_panel(spark, sf), b.TEST_YEAR, models, grids, _root(spark), "20240101_0000", ["lag-only", "lag+clima"]
    )
