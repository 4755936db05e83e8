"""Query registry and the SQL fragments shared by the oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def r6(col):
    """Rounded double that never prints as minus zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, 6) + F.lit(0.0)


def s6(expr: str, alias: str | None = None) -> str:
    return f"(round({expr}, 6) + 0.0::double)" + (f" as {alias}" if alias else "")


def rounded(df, *cols: str):
    return df.withColumns({c: r6(c) for c in cols})


def wk(col: str) -> str:
    day = f"cast({col} as date)"
    return f"({day} - cast(dayofweek({day}) as integer))"


PROBABLE = "o_orderstatus in ('P','F')"
EXACT = PROBABLE + " and o_orderpriority in ('1-URGENT')"
FAMILY = PROBABLE + " and o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM')"

CTE = {
    "cases": f"""select {wk('o_orderdate')} as epi_sunday, n_name as ra, cast(count(*) as double) as cases
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        where {PROBABLE} group by all""",
    "grid": """select w.epi_sunday, r.ra, coalesce(c.cases, 0.0::double) as cases
        from (select cast(unnest(generate_series(lo, hi, interval 7 day)) as date) as epi_sunday
              from (select min(epi_sunday) as lo, max(epi_sunday) as hi from cases)) w
        cross join (select n_name as ra from nation) r
        left join cases c on c.epi_sunday = w.epi_sunday and c.ra = r.ra""",
    "basepop": """select n_name as ra, cast(count(c_custkey) as bigint) as populacao
        from nation left join customer on c_nationkey = n_nationkey group by n_name""",
    "pop": """select ra, cast(ano as integer) as ano, cast(round_even(populacao
          * pow(1.0::double + 0.0120::double, greatest(ano, 1998) - 2000)
          * pow(1.0::double + 0.0139::double, least(ano - 1998, 0)), 0) as bigint) as populacao
        from basepop cross join (select unnest(range(1995, 2004)) as ano)""",
    "climraw": f"""select epi_sunday, 'S0' as station_id, temp_mean, precip_sum,
          case when i % 5 = 0 or i <= 6 or i > n - 3 then null else humid end as umidmed, i from (
          select *, row_number() over (order by epi_sunday) as i, count(*) over () as n from (
            select {wk('l_shipdate')} as epi_sunday, avg(l_discount) as temp_mean,
              cast(sum(l_quantity) as double) as precip_sum, avg(l_tax) as humid
            from lineitem group by all))""",
    "climends": """select *,
          last_value(umidmed ignore nulls) over past as v0,
          last_value(case when umidmed is not null then i end ignore nulls) over past as i0,
          first_value(umidmed ignore nulls) over future as v1,
          first_value(case when umidmed is not null then i end ignore nulls) over future as i1
        from climraw window past as (order by i rows between unbounded preceding and current row),
          future as (order by i rows between current row and unbounded following)""",
    "climate": """select epi_sunday, station_id, temp_mean, precip_sum, case
          when umidmed is not null then umidmed
          when i0 is not null and i1 is not null then v0 + (v1 - v0) * ((i - i0)::double / (i1 - i0)::double)
          when i0 is not null then v0
          when i1 - i <= 4 then v1 end as umidmed from climends""",
    "climlag": "select epi_sunday, temp_mean, precip_sum, umidmed, "
    + ", ".join(
        f"lag({c}, {n}) over (order by epi_sunday) as {c}_lag_{n}"
        for c in ("precip_sum", "temp_mean", "umidmed")
        for n in range(2, 9)
    )
    + " from climate",
    "rated": """select g.ra, g.epi_sunday, cast(year(g.epi_sunday) as integer) as ano, g.cases, p.populacao,
          g.cases / nullif(p.populacao, 0)::double * 100000.0::double as incidencia_100k
        from grid g join pop p on p.ra = g.ra and p.ano = year(g.epi_sunday)""",
    "lagged": "select *, "
    + ", ".join(
        f"lag({c}, {n}) over (partition by ra order by epi_sunday) as {c}_lag_{n}"
        for c in ("cases", "incidencia_100k")
        for n in range(1, 5)
    )
    + " from rated",
    "panel": """select l.*, k.* exclude (epi_sunday), cases_lag_1 - cases_lag_2 as cases_delta_1,
          cases_lag_2 - cases_lag_3 as cases_delta_2,
          (cases_lag_1 + 1.0::double) / (cases_lag_2 + 1.0::double) as cases_growth_rate,
          cast(week(l.epi_sunday) as integer) as week_of_year, cast(month(l.epi_sunday) as integer) as month,
          sin(2 * pi() * week(l.epi_sunday) / 53.0::double) as sin_week,
          cos(2 * pi() * week(l.epi_sunday) / 53.0::double) as cos_week,
          sin(2 * pi() * month(l.epi_sunday) / 12.0::double) as sin_month,
          cos(2 * pi() * month(l.epi_sunday) / 12.0::double) as cos_month
        from lagged l left join climlag k on k.epi_sunday = l.epi_sunday""",
    "preds52": """select * from (select epi_sunday, ra, cases,
            lag(cases, 52) over (partition by ra order by epi_sunday) as prediction from grid)
        where year(epi_sunday) = 2000 and prediction is not null""",
    "preds1": """select * from (select epi_sunday, ra, cases,
            lag(cases, 1) over (partition by ra order by epi_sunday) as prediction from grid)
        where year(epi_sunday) = 2000 and prediction is not null""",
    "leaves": """select 'ALL' as top, r_name as region, n_name as nation, epi_sunday as ds, cases as y
        from grid join nation on n_name = ra join region on r_regionkey = n_regionkey""",
}
NEEDS = {
    "grid": ["cases"], "pop": ["basepop"], "climends": ["climraw"], "climate": ["climends"],
    "climlag": ["climate"], "rated": ["grid", "pop"], "lagged": ["rated"], "panel": ["lagged", "climlag"],
    "preds52": ["grid"], "preds1": ["grid"], "leaves": ["grid"],
}


def define(name: str, sql: str, *needs: str) -> None:
    """Add a shared fragment."""
    CTE[name], NEEDS[name] = sql, list(needs)


def with_ctes(*names: str, **local: str) -> str:
    """``with`` clause holding the named fragments, their needs and local ones."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} as ({CTE[n]})" for n in order] + [f"{n} as ({q})" for n, q in local.items()]
    return "with " + ",\n".join(parts) + "\n"
