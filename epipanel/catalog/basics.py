"""Sources, projections, predicates, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epipanel.catalog.registry import (
    EXACT, FAMILY, PROBABLE, query, r6, rounded, s6, with_ctes, wk,
)
from epipanel.functions import scalars, text
from epipanel.functions.calendar import parse_day, season_angles, week_start
from epipanel.operators import panel, regions, series, splits, targets
from epipanel.operators.metrics import r2
from epipanel.plans import bindings as b
from epipanel.plans.features import feature_set
from epipanel.sources.climate import daily_from_payload, weekly_weather


def _daily(spark, sf):
    return b.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.max("l_discount").alias("hi"),
        F.min("l_discount").alias("lo"),
        r6(F.avg("l_discount")).alias("mid"),
        F.sum("l_quantity").cast("double").alias("wet"),
    )


def _payloads(spark, sf):
    """One weather-style document per month (at most 31 days) from line items."""
    month = _daily(spark, sf).groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sort_array(F.collect_list(F.struct("day", "hi", "lo", "mid", "wet"))).alias("d")
    )
    doc = F.to_json(
        F.struct(
            F.struct(
                F.transform("d", lambda x: x["day"].cast("string")).alias("time"),
                F.col("d.hi").alias("temperature_2m_max"),
                F.col("d.lo").alias("temperature_2m_min"),
                F.col("d.mid").alias("temperature_2m_mean"),
                F.col("d.wet").alias("precipitation_sum"),
            ).alias("daily")
        )
    )
    return month.select(doc.alias("payload"))


DAILY_SQL = f"""select cast(l_shipdate as date) as date, max(l_discount) as temp_max, min(l_discount) as temp_min,
    {s6('avg(l_discount)', 'temp_mean')}, cast(sum(l_quantity) as double) as precip_sum from lineitem group by 1"""


@query("s6_json_arrays", DAILY_SQL)
def q_s6(spark, sf):
    return daily_from_payload(_payloads(spark, sf))


@query("s8_labelled_text", "select doc_id, text, lang, quality, toxic from documents join labels using (doc_id)")
def q_s8(spark, sf):
    return b.labelled_documents(spark, sf).select("doc_id", "text", "lang", "quality", "toxic")


@query(
    "s9_results_frame",
    with_ctes("preds52") + "select ra, epi_sunday, cases, prediction from preds52",
)
def q_s9(spark, sf):
    stored = b.naive_predictions(spark, sf, 52).withColumn("epi_sunday", F.col("epi_sunday").cast("string"))
    back = stored.withColumn("epi_sunday", parse_day("epi_sunday"))
    return back.select("ra", "epi_sunday", "cases", "prediction")


NORM = r"regexp_replace(upper(replace(strip_accents({0}), 'ß', 'ss')), '^\s+|\s+$', '', 'g')"


@query("p1_text_norm", f"select doc_id, {NORM.format('text')} as norm from documents")
def q_p1(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", text.norm_key(F.col("text")).alias("norm"))


@query(
    "p2_region_alias",
    """select c_mktsegment, case when c_mktsegment = 'FURNITURE' then null when c_mktsegment = 'AUTOMOBILE' then 'CARS'
       else c_mktsegment end as ra, count(*) as n from customer group by all""",
)
def q_p2(spark, sf):
    raw = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(" Não Informado")).otherwise(F.lower("c_mktsegment"))
    aliases = regions.alias_table(spark, {"Automóbile": "Cars", **regions.DEFAULT_ALIASES})
    named = regions.canonical_region(b.table(spark, sf, "customer").withColumn("raw", raw), "raw", aliases)
    return named.groupBy("c_mktsegment", "ra").agg(F.count("*").alias("n"))


@query(
    "p3_masks",
    f"select o_orderkey, {PROBABLE} as probable, {EXACT} as exact, {FAMILY} as family from orders",
)
def q_p3(spark, sf):
    masks = b.DEFINITION.masks()
    return b.table(spark, sf, "orders").select("o_orderkey", *[m.alias(n) for n, m in masks.items()])


@query(
    "p4_apply_target",
    f"select o_orderkey, {wk('o_orderdate')} as epi_sunday, n_name as ra from orders join customer on o_custkey = c_custkey"
    f" join nation on c_nationkey = n_nationkey where {FAMILY} and n_regionkey = 2",
)
def q_p4(spark, sf):
    picked = targets.select_target(b.orders(spark, sf), b.DEFINITION, "family", "epi_sunday", "o_custkey")
    nation = b.table(spark, sf, "nation").filter(F.col("n_regionkey") == 2).select(F.col("n_name").alias("ra"))
    placed = picked.join(b.customer_regions(spark, sf), "o_custkey").join(nation, "ra")
    return placed.select("o_orderkey", "epi_sunday", "ra")


@query(
    "p5_mixed_code",
    """select code, count(*) as n from (select case when o_orderkey % 2 = 0 then split_part(o_orderpriority, '-', 1)
         else ' ' || lower(split_part(o_orderpriority, '-', 2)) end as code from orders)
       where try_cast(code as double) = 3 or upper(trim(code)) = 'LOW' group by code""",
)
def q_p5(spark, sf):
    parts = F.split("o_orderpriority", "-")
    code = F.when(F.col("o_orderkey") % 2 == 0, parts[0]).otherwise(F.concat(F.lit(" "), F.lower(parts[1])))
    coded = b.table(spark, sf, "orders").select(code.alias("code"))
    return coded.filter(regions.is_state("code", 3, "LOW")).groupBy("code").agg(F.count("*").alias("n"))


def _codes(spark, sf, offset):
    code = (F.substring("o_orderpriority", 1, 1).cast("int") + offset).alias("code")
    return b.table(spark, sf, "orders").select("o_orderkey", code)


@query(
    "p6_code_fallback",
    "select o_orderkey, cast(left(o_orderpriority, 1) as integer) + 90 as code from orders where left(o_orderpriority, 1) in ('3','4','5')",
)
def q_p6(spark, sf):
    return targets.code_set(F.col("code"), [1, 2, 3], [93, 94, 95], _codes(spark, sf, 90))


@query(
    "p6_code_first_set",
    "select o_orderkey, cast(left(o_orderpriority, 1) as integer) as code from orders where left(o_orderpriority, 1) in ('1','2','3')",
)
def q_p6_first(spark, sf):
    return targets.code_set(F.col("code"), [1, 2, 3], [4, 5], _codes(spark, sf, 0))


@query(
    "p7_year_split",
    with_ctes("grid") + """select 'train' as part, ra, epi_sunday, cases from grid where epi_sunday < date '2000-01-01'
      union all select 'test', ra, epi_sunday, cases from grid where epi_sunday >= date '2000-01-01' and epi_sunday < date '2001-01-01'""",
)
def q_p7(spark, sf):
    train, test = splits.year_split(b.grid(spark, sf), b.TEST_YEAR)
    cols = ["ra", "epi_sunday", "cases"]
    return train.select(F.lit("train").alias("part"), *cols).unionByName(test.select(F.lit("test").alias("part"), *cols))


PANEL_NEED = "cases_lag_1 is not null and cases_lag_4 is not null and cases_lag_3 is not null and cases_lag_2 is not null"


@query(
    "p8_complete_cases",
    with_ctes("panel") + f"select ra, epi_sunday, cases, cases_lag_4, {s6('precip_sum_lag_8', 'precip_sum_lag_8')} from panel where {PANEL_NEED}"
    " and precip_sum_lag_8 is not null and temp_mean_lag_8 is not null and umidmed_lag_8 is not null and umidmed_lag_2 is not null",
)
def q_p8(spark, sf):
    clean = feature_set("lag+clima").complete_rows(b.full_panel(spark, sf))
    return rounded(clean.select("ra", "epi_sunday", "cases", "cases_lag_4", "precip_sum_lag_8"), "precip_sum_lag_8")


@query(
    "p9_date_range",
    "select o_orderkey, cast(o_orderdate as date) as day from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01'",
)
def q_p9(spark, sf):
    inside = (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    )
    return b.table(spark, sf, "orders").filter(inside).select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "p10_feature_projection",
    with_ctes("panel") + "select epi_sunday, ra, cases_lag_1, cases_lag_2, cases_lag_3, cases_lag_4, cases_delta_1, cases_delta_2,"
    f" {s6('cases_growth_rate', 'cases_growth_rate')} from panel",
)
def q_p10(spark, sf):
    cols = feature_set("lag-only").input_columns()
    return rounded(b.full_panel(spark, sf).select("epi_sunday", "ra", *cols), "cases_growth_rate")


@query("p11_rename", "select n_name as ra, n_regionkey as regiao from nation")
def q_p11(spark, sf):
    return b.table(spark, sf, "nation").withColumnsRenamed({"n_name": "ra", "n_regionkey": "regiao"}).select("ra", "regiao")


@query("p12_fill_zero", with_ctes("grid") + "select ra, epi_sunday, cases from grid where cases = 0")
def q_p12(spark, sf):
    return b.grid(spark, sf).filter(F.col("cases") == 0).select("ra", "epi_sunday", "cases")


@query(
    "p13_clip",
    with_ctes("preds52") + """select ra, epi_sunday, greatest(cases - prediction, 0.0::double) as floored,
      cast(least(row_number() over (partition by ra order by epi_sunday), 4) as integer) as horizon from preds52""",
)
def q_p13(spark, sf):
    placed = series.position_horizon(b.naive_predictions(spark, sf, 52), ["ra"], "epi_sunday", 4)
    return placed.select(
        "ra", "epi_sunday", scalars.floor_zero(F.col("cases") - F.col("prediction")).alias("floored"), "horizon"
    )


@query(
    "p15_coverage_gate",
    with_ctes("climraw") + """select 'umidmed' as column_name, cast(count(*) as bigint) as missing,
      (select string_agg(cast(epi_sunday as varchar), ',' order by epi_sunday) from
        (select epi_sunday from climraw where umidmed is null order by epi_sunday limit 5)) as first_weeks
      from climraw where umidmed is null""",
)
def q_p15(spark, sf):
    return series.coverage_gaps(b.weekly_climate(spark, sf), ["temp_mean", "precip_sum", "umidmed"])


@query(
    "p16_text_flags",
    r"""select doc_id, cast(regexp_matches(text, '[A-Z]{3,}') as integer) as caps, cast(regexp_matches(text, '!{2,}') as integer) as exclaim,
       cast(regexp_matches(text, '\?{2,}') as integer) as question from documents""",
)
def q_p16(spark, sf):
    t = F.col("text")
    return b.table(spark, sf, "documents").select(
        "doc_id", text.has_capitals(t).alias("caps"), text.has_exclamations(t).alias("exclaim"), text.has_questions(t).alias("question")
    )


@query(
    "p17_single_label_examples",
    """select label, doc_id from (select case when toxic = 1 then 'toxic' else 'quality' end as label, doc_id,
         row_number() over (partition by toxic order by doc_id) as rn from labels where toxic + quality = 1) where rn <= 2""",
)
def q_p17(spark, sf):
    single = b.table(spark, sf, "labels").filter(F.col("toxic") + F.col("quality") == 1)
    named = single.select(F.when(F.col("toxic") == 1, "toxic").otherwise("quality").alias("label"), "doc_id")
    w = Window.partitionBy("label").orderBy("doc_id")
    return named.withColumn("_r", F.row_number().over(w)).filter("_r <= 2").drop("_r")


@query(
    "p18_named_series",
    with_ctes("grid") + "select ra, epi_sunday, cases from grid where ra in ('NATION_3', 'NATION_7')",
)
def q_p18(spark, sf):
    picked = text.norm_key(F.col("ra")).isin("NATION_3", "NATION_7")
    return b.grid(spark, sf).filter(picked).select("ra", "epi_sunday", "cases")


@query(
    "f1_string_functions",
    r"""select doc_id, length(text) as n_chars_all,
      cast(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: length(x) > 0)) as integer) as words,
      upper(trim(source)) || ':' || lang as tag, regexp_replace(source, '[0-9]+', '#', 'g') as masked,
      regexp_extract(source, '([0-9]+)', 1) as source_no, starts_with(source, 'src') as is_src,
      length(trim(text)) = 0 as is_blank from documents""",
)
def q_f1(spark, sf):
    t = F.col("text")
    return b.table(spark, sf, "documents").select(
        "doc_id",
        F.length(t).cast("long").alias("n_chars_all"),
        text.word_count(t).alias("words"),
        F.concat_ws(":", F.upper(F.trim("source")), "lang").alias("tag"),
        F.regexp_replace("source", "[0-9]+", "#").alias("masked"),
        F.regexp_extract("source", "([0-9]+)", 1).alias("source_no"),
        F.startswith("source", F.lit("src")).alias("is_src"),
        (F.length(F.trim(t)) == 0).alias("is_blank"),
    )


@query(
    "f2_date_functions",
    f"""select day, {wk('day')} as epi_sunday, cast(year(day) as integer) as ano, cast(week({wk('day')}) as integer) as iso_week,
      cast(month(day) as integer) as mes, strftime(day, '%Y%m%d') as stamp, n
      from (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1)""",
)
def q_f2(spark, sf):
    day = F.col("day")
    days = b.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    parsed = days.withColumn("day", parse_day(day.cast("string")))
    return parsed.select(
        "day", week_start(day).alias("epi_sunday"), F.year(day).alias("ano"), F.weekofyear(week_start(day)).alias("iso_week"),
        F.month(day).alias("mes"), F.date_format(day, "yyyyMMdd").alias("stamp"), "n",
    )


@query(
    "f2_week_grid",
    f"""select cast(unnest(generate_series(lo, hi, interval 7 day)) as date) as epi_sunday
       from (select min({wk('o_orderdate')}) as lo, max({wk('o_orderdate')}) as hi from orders)""",
)
def q_f2_grid(spark, sf):
    span = b.orders(spark, sf).agg(F.min("epi_sunday").alias("lo"), F.max("epi_sunday").alias("hi"))
    return span.select(F.explode(F.expr("sequence(lo, hi, interval 7 days)")).alias("epi_sunday"))


@query(
    "f3_math_functions",
    with_ctes("rated") + f"""select ra, epi_sunday, {s6('ln(1 + cases)', 'log_cases')}, {s6('exp(ln(1 + cases)) - 1', 'back')},
      {s6('incidencia_100k', 'rate')}, {s6('incidencia_100k * populacao / 100000.0::double', 'count_back')},
      {s6('sin(2 * pi() * week(epi_sunday) / 53.0::double)', 'sin_week')}, {s6('cos(2 * pi() * month(epi_sunday) / 12.0::double)', 'cos_month')},
      {s6('1.0::double / nullif(cases, 0)', 'inverse')}, {s6('sqrt(abs(cases - 3))', 'root')} from rated""",
)
def q_f3(spark, sf):
    rated = panel.add_population(b.grid(spark, sf), b.population(spark, sf))
    angles = season_angles(F.col("epi_sunday"))
    c = F.col("cases")
    return rated.select(
        "ra", "epi_sunday", r6(F.log1p(c)).alias("log_cases"), r6(F.expm1(F.log1p(c))).alias("back"),
        r6("incidencia_100k").alias("rate"), r6(scalars.rate_to_count(F.col("incidencia_100k"), F.col("populacao"))).alias("count_back"),
        r6(angles["sin_week"]).alias("sin_week"), r6(angles["cos_month"]).alias("cos_month"),
        r6(scalars.ratio(F.lit(1.0), c)).alias("inverse"), r6(F.sqrt(F.abs(c - 3))).alias("root"),
    )


@query(
    "f4_casts",
    """select o_orderkey, try_cast(split_part(o_orderpriority, '-', 2) as double) is null as not_number,
       try_cast(left(o_orderpriority, 1) as double) as number, cast(o_totalprice as bigint) is not null as whole from orders""",
)
def q_f4(spark, sf):
    return b.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "try_cast(split_part(o_orderpriority, '-', 2) as double) is null as not_number",
        "try_cast(left(o_orderpriority, 1) as double) as number", "cast(o_totalprice as bigint) is not null as whole",
    )


@query(
    "f5_json_maps",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k, '{"k":' || cast(cast(json_extract(props, '$.k') as bigint) as varchar) || '}' as packed,
       case event_type when 'click' then 1.0::double when 'view' then 0.5::double else 0.1::double end as weight from events""",
)
def q_f5(spark, sf):
    parsed = b.table(spark, sf, "events").withColumn("p", F.from_json("props", "k long"))
    weights = F.create_map(F.lit("click"), F.lit(1.0), F.lit("view"), F.lit(0.5))
    return parsed.select(
        "event_id", F.col("p.k").alias("k"), F.to_json("p").alias("packed"),
        F.coalesce(F.try_element_at(weights, F.col("event_type")), F.lit(0.1)).alias("weight"),
    )


@query("j1_week_region_grid", with_ctes("grid") + "select ra, epi_sunday from grid")
def q_j1(spark, sf):
    span = b.case_counts(spark, sf)
    first, last = span.agg(F.min("epi_sunday")).scalar(), span.agg(F.max("epi_sunday")).scalar()
    return panel.week_region_grid(b.base_population(spark, sf), first, last)


@query("j2_dense_counts", with_ctes("grid") + "select ra, epi_sunday, cases from grid")
def q_j2(spark, sf):
    return b.grid(spark, sf).select("ra", "epi_sunday", "cases")


@query(
    "j3_population_join",
    with_ctes("rated") + f"select ra, epi_sunday, ano, populacao, {s6('incidencia_100k', 'incidencia_100k')} from rated",
)
def q_j3(spark, sf):
    rated = panel.add_population(b.grid(spark, sf), b.population(spark, sf))
    return rated.select("ra", "epi_sunday", "ano", "populacao", r6("incidencia_100k").alias("incidencia_100k"))


@query(
    "j4_climate_join",
    with_ctes("rated", "climlag") + f"select r.ra, r.epi_sunday, {s6('k.temp_mean_lag_2', 'temp_mean_lag_2')}, {s6('k.umidmed_lag_8', 'umidmed_lag_8')} from rated r left join climlag k on k.epi_sunday = r.epi_sunday",
)
def q_j4(spark, sf):
    lagged = panel.climate_lags(b.climate(spark, sf)).drop("station_id")
    joined = b.grid(spark, sf).join(lagged, "epi_sunday", "left")
    return rounded(joined.select("ra", "epi_sunday", "temp_mean_lag_2", "umidmed_lag_8"), "temp_mean_lag_2", "umidmed_lag_8")


@query(
    "j3_static_population",
    with_ctes("grid", "basepop") + f"select g.ra, g.epi_sunday, p.populacao, {s6('g.cases / nullif(p.populacao, 0)::double * 100000.0::double', 'incidencia_100k')} from grid g join basepop p on p.ra = g.ra",
)
def q_j3_static(spark, sf):
    rated = panel.add_population(b.grid(spark, sf), b.base_population(spark, sf), by_year=False)
    return rated.select("ra", "epi_sunday", "populacao", r6("incidencia_100k").alias("incidencia_100k"))


@query(
    "j4_climate_inner_panel",
    with_ctes("grid", "basepop", "climlag") + f"""select * from (select g.ra, g.epi_sunday, g.cases, lag(g.cases, 4) over (partition by g.ra order by g.epi_sunday) as cases_lag_4,
      {s6('k.temp_mean_lag_3', 'temp_mean_lag_3')} from grid g join basepop p on p.ra = g.ra join climlag k on k.epi_sunday = g.epi_sunday)""",
)
def q_j4_inner(spark, sf):
    full = panel.build_panel(b.case_counts(spark, sf), b.base_population(spark, sf), b.climate(spark, sf), by_year=False, climate_join="inner")
    return rounded(full.select("ra", "epi_sunday", "cases", "cases_lag_4", "temp_mean_lag_3"), "temp_mean_lag_3")


@query(
    "j5_humidity_join",
    f"""with w as (select {wk('l_shipdate')} as epi_sunday, cast(sum(l_quantity) as double) as precip_sum from lineitem group by 1),
      h as (select {wk('o_orderdate')} as epi_sunday, count(*) as n_orders from orders where o_orderstatus = 'F' group by 1)
      select w.epi_sunday, precip_sum, n_orders is null as no_orders, coalesce(n_orders, 0) as n_orders from w left join h on w.epi_sunday = h.epi_sunday""",
)
def q_j5(spark, sf):
    wet = b.weekly_climate(spark, sf).select("epi_sunday", "precip_sum")
    other = b.orders(spark, sf).filter("o_orderstatus = 'F'").groupBy("epi_sunday").agg(F.count("*").alias("n_orders"))
    joined = wet.join(other, "epi_sunday", "left")
    return joined.select("epi_sunday", "precip_sum", F.col("n_orders").isNull().alias("no_orders"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query(
    "u3_lost_regions",
    """select n_name as ra, count(*) as rows_lost from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       where n_regionkey = 4 group by 1""",
)
def q_u3(spark, sf):
    nation = b.table(spark, sf, "nation").filter("n_regionkey <> 4").select(F.col("n_name").alias("ra"))
    known = b.base_population(spark, sf).join(nation, "ra", "left_semi")
    cases = b.table(spark, sf, "orders").join(b.customer_regions(spark, sf), "o_custkey")
    return regions.lost_regions(cases, known)


@query(
    "u1_union_by_name",
    """select 'orders' as source_table, cast(o_orderdate as date) as day, cast(null as varchar) as flag, count(*) as n from orders group by all
       union all select 'lineitem', cast(l_shipdate as date), l_returnflag, count(*) from lineitem group by all""",
)
def q_u1(spark, sf):
    left = b.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    right = b.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"))
    return left.withColumn("source_table", F.lit("orders")).unionByName(
        right.withColumn("source_table", F.lit("lineitem")), allowMissingColumns=True
    )


@query(
    "u2_rows_minus_holdout",
    with_ctes("leaves") + "select region || '/' || nation as unique_id, ds, y from leaves where ds not in (select ds from (select distinct ds from leaves order by ds desc limit 52))",
)
def q_u2(spark, sf):
    leaves = b.hierarchy_leaves(spark, sf).select(F.concat_ws("/", "region", "nation").alias("unique_id"), "ds", "y")
    _, test = series.holdout_tail(leaves, ["unique_id"], "ds", 52)
    return leaves.join(test.select("unique_id", "ds"), ["unique_id", "ds"], "left_anti")


@query(
    "a8_daily_to_weekly",
    f"""with d as ({DAILY_SQL}) select {wk('date')} as epi_sunday, {s6('avg(temp_max)', 'temp_max')}, {s6('avg(temp_min)', 'temp_min')},
      {s6('avg(temp_mean)', 'temp_mean')}, sum(precip_sum) as precip_sum from d group by 1""",
)
def q_a8(spark, sf):
    weekly = weekly_weather(daily_from_payload(_payloads(spark, sf)))
    return rounded(weekly, "temp_max", "temp_min", "temp_mean")


@query(
    "e1_r2_by_region",
    with_ctes("preds52") + f"""select ra, {s6("case when count(*) >= 2 and var_pop(cases) > 1e-8 then 1 - sum(pow(cases - prediction, 2)) / (var_pop(cases) * count(*)) end", "r2_ra")} from preds52 group by ra""",
)
def q_panel_r2(spark, sf):
    return rounded(b.naive_predictions(spark, sf, 52).groupBy("ra").agg(r2().alias("r2_ra")), "r2_ra")
