"""Counts, pivots, correlations, quantiles and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epipanel.catalog.registry import EXACT, FAMILY, PROBABLE, query, r6, rounded, s6, with_ctes, wk
from epipanel.functions import text
from epipanel.functions.scalars import fill_zero, ratio
from epipanel.operators import consistency, panel, profile, ranks, regions, targets
from epipanel.plans import bindings as b


@query("a1_count_week_region", with_ctes("cases") + "select epi_sunday, ra, cases from cases")
def q_a1(spark, sf):
    return b.case_counts(spark, sf).select("epi_sunday", "ra", "cases")


NULL_CODE = "case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end"


@query("a2_value_counts", f"select {NULL_CODE} as value, count(*) as n from orders group by 1 order by n desc")
def q_a2(spark, sf):
    code = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    return profile.value_counts_desc(b.table(spark, sf, "orders").select(code.alias("value")), "value")


@query(
    "a3_top_pairs",
    f"select o_orderstatus, value, count(*) as n from (select o_orderstatus, {NULL_CODE} as value from orders) where value is not null"
    " group by all order by n desc, o_orderstatus, value limit 20",
)
def q_a3(spark, sf):
    code = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    return profile.top_pairs(b.table(spark, sf, "orders").select("o_orderstatus", code.alias("value")), "o_orderstatus", "value", 20)


COND = f"""cast(count_if({PROBABLE}) as bigint) as probable, cast(count_if({EXACT}) as bigint) as exact,
   cast(count_if({FAMILY}) as bigint) as family, count(o_orderstatus) as classified"""


@query("a4_yearly_definitions", f"select cast(year(o_orderdate) as integer) as ano, {COND} from orders group by 1")
def q_a4(spark, sf):
    dated = b.table(spark, sf, "orders").withColumn("ano", F.year("o_orderdate")).dropna(subset=["ano"])
    return profile.definition_counts(dated, b.DEFINITION, "ano")


@query("a5_global_definitions", f"select {COND} from orders")
def q_a5(spark, sf):
    return profile.definition_counts(b.table(spark, sf, "orders"), b.DEFINITION)


CODE2 = "case when o_orderkey % 7 = 0 then null else cast(left(o_orderpriority, 1) as integer) end"


@query(
    "a6_code_counts",
    f"select coalesce(cast({CODE2} as varchar), 'NA') as code, count(*) as n from orders group by 1 order by 1",
)
def q_a6(spark, sf):
    code = F.when(F.col("o_orderkey") % 7 != 0, F.substring("o_orderpriority", 1, 1).cast("int"))
    return profile.code_counts(b.table(spark, sf, "orders").select(code.alias("code")), "code")


SOURCES = f"""a as (select {wk('l_shipdate')} as epi_sunday, count(*) as n from lineitem where l_returnflag = 'R' group by 1),
  c as (select {wk('l_shipdate')} as epi_sunday, count(*) as n from lineitem where l_returnflag <> 'R' group by 1),
  i as (select {wk('o_orderdate')} as epi_sunday, count(*) as n from orders group by 1),
  joined as (select coalesce(a.epi_sunday, c.epi_sunday, i.epi_sunday) as epi_sunday, coalesce(a.n, 0)::double as residence,
     coalesce(c.n, 0)::double as notification, coalesce(i.n, 0)::double as local from a full join c on a.epi_sunday = c.epi_sunday
     full join i on i.epi_sunday = coalesce(a.epi_sunday, c.epi_sunday))"""


@query("a6_weekly_counts", f"with {SOURCES} select epi_sunday, n from a")
def q_a6_weekly(spark, sf):
    returned = b.table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return consistency.weekly_source(returned, "l_shipdate", "n").withColumn("n", F.col("n").cast("long"))


def _sources(spark, sf):
    items = b.table(spark, sf, "lineitem")
    local = b.table(spark, sf, "orders")
    return consistency.align_sources(
        consistency.weekly_source(items.filter("l_returnflag = 'R'"), "l_shipdate", "residence"),
        consistency.weekly_source(items.filter("l_returnflag <> 'R'"), "l_shipdate", "notification"),
        consistency.weekly_source(local, "o_orderdate", "local"),
    )


@query("j6_three_way_outer", f"with {SOURCES} select epi_sunday, residence, notification, local from joined")
def q_j6(spark, sf):
    return _sources(spark, sf)


@query(
    "e14_source_differences",
    f"""with {SOURCES} select epi_sunday, local - residence as diff_residence, {s6('abs(local - residence) / nullif(residence, 0) * 100', 'diff_pct_residence')},
      local - notification as diff_notification, {s6('abs(local - notification) / nullif(notification, 0) * 100', 'diff_pct_notification')} from joined""",
)
def q_e14_rows(spark, sf):
    diffs = consistency.source_differences(_sources(spark, sf), "local", ["residence", "notification"])
    out = diffs.select("epi_sunday", *[c for c in diffs.columns if c.startswith("diff")])
    return rounded(out, "diff_pct_residence", "diff_pct_notification")


AGREE = """select '{0}' as source, {1}, {2}, {3}, corr({0}, local) >= 0.90 and avg(abs(local - {0}) / nullif({0}, 0) * 100) <= 15.0 as accepted from joined"""


@query(
    "e14_source_agreement",
    f"with {SOURCES} "
    + " union all ".join(
        AGREE.format(
            s, s6(f"corr({s}, local)", "corr"), s6(f"avg(abs(local - {s}) / nullif({s}, 0) * 100)", "mean_pct"),
            s6(f"max(abs(local - {s}) / nullif({s}, 0) * 100)", "max_pct"),
        )
        for s in ("residence", "notification")
    ),
)
def q_e14(spark, sf):
    return rounded(consistency.source_agreement(_sources(spark, sf), "local", ["residence", "notification"]), "corr", "mean_pct", "max_pct")


@query(
    "a7_counts_per_definition",
    "select epi_sunday, target, count(*) as n from ("
    + " union all ".join(f"select {wk('o_orderdate')} as epi_sunday, '{n}' as target from orders where {m}" for n, m in (("probable", PROBABLE), ("exact", EXACT), ("family", FAMILY)))
    + ") group by all",
)
def q_a7(spark, sf):
    named = b.orders(spark, sf).select("epi_sunday", F.explode(targets.matching_targets(b.DEFINITION)).alias("target"))
    return named.groupBy("epi_sunday", "target").agg(F.count("*").alias("n"))


@query("a10_total_per_week", with_ctes("grid") + "select epi_sunday, sum(cases) as cases from grid group by 1")
def q_a10(spark, sf):
    return b.grid(spark, sf).groupBy("epi_sunday").agg(F.sum("cases").alias("cases"))


@query(
    "a11_mean_incidence",
    with_ctes("rated") + f"select ra, {s6('avg(incidencia_100k)', 'mean_rate')} from rated where ano = 2000 group by ra order by 2",
)
def q_a11(spark, sf):
    rated = panel.add_population(b.grid(spark, sf), b.population(spark, sf)).filter("ano = 2000")
    return rated.groupBy("ra").agg(r6(F.avg("incidencia_100k")).alias("mean_rate")).orderBy("mean_rate", "ra")


@query(
    "a12_scaled_rows",
    with_ctes("grid") + f"select ra, epi_sunday, coalesce({s6('cases / nullif(max(cases) over (partition by ra), 0)')}, 0.0::double) as share from grid",
)
def q_a12(spark, sf):
    top = F.max("cases").over(Window.partitionBy("ra"))
    return b.grid(spark, sf).select("ra", "epi_sunday", fill_zero(r6(ratio(F.col("cases"), top))).alias("share"))


YEARS = ", ".join(f"{s6(f'sum(case when ano = {y} then cases end)')} as y{y}" for y in range(1995, 2003))


@query("a12_pivot_years", with_ctes("rated") + f"select ra, {YEARS} from rated group by ra")
def q_a12_pivot(spark, sf):
    years = list(range(1995, 2003))
    wide = b.grid(spark, sf).withColumn("ano", F.year("epi_sunday")).groupBy("ra").pivot("ano", years).agg(F.sum("cases"))
    return wide.select("ra", *[r6(F.col(f"`{y}`")).alias(f"y{y}") for y in years])


def _lag_pairs(spark, sf):
    wide = b.full_panel(spark, sf)
    lags = [f"{c}_lag_{n}" for c in ("precip_sum", "temp_mean", "umidmed") for n in range(2, 9)]
    return wide.select("incidencia_100k", *lags).unpivot(["incidencia_100k"], lags, "feature", "value")


_FEATS = [f"{c}_lag_{n}" for c in ("precip_sum", "temp_mean", "umidmed") for n in range(2, 9)]
SPEARMAN = dict(
    pairs=" union all ".join(f"select '{c}' as feature, {c} as value, incidencia_100k as y from panel where {c} is not null" for c in _FEATS),
    ranked="""select feature, rank() over (partition by feature order by value) + (count(*) over (partition by feature, value) - 1) / 2.0::double as rx,
      rank() over (partition by feature order by y) + (count(*) over (partition by feature, y) - 1) / 2.0::double as ry from pairs""",
)


@query("a14_spearman_lags", with_ctes("panel", **SPEARMAN) + f"select feature, {s6('corr(rx, ry)', 'spearman')} from ranked group by feature")
def q_a14(spark, sf):
    out = ranks.spearman(_lag_pairs(spark, sf), ["feature"], "value", "incidencia_100k")
    return out.select("feature", r6("spearman").alias("spearman"))


@query(
    "a13_pivot_correlations",
    with_ctes("panel", **SPEARMAN, c=f"select feature, {s6('corr(rx, ry)', 'spearman')} from ranked group by feature")
    + "select regexp_replace(feature, '_lag_[0-9]+$', '') as variable, "
    + ", ".join(f"max(case when feature like '%_lag_{n}' then spearman end) as lag_{n}" for n in range(2, 9))
    + " from c group by 1",
)
def q_a13(spark, sf):
    out = ranks.spearman(_lag_pairs(spark, sf), ["feature"], "value", "incidencia_100k")
    return profile.pivot_lags(out.select("feature", r6("spearman").alias("spearman")), "spearman", range(2, 9))


@query("a15_pearson_sources", f"with {SOURCES} select {s6('corr(residence, local)', 'r')}, count(*) as n_weeks from joined")
def q_a15(spark, sf):
    return _sources(spark, sf).agg(r6(F.corr("residence", "local")).alias("r"), F.count("*").alias("n_weeks"))


@query(
    "a15_label_correlations",
    f"""with t as (select doc_id, toxic, quality, cast(regexp_matches(text, '!{{2,}}') as integer) as exclaim from documents join labels using (doc_id)),
      c as (select 'toxic' as a, 'quality' as b, corr(toxic, quality) as r from t union all select 'toxic', 'exclaim', corr(toxic, exclaim) from t
      union all select 'quality', 'exclaim', corr(quality, exclaim) from t) select a, b, case when isnan(r) then null else {s6('r')} end as r, coalesce(abs(r) > 0.5 and not isnan(r), false) as strong from c""",
)
def q_a15_labels(spark, sf):
    flags = b.labelled_documents(spark, sf).withColumn("exclaim", text.has_exclamations(F.col("text")))
    return profile.label_correlations(flags, ["toxic", "quality", "exclaim"], 0.5).withColumn("r", r6("r"))


@query("a16_quantile", with_ctes("grid") + f"select {s6('quantile_cont(t, 0.75)', 'p75')}, {s6('quantile_cont(t, 0.1)', 'p10')} from (select sum(cases) as t from grid group by epi_sunday)")
def q_a16(spark, sf):
    totals = b.grid(spark, sf).groupBy("epi_sunday").agg(F.sum("cases").alias("t"))
    return totals.agg(r6(F.percentile("t", F.lit(0.75))).alias("p75"), r6(F.percentile("t", F.lit(0.1))).alias("p10"))


@query(
    "a16_exact_quantile_rows",
    f"select l_returnflag, {s6('quantile_cont(l_extendedprice, 0.5)', 'median')}, {s6('quantile_cont(l_extendedprice, 0.95)', 'p95')}, count(*) as n from lineitem group by 1",
)
def q_a16_rows(spark, sf):
    counts = ranks.value_counts(b.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    levels = {"median": ranks.constant_level(0.5), "p95": ranks.constant_level(0.95)}
    return rounded(ranks.quantiles(counts, ["l_returnflag"], "l_extendedprice", levels), "median", "p95")


@query(
    "a17_group_level_quantile",
    f"""with s as (select l_linenumber as k, l_extendedprice as v, row_number() over (partition by l_linenumber order by l_extendedprice) as rn,
        count(*) over (partition by l_linenumber) as n from lineitem),
      h as (select *, (n - 1) * least(1.0::double, ceil((n + 1) * (1.0::double - 0.1::double)) / n) as pos from s)
      select k, n, {s6("max(case when rn = floor(pos) + 1 then v end) + (max(case when rn = ceil(pos) + 1 then v end) - max(case when rn = floor(pos) + 1 then v end)) * (max(pos) - floor(max(pos)))", "q")} from h group by k, n""",
)
def q_a17(spark, sf):
    items = b.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("k"), F.col("l_extendedprice").alias("v"))
    level = lambda n: F.least(F.lit(1.0), F.ceil((n + 1) * F.lit(1.0 - 0.1)) / n)
    return rounded(ranks.quantiles(ranks.value_counts(items, ["k"], "v"), ["k"], "v", {"q": level}), "q")


@query("a18_distinct_weeks", with_ctes("grid") + "select distinct epi_sunday from grid")
def q_a18(spark, sf):
    return b.grid(spark, sf).select("epi_sunday").distinct()


@query(
    "a19_peak_week",
    with_ctes("grid") + "select ra, epi_sunday as peak_week, cases as peak_cases from (select *, row_number() over (partition by ra order by cases desc, epi_sunday) as rn from grid) where rn = 1",
)
def q_a19(spark, sf):
    return profile.peak_rows(b.grid(spark, sf), ["ra"], "epi_sunday", "cases")


@query("a20_population_by_year", with_ctes("pop") + "select ano, cast(sum(populacao) as bigint) as populacao from pop group by ano")
def q_a20(spark, sf):
    return regions.population_by_year(b.population(spark, sf))


@query(
    "a21_null_profile",
    with_ctes("climlag")
    + " union all ".join(
        f"select '{c}' as column_name, cast(count_if({c} is null) as bigint) as nulls, {s6(f'count_if({c} is null) * 100.0::double / count(*)', 'null_pct')} from climlag"
        for c in ("temp_mean", "umidmed", "umidmed_lag_2", "umidmed_lag_8", "precip_sum_lag_4")
    ),
)
def q_a21(spark, sf):
    lagged = panel.climate_lags(b.climate(spark, sf))
    cols = ["temp_mean", "umidmed", "umidmed_lag_2", "umidmed_lag_8", "precip_sum_lag_4"]
    return rounded(profile.null_profile(lagged, cols), "null_pct")


@query(
    "a21_describe",
    " union all ".join(
        f"select '{c}' as column_name, count({c}) as n, {s6(f'avg({c})', 'mean')}, {s6(f'stddev_samp({c})', 'sd')}, {s6(f'min({c})', 'lowest')},"
        f" {s6(f'quantile_cont({c}, 0.25)', 'p25')}, {s6(f'quantile_cont({c}, 0.5)', 'p50')}, {s6(f'quantile_cont({c}, 0.75)', 'p75')}, {s6(f'max({c})', 'highest')}"
        f" from (select length(text)::double as chars, n_chars::double as stated from documents)"
        for c in ("chars", "stated")
    ),
)
def q_a21_describe(spark, sf):
    sizes = b.table(spark, sf, "documents").select(F.length("text").cast("double").alias("chars"), F.col("n_chars").cast("double").alias("stated"))
    out = profile.describe(sizes, ["chars", "stated"])
    return rounded(out, "mean", "sd", "lowest", "p25", "p50", "p75", "highest")


@query(
    "a22_label_totals",
    f"""select label, cast(sum(v) as bigint) as total, {s6('sum(v) * 100.0::double / count(*)', 'pct')} from
      (select 'toxic' as label, toxic as v from labels union all select 'quality', quality from labels) group by label""",
)
def q_a22(spark, sf):
    return rounded(profile.label_totals(b.table(spark, sf, "labels"), ["toxic", "quality"]), "pct")


@query("a22_labels_per_row", "select cast(toxic + quality as integer) as n_labels, count(*) as n from labels group by 1")
def q_a22_rows(spark, sf):
    return profile.labels_per_row(b.table(spark, sf, "labels"), ["toxic", "quality"])


WORDS = r"cast(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: length(x) > 0)) as integer)"


@query(
    "a23_text_means_by_class",
    rf"""select toxic, {s6('avg(length(text))', 'chars')}, {s6(f'avg({WORDS})', 'words')},
      {s6("avg(cast(regexp_matches(text, '[A-Z]{3,}') as integer)) * 100", 'caps_pct')}, {s6("avg(cast(regexp_matches(text, '!{2,}') as integer)) * 100", 'exclaim_pct')},
      {s6(r"avg(cast(regexp_matches(text, '\?{2,}') as integer)) * 100", 'question_pct')} from documents join labels using (doc_id) group by toxic""",
)
def q_a23(spark, sf):
    out = profile.text_means(b.labelled_documents(spark, sf), "text", "toxic")
    return rounded(out, "chars", "words", "caps_pct", "exclaim_pct", "question_pct")


@query(
    "a23_train_test_means",
    f"""select l.doc_id is not null as labelled, {s6('avg(length(text))', 'chars')}, {s6(f'avg({WORDS})', 'words')}
      from documents d left join labels l on l.doc_id = d.doc_id group by 1""",
)
def q_a23_split(spark, sf):
    docs = b.table(spark, sf, "documents").join(b.table(spark, sf, "labels").select("doc_id", F.lit(True).alias("_l")), "doc_id", "left")
    flagged = docs.withColumn("labelled", F.coalesce("_l", F.lit(False)))
    return rounded(profile.text_means(flagged, "text", "labelled").select("labelled", "chars", "words"), "chars", "words")


@query("k1_sorted_panel", with_ctes("grid") + "select ra, epi_sunday, cases from grid order by ra, epi_sunday")
def q_k1(spark, sf):
    return b.grid(spark, sf).select("ra", "epi_sunday", "cases").orderBy("ra", "epi_sunday")


@query("k2_top_regions", with_ctes("grid") + "select ra, sum(cases) as cases from grid group by ra order by cases desc, ra limit 10")
def q_k2(spark, sf):
    return b.grid(spark, sf).groupBy("ra").agg(F.sum("cases").alias("cases")).orderBy(F.desc("cases"), "ra").limit(10)


@query(
    "k3_top_customers_by_status",
    "select o_orderstatus, o_orderpriority, count(*) as n from orders group by all order by n desc, 1, 2 limit 5",
)
def q_k3(spark, sf):
    return profile.top_pairs(b.table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", 5)
