"""Readers and writers, each by a round trip of a driver table through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from epipanel.catalog.bands import calibration_rows
from epipanel.catalog.registry import query, r6, rounded, s6, with_ctes, wk
from epipanel.functions.calendar import week_start
from epipanel.operators import conformal, learners
from epipanel.operators.textmodels import submission
from epipanel.plans import bindings as b
from epipanel.plans.features import FeatureSet
from epipanel.session import temporary
from epipanel.sources import climate, delimited, results

LATIN = "ISO-8859-1"


def _folder(spark) -> str:
    return temporary(spark, "readers")


def _csv(df, path: str, sep: str = ",", encoding: str = "UTF-8") -> str:
    df.write.mode("append").options(header=True, sep=sep, encoding=encoding).csv(path)
    return path


@query(
    "s1_line_list",
    f"""select case o_orderstatus when 'P' then 'PROVAVEL' else o_orderstatus end as class_norm, o_orderpriority as disease_norm, 'REGIAO ' || o_custkey % 7 as ra_norm_raw,
      {wk('o_orderdate')} as epi_sunday, cast(year(o_orderdate) as integer) as ano, count(*) as n from orders group by all""",
)
def q_s1(spark, sf):
    """Two files of different encoding and column order in one folder."""
    rows = b.table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "Provável").otherwise(F.col("o_orderstatus")).alias("i_class_final"),
        F.col("o_orderpriority").alias("i_desc_classificacao"), F.lit("df ").alias("i_desc_uf_res"),
        F.concat(F.lit("Região "), F.col("o_custkey") % 7).alias("i_desc_radf_res"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("i_data_prim_sintomas"), F.col("o_orderkey").alias("x"),
    )
    folder = _folder(spark)
    _csv(rows.filter("x % 2 = 0").coalesce(2), folder, ";")
    _csv(rows.filter("x % 2 = 1").select(*reversed(rows.columns)).coalesce(2), folder, ";", LATIN)
    read = delimited.read_line_list(spark, folder).filter("uf_norm = 'DF' and source_file like '%.csv'")
    return read.groupBy("class_norm", "disease_norm", "ra_norm_raw", "epi_sunday", "ano").agg(F.count("*").alias("n"))


@query("s2_population", with_ctes("pop") + "select ra, ra as ra_name, ano, populacao from pop")
def q_s2(spark, sf):
    people = b.population(spark, sf).select(F.col("ra").alias("RA"), "ano", "populacao")
    return delimited.read_population(spark, _csv(people, _folder(spark)))


WEEKS = f"""select {wk('l_shipdate')} as epi_sunday, max(l_extendedprice) as temp_max, min(l_extendedprice) as temp_min,
  cast(count(*) as double) as temp_mean, cast(sum(l_quantity) as double) as precip_sum from lineitem group by all"""


def _weeks(spark, sf):
    return b.table(spark, sf, "lineitem").groupBy(week_start("l_shipdate").alias("epi_sunday")).agg(
        F.max("l_extendedprice").alias("temp_max"), F.min("l_extendedprice").alias("temp_min"),
        F.count("*").cast("double").alias("temp_mean"), F.sum("l_quantity").cast("double").alias("precip_sum"),
    )


@query("s3_weekly_weather", WEEKS)
def q_s3(spark, sf):
    return climate.read_weekly_weather(spark, _csv(_weeks(spark, sf), _folder(spark)))


@query(
    "s4_surveillance",
    f"""select {wk('l_shipdate')} as epi_sunday, cast(min(l_quantity) as double) as umidmed, 50.0::double as umidmin, cast(null as double) as umidmax from lineitem group by all""",
)
def q_s4(spark, sf):
    """A week stands in the file once for each quantity; its smallest row is kept."""
    rows = b.table(spark, sf, "lineitem").select(
        F.lit(1).alias("SE"), week_start("l_shipdate").alias("data_iniSE"), F.col("l_quantity").alias("umidmed"),
        F.lit(50).alias("umidmin"), F.lit("n/a").alias("umidmax"),
    ).distinct()
    return climate.read_surveillance(spark, _csv(rows, _folder(spark)))


@query(
    "s5_notifications",
    f"""select case when o_custkey % 3 = 0 then 'SP' else '53' end as "SG_UF", cast(o_custkey % 13 as integer) as code, {wk('o_orderdate')} as epi_sunday, count(*) as n from orders group by all""",
)
def q_s5(spark, sf):
    rows = b.table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 3 == 0, "SP").otherwise("53").alias("SG_UF"), F.lit(53).alias("SG_UF_NOT"),
        (F.col("o_custkey") % 13).alias("CLASSI_FIN"), F.to_date("o_orderdate").alias("DT_SIN_PRI"), F.lit("ção").alias("other"),
    )
    read = delimited.read_notifications(spark, _csv(rows, _folder(spark), encoding=LATIN))
    return read.groupBy("SG_UF", "code", "epi_sunday").agg(F.count("*").alias("n"))


@query(
    "s7_national_series",
    with_ctes("leaves") + "select ds, top as pais, region as regiao, nation as uf, y from leaves where ds < date '2000-01-01'",
)
def q_s7(spark, sf):
    rows = b.hierarchy_leaves(spark, sf).select(
        F.col("ds").alias("data_epi"), F.col("top").alias("pais"), F.col("region").alias("regiao"), F.col("nation").alias("uf"), F.col("y").alias("casos")
    )
    return delimited.read_national_series(spark, _csv(rows, _folder(spark)), "2000-01-01")


@query("s10_panel_sink", with_ctes("grid") + "select ra, epi_sunday, cases, cast(year(epi_sunday) as integer) as ano from grid")
def q_s10(spark, sf):
    path = _folder(spark)
    results.write_panel(b.grid(spark, sf).withColumn("ano", F.year("epi_sunday")), path)
    return spark.read.parquet(path)


@query("s11_run_versions", with_ctes("grid") + "select ra, epi_sunday, cases * 2 as cases, '20240102_0000' as run_id from grid")
def q_s11(spark, sf):
    """An older run and a repeated newer one: the latest rows of the newest run come back."""
    root, rows = _folder(spark), b.grid(spark, sf).select("ra", "epi_sunday", "cases")
    results.write_result(rows, root, "grid", "20240101_0000")
    results.write_result(rows.withColumn("cases", F.col("cases") + 7), root, "grid", "20240102_0000")
    results.write_result(rows.withColumn("cases", F.col("cases") * 2), root, "grid", "20240102_0000")
    return results.read_result(spark, root, "grid")


@query("s12_json_tables", with_ctes("grid") + "select ra, min(epi_sunday) as first_week, sum(cases) as cases from grid group by ra")
def q_s12(spark, sf):
    path = _folder(spark)
    table = b.grid(spark, sf).groupBy("ra").agg(F.min("epi_sunday").alias("first_week"), F.sum("cases").alias("cases"))
    results.write_json(table, path)
    return results.read_json(spark, path, "ra string, first_week date, cases double")


@query("s13_model_round_trip", with_ctes("grid") + "select 'lagged' as config, count(*) as n_equal from (select lag(cases) over (partition by ra order by epi_sunday) as x from grid) where x is not null")
def q_s13(spark, sf):
    """Rows whose prediction a loaded model repeats; all of them if nothing was lost."""
    features = FeatureSet("lagged", "cases", ("cases_lag_1",))
    rows = b.full_panel(spark, sf).select("ra", "epi_sunday", "populacao", "cases", "cases_lag_1").dropna()
    fitted = learners.fit(rows, features, "RF", {"n_estimators": 3, "max_depth": 3})
    path = _folder(spark)
    results.save_model(fitted, path, config="lagged")
    loaded, about = results.load_model(spark, path)
    again = learners.predict(loaded, rows, features).select("ra", "epi_sunday", F.col("prediction").alias("again"))
    same = learners.predict(fitted, rows, features).join(again, ["ra", "epi_sunday"]).filter("prediction = again")
    return same.agg(F.count("*").alias("n_equal")).select(F.lit(about["config"]).alias("config"), "n_equal")


@query(
    "s14_submission",
    f"select doc_id, {s6('n_chars / 33333.0::double', 'toxic')}, {s6('(doc_id % 100) / 100.0::double', 'quality')} from documents",
)
def q_s14(spark, sf):
    docs = b.table(spark, sf, "documents")
    scores = docs.select("doc_id", F.lit("toxic").alias("label"), (F.col("n_chars") / 33333.0).alias("score")).unionByName(
        docs.select("doc_id", F.lit("quality").alias("label"), (F.col("doc_id") % 100 / 100.0).alias("score"))
    )
    path = _folder(spark)
    results.write_submission(submission(scores, "doc_id", ["toxic", "quality"]), path)
    return rounded(spark.read.schema("doc_id long, toxic double, quality double").csv(path, header=True), "toxic", "quality")


@query("c3_saved_calibration", with_ctes("calibration") + f"select cast(horizon as integer) as horizon, {s6('q', 'q')} from calibration")
def q_c3(spark, sf):
    path = _folder(spark)
    conformal.save_calibration(conformal.calibrate(calibration_rows(spark, sf)), path)
    return conformal.load_calibration(spark, path).select("horizon", r6("q").alias("q"))
