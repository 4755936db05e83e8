"""Readers and writers on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from epipanel.operators import learners
from epipanel.operators.textmodels import submission
from epipanel.plans.features import FeatureSet
from epipanel.sources import climate, delimited, results


def test_line_list_encodings_and_column_order(spark, tmp_path):
    head = "x;i_class_final;i_desc_classificacao;i_desc_uf_res;i_desc_radf_res;i_data_prim_sintomas"
    (tmp_path / "a.csv").write_text(f"{head}\n1;Caso Provável;Dengue;df ;Ceilândia;2024-02-14\n", encoding="utf-8")
    other = "i_data_prim_sintomas;i_desc_radf_res;i_desc_uf_res;i_desc_classificacao;i_class_final"
    (tmp_path / "b.csv").write_text(f"{other}\n31/02/2020;São Sebastião;DF;Dengue grave;Caso Provável\n", encoding="latin-1")
    rows = {r.source_file: r for r in delimited.read_line_list(spark, str(tmp_path)).collect()}
    a, b = rows["a.csv"], rows["b.csv"]
    assert (a.class_norm, a.disease_norm, a.uf_norm, a.ra_norm_raw, str(a.epi_sunday), a.ano) == ("CASO PROVAVEL", "DENGUE", "DF", "CEILANDIA", "2024-02-11", 2024)
    assert (b.class_norm, b.ra_norm_raw, b.epi_sunday) == ("CASO PROVAVEL", "SAO SEBASTIAO", None)


def test_line_list_missing_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    with pytest.raises(ValueError):
        delimited.read_line_list(spark, str(tmp_path))


def test_population(spark, tmp_path):
    (tmp_path / "p.csv").write_text("RA,ano,populacao\nGuará,2020,100\n", encoding="utf-8")
    assert tuple(delimited.read_population(spark, str(tmp_path / "p.csv")).first()) == ("GUARA", "Guará", 2020, 100)


def test_climate_series(spark, tmp_path):
    (tmp_path / "w.csv").write_text("epi_sunday,temp_max,temp_min,temp_mean,precip_sum\n2020-01-05,1,1,20,3\n2020-01-12,1,1,21,4\n2020-01-19,1,1,22,5\n")
    (tmp_path / "s.csv").write_text("SE,data_iniSE,umidmed,umidmin,umidmax\n1,2020-01-05,60,50,70\n1,2020-01-05,60,50,70\n3,2020-01-19,80,50,90\n")
    series = climate.climate_series(climate.read_weekly_weather(spark, str(tmp_path / "w.csv")), climate.read_surveillance(spark, str(tmp_path / "s.csv")))
    assert [r.umidmed for r in series.orderBy("epi_sunday").collect()] == [60.0, 70.0, 80.0]


def test_weather_payload(spark, tmp_path):
    doc = {"daily": {"time": ["2020-01-05", "2020-01-06"], "temperature_2m_max": [3, 5], "temperature_2m_min": [1, 1], "temperature_2m_mean": [2, 3], "precipitation_sum": [0.5, 1.5]}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    week = climate.weekly_weather(climate.read_payload(spark, str(tmp_path / "d.json"))).first()
    assert (week.temp_max, week.temp_mean, week.precip_sum) == (4.0, 2.5, 2.0)


def test_notifications(spark, tmp_path):
    (tmp_path / "n.csv").write_text("SG_UF,SG_UF_NOT,CLASSI_FIN,DT_SIN_PRI,Z\n53,53,10,2017-01-05,ç\nSP,53,x,2017-01-09,a\n", encoding="latin-1")
    rows = delimited.read_notifications(spark, str(tmp_path / "n.csv")).orderBy("DT_SIN_PRI").collect()
    assert [(r.code, str(r.epi_sunday)) for r in rows] == [(10, "2017-01-01"), (None, "2017-01-08")]


def test_national_series_and_text(spark, tmp_path):
    (tmp_path / "d.csv").write_text("data_epi,pais,regiao,uf,casos\n2025-12-28,Brasil,Sul,PR,3\n2026-01-04,Brasil,Sul,PR,4\n")
    assert [r.y for r in delimited.read_national_series(spark, str(tmp_path / "d.csv"), "2026-01-01").collect()] == [3.0]
    (tmp_path / "t.csv").write_text('id,comment_text,toxic\na,"two\nlines, ""quoted""",1\n')
    row = delimited.read_labelled_text(spark, str(tmp_path / "t.csv"), ["toxic"]).first()
    assert (row.comment_text, row.toxic) == ('two\nlines, "quoted"', 1)


def test_result_tables(spark, tmp_path):
    root = str(tmp_path)
    results.write_result(spark.range(2), root, "t", "20240101_0000")
    results.write_result(spark.range(3), root, "t", "20240102_0000")
    results.write_result(spark.range(5), root, "t", "20240102_0000")
    assert results.read_result(spark, root, "t").count() == 5
    assert results.read_result(spark, root, "t", "20240101_0000").count() == 2
    results.write_panel(spark.range(4).withColumn("ano", F.lit(2020)), f"{root}/panel")
    assert spark.read.parquet(f"{root}/panel").filter("ano = 2020").count() == 4
    results.write_json(spark.range(1), f"{root}/j")
    assert results.read_json(spark, f"{root}/j", "id long").first().id == 0


def test_model_round_trip(spark, tmp_path):
    features = FeatureSet("tiny", "cases", ("a",))
    rows = [(float(i), float(i), "A", 1, f"2020-01-{i + 1:02d}") for i in range(10)]
    df = spark.createDataFrame(rows, "a double, cases double, ra string, populacao int, d string").withColumn("epi_sunday", F.to_date("d"))
    fitted = learners.fit(df, features, "RF", {"n_estimators": 2, "max_depth": 2})
    results.save_model(fitted, str(tmp_path / "k=1"), config="tiny", features=["a"])
    back, meta = results.load_model(spark, str(tmp_path / "k=1"))
    assert meta == {"config": "tiny", "features": ["a"]}
    want = [r.prediction for r in learners.predict(fitted, df, features).orderBy("a").collect()]
    assert [r.prediction for r in learners.predict(back, df, features).orderBy("a").collect()] == want


def test_submission(spark, tmp_path):
    scores = spark.createDataFrame([("x", "toxic", 0.1), ("x", "quality", 0.7)], "id string, label string, score double")
    wide = submission(scores, "id", ["toxic", "quality"])
    results.write_submission(wide, str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s"), header=True).first().asDict() == {"id": "x", "toxic": "0.1", "quality": "0.7"}


def test_quoted_records_are_split(spark, tmp_path):
    """Small splits of files whose fields hold line breaks: the rows of a reader that takes whole files."""
    import csv
    import random

    rng = random.Random(4)
    for name, eol in (("a", "\n"), ("b", "\r\n")):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=eol)
            out.writerow(["id", "comment_text", "toxic"])
            for k in range(300):
                text = "".join(rng.choice(["x", "é ", '"', "\n", ",", "\n\n", "word "]) for _ in range(rng.choice([0, 3, 40, 400 if k % 50 == 0 else 10])))
                out.writerow([f"{name}{k}", text, k % 2])
    with open(tmp_path / "a.csv", newline="", encoding="utf-8") as f:
        want = {r[0]: r[1] for r in csv.reader(f)}
    with open(tmp_path / "b.csv", newline="", encoding="utf-8") as f:
        want |= {r[0]: r[1] for r in csv.reader(f)}
    want.pop("id")
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "40"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = delimited.read_labelled_text(spark, str(tmp_path), ["toxic"])
        got = {r.id: r.comment_text for r in df.collect()}
        from epipanel.sources.records import text_lines

        assert text_lines(spark, str(tmp_path)).select("path", "block").distinct().count() > 10
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert {k: v or "" for k, v in got.items()} == {k: v for k, v in want.items()}


def test_line_lists_of_many_files(spark, tmp_path):
    head = ["i_class_final", "i_desc_classificacao", "i_desc_uf_res", "i_desc_radf_res", "i_data_prim_sintomas"]
    for k in range(60):
        names = head[k % 5 :] + ["extra"] + head[: k % 5]
        row = {**{h: f"{h}{k}" for h in head}, "extra": '"a;b"', "i_desc_radf_res": "Ceilândia"}
        (tmp_path / f"f {k}.csv").write_text(";".join(names) + "\n" + ";".join(row[n] for n in names) + "\n", encoding="latin-1" if k % 3 else "utf-8")
    rows = delimited.read_columns(spark, str(tmp_path), delimited.CASE_COLUMNS).collect()
    assert len(rows) == 60 and {r.i_desc_radf_res for r in rows} == {"Ceilândia"}
    assert {(r.source_file, r.i_class_final) for r in rows} == {(f"f {k}.csv", f"i_class_final{k}") for k in range(60)}
