"""Hand-checked formulas and edge rows."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from epipanel.functions import text
from epipanel.functions.calendar import iso_week, parse_day, week_start
from epipanel.operators import conformal, forests, hierarchy, learners, metrics, panel, ranks, recursion, regions, series, splits, targets
from epipanel.plans.features import FeatureSet, feature_set
from epipanel.session import require_columns


def one(df):
    return df.first()[0]


def test_region_names(spark):
    rows = [("São Sebastião",), ("SCIA (Estrutural)",), (" Não Informado ",), (None,), ("Fora",), ("Café",)]
    aliases = regions.alias_table(spark, regions.DEFAULT_ALIASES)
    df = regions.canonical_region(spark.createDataFrame(rows, "raw string"), "raw", aliases)
    got = {r.raw: r.ra for r in df.collect()}
    assert got == {
        "São Sebastião": "SAO SEBASTIAO", "SCIA (Estrutural)": "SCIA", " Não Informado ": None, None: None, "Fora": "FORA", "Café": "CAFE",
    }


def test_week_calendar(spark):
    rows = [("2024-01-07",), ("2024-01-13",), ("31/02/2020",), ("",), (None,)]
    got = [
        (str(r.w), r.i)
        for r in spark.createDataFrame(rows, "d string").select(week_start(parse_day("d")).alias("w"), iso_week(week_start(parse_day("d"))).alias("i")).collect()
    ]
    assert got == [("2024-01-07", 1)] * 2 + [("None", None)] * 3


def test_state_code(spark):
    rows = [("53",), (" 53 ",), ("df ",), ("SP",), (None,)]
    df = spark.createDataFrame(rows, "c string").select(regions.is_state("c").alias("x"))
    assert [r.x for r in df.collect()] == [True, True, True, False, False]


def test_masks_and_unknown_target(spark):
    d = targets.CaseDefinition()
    rows = [("CASO PROVAVEL", "DENGUE"), ("CASO PROVAVEL", "DENGUE GRAVE"), ("CASO PROVAVEL", "OUTRO"), ("CASO DESCARTADO", "DENGUE"), (None, None)]
    df = spark.createDataFrame(rows, "class_norm string, disease_norm string").select(*[m.alias(n) for n, m in d.masks().items()])
    assert [tuple(r) for r in df.collect()] == [
        (True, True, True), (True, False, True), (True, False, False), (False, False, False), (False, False, False),
    ]
    with pytest.raises(ValueError):
        d.mask("other")
    with pytest.raises(ValueError):
        feature_set("other")
    with pytest.raises(ValueError):
        learners.make_regressor("SVM")
    with pytest.raises(ValueError):
        require_columns(df, "missing")


def test_model_factory(spark):
    rf = learners.make_regressor("RF")
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getFeatureSubsetStrategy()) == (150, 15, "all")
    assert learners.make_regressor("RF", {"max_depth": None}).getMaxDepth() == 30
    gbt = learners.make_regressor("XGB", {"learning_rate": 0.1, "colsample_bytree": 0.8})
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.params_.columns) == (200, 4, 0.1, 0.8)


def test_interpolation_matches_pandas(spark):
    values = [None] * 6 + [1.0, None, None, 4.0, 2.0, None, 3.0] + [None] * 3
    days = pd.date_range("2020-01-05", periods=len(values), freq="7D")
    df = spark.createDataFrame([("s", d.date(), v) for d, v in zip(days, values)], "k string, w date, v double")
    got = [r.v for r in series.interpolate(df, ["k"], "w", "v").orderBy("w").collect()]
    want = pd.Series(values, dtype=float).interpolate("linear", limit_direction="forward").bfill(limit=4)
    assert got == [None if math.isnan(x) else pytest.approx(x) for x in want]
    causal = [r.v for r in series.interpolate(df, ["k"], "w", "v", mode="ffill").orderBy("w").collect()]
    assert causal[7:9] == [1.0, 1.0]


def test_coverage_gate(spark):
    df = spark.createDataFrame([("2020-01-05", 1.0), ("2020-01-12", None)], "d string, temp_mean double").withColumn("epi_sunday", F.to_date("d"))
    with pytest.raises(ValueError, match="2020-01-12"):
        series.require_coverage(df, ["temp_mean"])


def test_population_projection_matches_year_by_year(spark):
    out = regions.project_population(spark.createDataFrame([("A", 54321)], "ra string, populacao long"), 2024, 2017, 2026)
    got = {r.ano: r.populacao for r in out.collect()}
    value = {2024: 54321.0}
    for y in (2023, 2022, 2021, 2020):
        value[y] = value[y + 1] / 1.012
    for y in (2019, 2018, 2017):
        value[y] = value[y + 1] / 1.0139
    for y in (2025, 2026):
        value[y] = value[y - 1] * 1.012
    assert got == {y: int(round(v)) for y, v in value.items()}


def frame(spark, y, p, lo=None, hi=None):
    rows = [("A", i, float(a), float(b), *( () if lo is None else (float(lo[i]), float(hi[i])))) for i, (a, b) in enumerate(zip(y, p))]
    cols = "ra string, i int, cases double, prediction double" + ("" if lo is None else ", lower_ci double, upper_ci double")
    return spark.createDataFrame(rows, cols).withColumn("epi_sunday", F.date_add(F.lit("2020-01-05").cast("date"), F.col("i") * 7)).drop("i")


def test_metrics(spark):
    y, p = np.array([0.0, 2, 4, 8]), np.array([1.0, 2, 5, 6])
    row = metrics.consolidated(frame(spark, y, p)).first()
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.mae == pytest.approx(1.0) and row.rmse == pytest.approx(math.sqrt(6 / 4))
    assert row.mape == pytest.approx((0 + 25 + 25) / 3)
    assert row.smape == pytest.approx(np.mean(200 * abs(y - p) / (abs(y) + abs(p) + 1e-8)))
    assert row.peak_value == pytest.approx(np.quantile(y, 0.75)) and row.hit_rate == 1.0
    assert row.coverage is None and row.wis is None


def test_flat_region_gives_null_r2(spark):
    assert one(frame(spark, [0, 0, 0], [1, 0, 2]).agg(metrics.r2())) is None
    assert one(frame(spark, [3], [3]).agg(metrics.r2())) is None


@pytest.mark.parametrize("lo,hi,want", [([0] * 4, [9] * 4, 1.0), ([8] * 4, [9] * 4, 0.0), ([0, 0, 8, 8], [9] * 4, 0.5)])
def test_coverage(spark, lo, hi, want):
    assert one(frame(spark, [1, 2, 3, 4], [1, 2, 3, 4], lo, hi).agg(metrics.coverage())) == want


def test_coverage_without_bands(spark):
    df = frame(spark, [1], [1])
    assert one(metrics.interval_coverage(df, strict=False)) is None
    with pytest.raises(ValueError):
        metrics.interval_coverage(df)


@pytest.mark.parametrize("cover,want", [(0.90, 0.0), (0.70, 0.20), (0.98, 0.08)])
def test_calibration_error(spark, cover, want):
    assert one(spark.range(1).select(metrics.calibration_error(F.lit(cover), 0.10))) == pytest.approx(want)


def test_interval_score_at_least_mean_width(spark):
    df = frame(spark, [1, 9, 3], [1, 2, 3], [0, 1, 2], [2, 3, 4])
    assert one(df.agg(metrics.interval_score(0.1))) == pytest.approx((2 + 2 + 20 * 6 + 2) / 3)


def scores(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(k, float(y), float(abs(y + e))) for k, n in sizes.items() for y, e in zip(rng.integers(0, 20, n), rng.normal(0, 3, n))]
    return spark.createDataFrame(rows, "horizon int, cases double, prediction double"), pd.DataFrame(rows, columns=["k", "y", "p"])


def test_conformal_matches_brute_force(spark):
    df, pdf = scores(spark, {1: 40, 2: 29, 3: 30, 4: 50})
    eps = max(0.10, np.percentile(pdf.p, 10))
    pdf["s"] = (pdf.y - pdf.p).abs() / (pdf.p + eps)
    got = {r.horizon: r for r in conformal.calibrate(df).collect()}
    for k in (1, 2, 3, 4):
        own = pdf.s[pdf.k == k]
        own = own if len(own) >= 30 else pdf.s[pdf.k >= k]
        level = min(1.0, np.ceil((len(own) + 1) * (1 - 0.10)) / len(own))
        assert got[k].n == len(own)
        assert got[k].q == pytest.approx(np.quantile(own, level))
        assert got[k].epsilon == pytest.approx(eps)


def test_bands_floor_and_unknown_horizon(spark):
    df, _ = scores(spark, {1: 40, 4: 40})
    table = conformal.calibrate(df)
    q = {r.horizon: r.q for r in table.collect()}
    eps = table.first().epsilon
    ahead = spark.createDataFrame([(9, 5.0), (1, 0.0)], "horizon int, prediction double")
    got = {r.horizon: r for r in conformal.apply_bands(ahead, table).collect()}
    assert got[9].upper_ci == pytest.approx(5 + q[4] * (5 + eps))
    assert got[1].lower_ci == 0.0 and math.isfinite(got[1].upper_ci)


def test_all_zero_predictions_use_the_floor(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0)] * 40, "horizon int, cases double, prediction double")
    assert conformal.calibrate(df).first().epsilon == 0.10


def test_empty_calibration(spark):
    empty = spark.createDataFrame([], "horizon int, cases double, prediction double")
    with pytest.raises(ValueError):
        conformal.calibrate(empty)
    row = conformal.bands_or_null(spark.createDataFrame([(1, 2.0)], "horizon int, prediction double"), empty).first()
    assert row.lower_ci is None and row.upper_ci is None


def test_calibration_round_trip(spark, tmp_path):
    df, _ = scores(spark, {1: 40, 2: 40})
    table = conformal.calibrate(df)
    conformal.save_calibration(table, str(tmp_path / "c"))
    back = conformal.load_calibration(spark, str(tmp_path / "c"))
    key = lambda d: sorted((r.horizon, r.q, r.epsilon) for r in d.collect())
    assert key(back) == key(table)
    assert conformal.load_calibration(spark, str(tmp_path / "none")) is None


def test_quantiles_ranks_against_numpy(spark):
    rng = np.random.default_rng(3)
    hot = np.concatenate([np.zeros(400), rng.normal(0, 1e-3, 200), rng.lognormal(3, 4, 300), -rng.lognormal(2, 3, 300)])
    cold = rng.normal(5, 1, 50)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "k string, v double")
    levels = {"a": ranks.constant_level(0.1), "b": ranks.constant_level(0.5), "c": ranks.constant_level(1.0)}
    got = {r.k: r for r in ranks.quantiles(ranks.value_counts(df, ["k"], "v"), ["k"], "v", levels).collect()}
    for k, v in (("hot", hot), ("cold", cold)):
        assert [got[k].a, got[k].b, got[k].c] == pytest.approx(list(np.quantile(v, [0.1, 0.5, 1.0])))
    counts = ranks.value_counts(df, ["k"], "v")
    mine = {(r.k, r.v): r.rank for r in ranks.average_ranks(counts, ["k"], "v").collect()}
    want = pd.Series(hot).rank().to_numpy()
    assert all(mine["hot", v] == r for v, r in zip(hot, want))


def test_spearman_and_auc_brute_force(spark):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 6, 300), rng.integers(0, 4, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    want = np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
    assert ranks.spearman(df, [], "x", "y").first().spearman == pytest.approx(want)
    lab = (rng.random(300) < 0.3).astype(int)
    pos, neg = x[lab == 1], x[lab == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    scored = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, lab)], "s double, l int")
    assert ranks.roc_auc(scored, [], "s", "l").first().auc == pytest.approx(want)


def test_folds_respect_gap(spark):
    weeks = [(d.date(),) for d in pd.date_range("2018-01-07", periods=100, freq="7D")]
    df = spark.createDataFrame(weeks, "epi_sunday date")
    rows = splits.expanding_folds(df).collect()
    index = {w[0]: i for i, w in enumerate(weeks)}
    t = 100 // 6
    for fold in range(1, 6):
        val = sorted(index[r.epi_sunday] for r in rows if r.fold == fold and r.role == "validation")
        tr = sorted(index[r.epi_sunday] for r in rows if r.fold == fold and r.role == "train")
        start = 100 - (6 - fold) * t
        assert val == list(range(start, start + t)) and tr == list(range(0, start - 4))


def test_lead_target_drops_tail(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in range(10)], "ra string, w int, cases double")
    rows = series.lead_target(df, ["ra"], "w", "cases", 4, "t").orderBy("w").collect()
    assert [(r.w, r.t) for r in rows] == [(i, float(i + 4)) for i in range(6)]


def test_stratified_split_is_exact(spark):
    df = spark.range(1003).withColumn("c", (F.col("id") % 3 == 0).cast("int"))
    train, rest = splits.stratified_split(df, "id", "c", 0.8)
    ids = {r.id for r in train.collect()} | {r.id for r in rest.collect()}
    assert len(ids) == 1003 and train.count() + rest.count() == 1003
    for c, n in ((0, 668), (1, 335)):
        assert train.filter(f"c = {c}").count() == math.floor(n * 0.8 + 0.5)


def test_null_stratum_is_split_too(spark):
    df = spark.range(100).withColumn("c", F.lit(None).cast("string"))
    train, rest = splits.stratified_split(df, "id", "c", 0.8)
    assert (train.count(), rest.count(), train.columns) == (80, 20, df.columns)


def test_names_with_separator_and_nulls(spark):
    rows = [("R", "SUDOESTE", 2.0), ("R", "SUDOESTE/OCTOGONAL", 5.0), (None, "X", 4.0), ("R/S", "Y", 1.0)]
    df = spark.createDataFrame([("ALL", r, n, dt.date(2024, 1, 7), y) for r, n, y in rows], "top string, region string, nation string, ds date, y double")
    tree = hierarchy.aggregate_levels(df, ["top", "region", "nation"])
    sums = {r.unique_id: r.rec for r in hierarchy.bottom_up(tree, 3, "y").collect()}
    assert sums["ALL"] == 12 and sums["ALL/R"] == 7 and sums["ALL/R/SUDOESTE"] == 2 and sums["ALL/NOT GIVEN"] == 4 and sums["ALL/R\\/S"] == 1
    assert {r.unique_id: r.y for r in tree.collect()} == sums


def test_stations_of_regions(spark):
    weeks = [dt.date(2024, 1, 7) + dt.timedelta(7 * k) for k in range(12)]
    cases = spark.createDataFrame([(w, r, float(k)) for k, w in enumerate(weeks) for r in "AB"], "epi_sunday date, ra string, cases double")
    people = spark.createDataFrame([(r, 2024, 10) for r in "AB"], "ra string, ano int, populacao long")
    climate = spark.createDataFrame([(w, s, 1.0 * k, 1.0, 1.0) for k, w in enumerate(weeks) for s in ("S0", "S1")], "epi_sunday date, station_id string, precip_sum double, temp_mean double, umidmed double")
    span = {"first_week": weeks[0], "as_of": weeks[-1]}
    stations = spark.createDataFrame([("A", "S0"), ("B", "S1")], "ra string, station_id string")
    whole = panel.build_panel(cases, people, climate, stations=stations, **span)
    assert whole.count() == 24 and whole.filter("cases_lag_1 <> cases - 1").count() == 0
    with pytest.raises(Exception, match="several climate rows"):
        panel.build_panel(cases, people, climate, **span).collect()


def test_close_values_get_many_buckets(spark):
    counts = spark.range(20000).select((F.lit(1.7e9) + F.col("id") / 20).alias("v"), F.lit(1.0).alias("n"))
    sizes = ranks.indexed(counts, [], "v").groupBy("_bucket").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] >= 8 and sizes[1] <= 4 * 20000 / sizes[0]


def test_null_score_never_wins(spark):
    rows = spark.createDataFrame([("RF", None, "a"), ("RF", 2.0, "b")], "modelo string, cv_rmse double, params string")
    assert series.best_row(rows, ["modelo"], F.coalesce("cv_rmse", F.lit(float("inf")))).first().params == "b"


@pytest.mark.parametrize("model", ["RF", "XGB"])
def test_flattened_trees_predict_alike(spark, model):
    rng = np.random.default_rng(2)
    rows = [(f"R{k % 4}", float(a), float(b), float(abs(a * 3 + (k % 4) * b)), 10) for k, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "ra string, a double, b double, cases double, populacao int").withColumn("epi_sunday", F.lit("2024-01-07").cast("date"))
    features = FeatureSet("two", "cases", ("a", "b"), region=True)
    fitted = learners.fit(df, features, model, {"n_estimators": 4, "max_depth": 4})
    scored = fitted.transform(df).select(vector_to_array(learners.VECTOR).alias("v"), learners.RAW).toPandas()
    forest = forests.flatten(spark, fitted.stages[-1])
    assert np.allclose(forest.predict(np.vstack(scored.v)), scored[learners.RAW], atol=1e-12)


def test_recursion_in_one_job_equals_steps(spark, monkeypatch):
    weeks = [dt.date(2023, 9, 3) + dt.timedelta(7 * k) for k in range(22)]
    rows = [(r, w, float((3 * k + len(r) * k * k) % 11), 1000) for r in ("A", "BB", "CCC") for k, w in enumerate(weeks)]
    df = spark.createDataFrame(rows, "ra string, epi_sunday date, cases double, populacao long").withColumn("incidencia_100k", F.col("cases") * 100)
    whole = series.add_trend(series.add_lags(df, ["ra"], "epi_sunday", ["cases", "incidencia_100k"], range(1, 5)))
    features = FeatureSet("lags", "cases", ("cases_lag_1", "cases_lag_2", "cases_growth_rate"), region=True)
    fitted = learners.fit(whole.filter("epi_sunday < date'2024-01-01'"), features, "RF", {"n_estimators": 3, "max_depth": 3})

    def forecast():
        return recursion.recursive_forecast(whole, fitted, features, 2024).orderBy("ra", "epi_sunday").toPandas()

    fast = forecast()
    monkeypatch.setattr(forests, "can_flatten", lambda model: False)
    slow = forecast()
    assert len(fast) == 12 and fast.drop(columns="prediction").equals(slow.drop(columns="prediction"))
    assert np.allclose(fast.prediction, slow.prediction, atol=1e-9)


def test_unseen_region_is_all_zero(spark):
    f = feature_set("lag+clima+RA")
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    cols = {c: F.lit(1.0) for c in f.numeric_columns()}
    base = spark.createDataFrame([("A",), ("B",)], "ra string").withColumns(cols)
    fitted = Pipeline(stages=learners.encoder_stages(f)).fit(base)
    got = fitted.transform(spark.createDataFrame([("Z",)], "ra string").withColumns(cols)).select(vector_to_array(learners.VECTOR).alias("v")).first().v
    assert len(got) == len(f.numeric_columns()) + 2 and got[-2:] == [0.0, 0.0]


def test_ngrams(spark):
    row = spark.createDataFrame([("Olá, mundo bom",), ("x",)], "t string").select(
        text.word_ngrams(text.tokens(F.col("t")), 2).alias("w"), text.char_ngrams(F.col("t"), 3).alias("c")
    ).collect()
    assert row[0].w == ["olá mundo", "mundo bom"] and row[1].w == []
    assert row[0].c[:2] == ["Olá", "lá,"] and len(row[0].c) == 12 and row[1].c == []


def test_reconciliation_is_coherent(spark):
    rng = np.random.default_rng(1)
    ids = [("T", 1, None), ("T/a", 2, "T"), ("T/b", 2, "T")] + [(f"T/{p}/{i}", 3, f"T/{p}") for p in "ab" for i in range(3)]
    days = pd.date_range("2020-01-05", periods=40, freq="7D")
    above = {i: [x for x, _, _ in ids if i == x or i.startswith(x + "/")] for i, _, _ in ids}
    base = spark.createDataFrame([(i, l, p, above[i], d.date(), float(rng.random() * 10 + 1)) for i, l, p in ids for d in days[-4:]], "unique_id string, level int, parent_id string, ancestors array<string>, ds date, yhat double")
    resid = spark.createDataFrame([(i, d.date(), float(rng.normal())) for i, _, _ in ids for d in days], "unique_id string, ds date, residual double")
    spread = spark.createDataFrame([(i, float(k % 4) + 0.5) for k, (i, _, _) in enumerate(ids)], "unique_id string, variance double")
    for rec in (hierarchy.wls_tree(base, spread, 3), hierarchy.bottom_up(base, 3), hierarchy.top_down(base, 3), hierarchy.middle_out(base, 2, 3), hierarchy.min_trace(base, resid, 3)):
        pdf = rec.select("unique_id", "parent_id", "ds", "rec").toPandas()
        kids = pdf.groupby(["parent_id", "ds"]).rec.sum()
        for (p, d), total in kids.items():
            assert pdf[(pdf.unique_id == p) & (pdf.ds == d)].rec.iloc[0] == pytest.approx(total)


def dense_min_trace(residuals, yhat, parents):
    """Reconciled forecasts by the whole covariance: residuals weeks x series, yhat dates x series, parents by place."""
    n, m = residuals.shape
    sd = residuals.std(0, ddof=1)
    live = sd > 0
    z = np.where(live, (residuals - residuals.mean(0)) / np.where(live, sd, 1), 0)
    corr = z.T @ z / (n - 1)
    np.fill_diagonal(corr, 1)
    x = residuals / np.where(live, sd, 1)
    cross = (x**2).T @ x**2
    off = ~np.eye(m, dtype=bool)
    spread = n / (n - 1) ** 3 * (cross - n * (corr * (n - 1) / n) ** 2)
    lam = np.clip(spread[off].sum() / (corr[off] ** 2).sum(), 0, 1)
    shrunk = (1 - lam) * corr
    np.fill_diagonal(shrunk, 1)
    w = shrunk * np.outer(sd, sd) + np.eye(m) * 1e-8 * max((sd**2).mean(), 1e-12)
    leaves = [k for k in range(m) if k not in parents.values()]
    above = {k: [k] for k in range(m)}
    for k in leaves:
        at = k
        while at in parents:
            at = parents[at]
            above[k].append(at)
    s = np.array([[float(i in above[k]) for k in leaves] for i in range(m)])
    g = np.linalg.solve(s.T @ np.linalg.solve(w, s), s.T @ np.linalg.inv(w))
    return (s @ g @ yhat.T).T


def test_min_trace_matches_the_dense_form(spark):
    rng = np.random.default_rng(7)
    ids = ["T"] + [f"T/{p}" for p in "abcdef"] + [f"T/{p}/{i}" for p in "abcdef" for i in range(7)]
    parents = {k: ids.index(i.rsplit("/", 1)[0]) for k, i in enumerate(ids) if "/" in i}
    m, n, ahead = len(ids), 30, 3
    resid = rng.normal(size=(n, 4)) @ rng.normal(size=(4, m)) + rng.normal(size=(n, m)) * rng.uniform(0.2, 2, m)
    yhat = rng.uniform(1, 10, (ahead, m))
    days = [d.date() for d in pd.date_range("2020-01-05", periods=n + ahead, freq="7D")]
    level = [i.count("/") + 1 for i in ids]
    base = spark.createDataFrame(
        [(i, level[k], ids[parents[k]] if k in parents else None, days[n + t], float(yhat[t, k])) for k, i in enumerate(ids) for t in range(ahead)],
        "unique_id string, level int, parent_id string, ds date, yhat double",
    )
    past = spark.createDataFrame([(i, days[t], float(resid[t, k])) for k, i in enumerate(ids) for t in range(n)], "unique_id string, ds date, residual double")
    got = {(r.unique_id, r.ds): r.rec for r in hierarchy.min_trace(base, past, 3).collect()}
    want = dense_min_trace(resid, yhat, parents)
    assert len(got) == m * ahead
    assert all(got[i, days[n + t]] == pytest.approx(want[t, k], abs=1e-6) for k, i in enumerate(ids) for t in range(ahead))


def test_min_trace_of_unrelated_residuals_is_the_diagonal_form(spark):
    """Weeks in which one series errs at a time: the covariance off the diagonal is all shrunk away."""
    ids = ["T", "T/a", "T/b"]
    days = [d.date() for d in pd.date_range("2020-01-05", periods=25, freq="7D")]
    signs = {(t, k): (1.0 if t // 3 % 2 else -1.0) * (k + 1) if t % 3 == k else 0.0 for t in range(24) for k in range(3)}
    past = spark.createDataFrame([(ids[k], days[t], v) for (t, k), v in signs.items()], "unique_id string, ds date, residual double")
    base = spark.createDataFrame([(i, 1 + (k > 0), "T" if k else None, days[24], 10.0 - 3 * k) for k, i in enumerate(ids)], "unique_id string, level int, parent_id string, ds date, yhat double")
    spread = past.groupBy("unique_id").agg(F.var_samp("residual").alias("variance"))
    want = {r.unique_id: r.rec for r in hierarchy.wls_tree(base, spread, 2).collect()}
    got = {r.unique_id: r.rec for r in hierarchy.min_trace(base, past, 2).collect()}
    assert got == {k: pytest.approx(v, abs=1e-5) for k, v in want.items()}


def test_gamma_derivatives(spark):
    from epipanel.functions.scalars import digamma, trigamma

    xs = [1e-3, 0.1, 0.5, 1.0, 2.0, 7.25, 100.0, 1e6]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", digamma(F.col("x")).alias("d"), trigamma(F.col("x")).alias("t")).collect()
    got = {r.x: (r.d, r.t) for r in rows}
    assert got[1.0] == (pytest.approx(-0.5772156649015329, abs=1e-12), pytest.approx(math.pi**2 / 6, abs=1e-12))
    assert got[0.5] == (pytest.approx(-0.5772156649015329 - 2 * math.log(2), abs=1e-12), pytest.approx(math.pi**2 / 2, abs=1e-12))
    for x in xs:  # difference quotients of the log gamma function, and the recurrence
        h = 1e-4 * x
        assert got[x][0] == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), rel=1e-5, abs=1e-6)
    assert got[2.0] == (pytest.approx(got[1.0][0] + 1, abs=1e-12), pytest.approx(got[1.0][1] - 1, abs=1e-12))


def test_rolling_quantiles_brute_force(spark):
    rng = np.random.default_rng(11)
    weeks = [dt.date(2023, 1, 1) + dt.timedelta(7 * k) for k in range(40)]
    rows = [(w, float(y), float(p)) for w in weeks if w.month != 5 for y, p in zip(rng.integers(0, 9, 5), rng.uniform(0, 8, 5))]
    rows += [(weeks[3], 2.0, 2.0)] * 30
    got = {r.epi_sunday: r for r in conformal.rolling_calibration(spark.createDataFrame(rows, "epi_sunday date, cases double, prediction double"), 6).collect()}
    for w in {r[0] for r in rows}:
        own = [abs(y - p) / (p + 0.1) for v, y, p in rows if w - dt.timedelta(42) <= v <= w - dt.timedelta(7)]
        if not own:
            assert w not in got
            continue
        level = min(1.0, math.ceil((len(own) + 1) * 0.9) / len(own))
        assert got[w].n == len(own) and got[w].q == pytest.approx(np.quantile(own, level))


def plain_boosting(x, y, rounds, rate, depth, penalty, own=None):
    """Second-order boosting with every value a cut, node by node."""
    out = np.full(len(y), y.mean())
    models = []
    for _ in range(rounds):
        g = out - y

        def grow(rows, left_depth):
            value = -rate * g[rows].sum() / (len(rows) + penalty)
            best = (1e-6, None)
            for f in own if own is not None else range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    gain = g[a].sum() ** 2 / (len(a) + penalty) + g[b].sum() ** 2 / (len(b) + penalty) - g[rows].sum() ** 2 / (len(rows) + penalty)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, cut, a, b))
            if left_depth == 0 or best[1] is None:
                return value
            f, cut, a, b = best[1]
            return (f, cut, grow(a, left_depth - 1), grow(b, left_depth - 1))

        tree = grow(np.arange(len(y)), depth)
        models.append(tree)
        out = out + np.array([walk_tree(tree, row) for row in x])
    return lambda rows: y.mean() + sum(np.array([walk_tree(t, r) for r in rows]) for t in models)


def walk_tree(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_boosting_matches_plain_trees(spark, monkeypatch):
    from epipanel.operators import boosting

    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 60)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 9, 200), rng.normal(size=200).round(1), rng.integers(0, 2, 200)]).astype(float)
    y = x[:, 0] * (x[:, 2] > 0) + np.abs(x[:, 1]) + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(k, r.tolist(), float(v)) for k, (r, v) in enumerate(zip(x, y))], "k int, x array<double>, y double").repartition(3)
    settings = boosting.Boosting(rounds=5, rate=0.3, depth=3, penalty=1.0)
    half = F.col("k") < 120
    jobs = [
        boosting.Job(F.col("y"), F.lit(True), settings), boosting.Job(F.col("y"), half, settings), boosting.Job(F.col("y"), half, boosting.Boosting(rounds=3, rate=0.5, depth=2, penalty=2.0), (0, 2)),
        boosting.Job(F.col("y"), F.lit(False), settings),
    ]
    got = boosting.fit_many(df, jobs)
    assert np.allclose(got[0].predict(x), plain_boosting(x, y, 5, 0.3, 3, 1.0)(x), atol=1e-9)
    assert np.allclose(got[1].predict(x), plain_boosting(x[:120], y[:120], 5, 0.3, 3, 1.0)(x), atol=1e-9)
    assert np.allclose(got[2].predict(x), plain_boosting(x[:120], y[:120], 3, 0.5, 2, 2.0, (0, 2))(x), atol=1e-9)
    assert np.isnan(got[3].predict(x)).all()
    drawn = boosting.fit_many(df, [boosting.Job(F.col("y"), F.lit(True), boosting.Boosting(rounds=4, rate=0.3, depth=2, columns=0.4, rows=0.5))] * 2)
    assert all(len(set(t[t > 0].tolist()) | {0}) <= 3 for t in drawn[0].feature) and not np.allclose(drawn[0].predict(x), drawn[1].predict(x))


def test_soft_targets_of_calibration(spark):
    from pyspark.ml.functions import array_to_vector

    from epipanel.operators import textmodels

    rng = np.random.default_rng(2)
    rows = [(k, float(m), int(m + rng.normal() > 0.3)) for k, m in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "k int, m double, l int").withColumn("_m", array_to_vector(F.array("m")))
    t = textmodels.calibration_targets(df.withColumn("_fold", F.lit(0)), "l").first()
    model = textmodels.sigmoid(df, "l", (t.target_pos, t.target_neg))
    a, b = float(model.coefficients[0]), float(model.intercept)
    m, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    want = np.where(label == 1, t.target_pos, t.target_neg)
    p = 1 / (1 + np.exp(-(a * m + b)))
    assert abs(((p - want) * m).sum()) < 1e-2 and abs((p - want).sum()) < 1e-2  # the gradient of the likelihood is zero
