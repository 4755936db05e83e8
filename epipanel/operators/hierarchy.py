"""Hierarchical series: level aggregates and forecast reconciliation.

A node frame has ``unique_id``, ``level`` (1 = top), ``parent_id``, ``ds``, a
value column and ``ancestors`` (ids from the top down to the node itself). The
summing matrix is implied by them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.scalars import ratio
from epipanel.session import reliable_checkpoint

SEP = "/"
NOT_GIVEN = "NOT GIVEN"


def member(name: str) -> Column:
    """A level's member as part of an id: separators inside are escaped, a null is a member of its own."""
    return F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit(NOT_GIVEN)), r"([\\/])", r"\\$1")


def aggregate_levels(df: DataFrame, levels: list[str], ds: str = "ds", y: str = "y") -> DataFrame:
    """Sums at every level of a tree by grouping sets, with each node's parent and ancestors (itself last).

    Rows are summed to the leaves first, so the level expansion multiplies leaf
    rows and not input rows. Ids are only ever compared, never taken apart, so a
    name may hold the separator; rows without a member count under ``NOT_GIVEN``.
    """
    leaves = df.select(*[member(c).alias(c) for c in levels], ds, y).groupBy(*levels, ds).agg(F.sum(y).alias(y))
    sets = [[*levels[:i], ds] for i in range(1, len(levels) + 1)]
    depth = sum((1 - F.grouping(c) for c in levels[1:]), 1 - F.grouping(levels[0]))
    nodes = leaves.groupingSets(sets, *levels, ds).agg(F.sum(y).alias(y), depth.cast("int").alias("level"))
    ids = F.array(*[F.concat_ws(SEP, *levels[:i]) for i in range(1, len(levels) + 1)])
    placed = nodes.withColumn("ancestors", F.slice(ids, F.lit(1), F.col("level")))
    return placed.select(
        F.get("ancestors", F.col("level") - 1).alias("unique_id"), "level", F.get("ancestors", F.col("level") - 2).alias("parent_id"), ds, y, "ancestors"
    )


def crossed_totals(df: DataFrame, dims: list[str], ds: str = "ds", y: str = "y") -> DataFrame:
    """Totals of every combination of the dimensions per week (cube)."""
    leaves = df.groupBy(*dims, ds).agg(F.sum(y).alias(y))
    names = [F.when(F.grouping(d) == 1, F.lit("*")).otherwise(F.col(d)).alias(f"_{d}") for d in dims]
    cubed = leaves.groupingSets(_subsets(dims, ds), *dims, ds).agg(F.sum(y).alias(y), *names)
    return cubed.select(*[F.col(f"_{d}").alias(d) for d in dims], ds, y)


def _subsets(dims: list[str], ds: str) -> list[list[str]]:
    sets = [[ds]]
    for d in dims:
        sets += [[d, *s] for s in sets]
    return sets


def bottom_up(base: DataFrame, leaf_level: int, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Every node is the sum of its leaves' forecasts."""
    leaves = base.filter(F.col("level") == leaf_level)
    up = leaves.select(F.explode("ancestors").alias("unique_id"), "ds", value)
    sums = up.groupBy("unique_id", "ds").agg(F.sum(value).alias(out))
    return base.join(sums, ["unique_id", "ds"])


def with_sibling_share(base: DataFrame, value: str = "yhat") -> DataFrame:
    """Node forecast over the sum of its siblings' forecasts, per date."""
    sums = base.groupBy("parent_id", "ds").agg(F.sum(value).alias("_siblings"))
    return base.join(sums, ["parent_id", "ds"], "left").withColumn("_share", ratio(F.col(value), F.col("_siblings"))).drop("_siblings")


def _spread_down(base: DataFrame, level: int, value: str, out: str) -> DataFrame:
    """Nodes from ``level`` down: the forecast of their node there times the shares on the way, in one pass over ``ancestors``."""
    below = base.filter(F.col("level") >= level)
    shared = with_sibling_share(below, value)
    factor = F.when(F.col("level") == level, F.col(value)).otherwise(F.col("_share"))
    factors = shared.select(F.col("unique_id").alias("_on"), "ds", F.col("level").alias("_level"), factor.alias("_factor"))
    way = below.select("unique_id", "ds", F.explode(F.slice("ancestors", level, F.size("ancestors"))).alias("_on"))
    steps = way.join(factors, ["_on", "ds"]).groupBy("unique_id", "ds").agg(F.sort_array(F.collect_list(F.struct("_level", "_factor"))).alias("_steps"))
    product = F.aggregate("_steps", F.lit(1.0), lambda a, s: a * s["_factor"])
    return below.join(steps.select("unique_id", "ds", product.alias(out)), ["unique_id", "ds"])


def top_down(base: DataFrame, leaf_level: int, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Forecast proportions: the top forecast split along each node's ancestors."""
    return _spread_down(base.filter(F.col("level") <= leaf_level), 1, value, out)


def middle_out(base: DataFrame, middle: int, leaf_level: int, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Bottom-up above a chosen level, forecast proportions below it."""
    below = _spread_down(base.filter(F.col("level") <= leaf_level), middle, value, out)
    above = bottom_up(base.filter(F.col("level") <= middle), middle, value, out).filter(F.col("level") < middle)
    return above.unionByName(below.select(above.columns))


def average_share_top_down(base: DataFrame, history: DataFrame, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Top forecast times the historical mean share of each node."""
    top = history.filter(F.col("level") == 1).select("ds", F.col("y").alias("_top"))
    shares = history.join(top, "ds").groupBy("unique_id").agg(F.avg(ratio(F.col("y"), F.col("_top"))).alias("_share"))
    top_hat = base.filter(F.col("level") == 1).select("ds", F.col(value).alias("_hat"))
    return base.join(shares, "unique_id").join(top_hat, "ds").withColumn(out, F.col("_hat") * F.col("_share")).drop("_share", "_hat")


def residual_variances(residuals: DataFrame) -> DataFrame:
    """Mean squared in-sample residual per series."""
    return residuals.groupBy("unique_id").agg(F.avg(F.pow("residual", F.lit(2.0))).alias("variance"))


def wls_two_level(base: DataFrame, variances: DataFrame, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Diagonal minimum-trace form of a parent and its children, closed form.

    With gap d = parent - sum of children and v = total variance, each child
    moves by its share of v times d and the parent moves back by its own.
    """
    nodes = base.join(variances, "unique_id")
    child = nodes.filter(F.col("parent_id").isNotNull())
    sums = child.groupBy(F.col("parent_id").alias("_p"), "ds").agg(F.sum(value).alias("_sum"), F.sum("variance").alias("_var"))
    tops = nodes.filter(F.col("parent_id").isNull()).select(
        F.col("unique_id").alias("_p"), "ds", F.col(value).alias("_top"), F.col("variance").alias("_topvar")
    )
    move = tops.join(sums, ["_p", "ds"]).select(
        "_p", "ds", F.try_divide(F.col("_top") - F.col("_sum"), F.col("_topvar") + F.col("_var")).alias("_unit")
    )
    keyed = nodes.withColumn("_p", F.coalesce("parent_id", "unique_id"))
    sign = F.when(F.col("parent_id").isNull(), -1.0).otherwise(1.0)
    shift = F.coalesce(F.col("_unit"), F.lit(0.0)) * F.col("variance") * sign
    return keyed.join(move, ["_p", "ds"]).withColumn(out, F.col(value) + shift).drop("_p", "_unit", "variance")


def wls_tree(base: DataFrame, variances: DataFrame, leaf_level: int, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Diagonal minimum-trace form of a tree of any depth, in two passes over its edges.

    Upwards, a node weighs its own forecast against the sum of its children's
    weighed forecasts by their variances. Downwards, what a parent moved by is
    shared among its children by theirs. Exact, with no matrix and no bound on
    the number of series.
    """
    nodes = reliable_checkpoint(base.join(variances, "unique_id"))
    v, y = F.col("variance"), F.col(value)
    ups = {leaf_level: nodes.filter(F.col("level") == leaf_level).withColumns({"_m": y, "_s": v})}
    for level in range(leaf_level - 1, 0, -1):
        sums = ups[level + 1].groupBy(F.col("parent_id").alias("unique_id"), "ds").agg(F.sum("_m").alias("_kids"), F.sum("_s").alias("_kids_var"))
        total = v + F.col("_kids_var")
        weighed = F.coalesce(F.try_divide(y * F.col("_kids_var") + F.col("_kids") * v, total), F.col("_kids"))
        own = nodes.filter(F.col("level") == level).join(sums, ["unique_id", "ds"])
        ups[level] = own.withColumns({"_m": weighed, "_s": F.coalesce(F.try_divide(v * F.col("_kids_var"), total), F.lit(0.0))})
    done = ups[1].withColumn(out, F.col("_m"))
    parts = [done.select(*base.columns, out)]
    for level in range(2, leaf_level + 1):
        moved = done.select(F.col("unique_id").alias("parent_id"), "ds", (F.col(out) - F.col("_kids")).alias("_move"), F.col("_kids_var").alias("_among"))
        share = F.coalesce(F.try_divide(F.col("_s"), F.col("_among")), F.lit(0.0))
        done = ups[level].join(moved, ["parent_id", "ds"]).withColumn(out, F.col("_m") + share * F.col("_move"))
        parts.append(done.select(*base.columns, out))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _sums_of(rows: DataFrame, product: Callable[[pa.RecordBatch], dict[str, np.ndarray]], shapes: dict[str, tuple[int, int]]) -> dict[str, np.ndarray]:
    """Matrices summed over all rows: every task adds up its own, Spark their entries; as large as the calendar."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {name: np.zeros(shape) for name, shape in shapes.items()}
        for part in parts:
            if part.num_rows:
                for name, value in product(part).items():
                    total[name] += value
        for name, value in total.items():
            for i, row in enumerate(value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(row)), pa.array([i] * len(row), pa.int32()), pa.array(range(len(row)), pa.int32()), pa.array(row)], names=["name", "i", "j", "v"]
                )

    out = {name: np.zeros(shape) for name, shape in shapes.items()}
    for r in rows.mapInArrow(run, "name string, i int, j int, v double").groupBy("name", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["name"]][r["i"], r["j"]] = r["v"]
    return out


def _lists(part: pa.RecordBatch, column: str) -> np.ndarray:
    return part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _vectors(rows: DataFrame, dates: list, value: str, out: str) -> DataFrame:
    """(unique_id, out): a series' values at ``dates`` in order, zero where there is none."""
    entries = F.map_from_entries(F.collect_list(F.struct("ds", F.col(value).cast("double").alias("v"))))
    at = F.transform(F.lit(dates), lambda d: F.coalesce(F.try_element_at("_m", d), F.lit(0.0)))
    return rows.groupBy("unique_id").agg(entries.alias("_m")).select("unique_id", at.alias(out))


def shrinkage(vectors: DataFrame, weeks: int) -> tuple[float, float, int]:
    """(weight of the diagonal, mean variance, number of series) of the residual vectors ``u``.

    Schaefer-Strimmer weight, from one weeks x weeks matrix: the sum of all squared correlations is that of the
    squared entries of the weeks' products, and the sum over pairs of z_i^2 z_j^2 that of each week's squared sum.
    """

    def product(part: pa.RecordBatch) -> dict[str, np.ndarray]:
        u = _lists(part, "u")
        sd = u.std(axis=1, ddof=1)
        z = np.where(sd[:, None] > 0, (u - u.mean(axis=1, keepdims=True)) / np.where(sd > 0, sd, 1.0)[:, None], 0.0)
        square = (u / np.where(sd > 0, sd, 1.0)[:, None]) ** 2
        rest = np.array([[len(u), (sd > 0).sum(), (sd**2).sum()]])
        return {"gram": z.T @ z, "square": square.sum(0)[None, :], "fourth": (square**2).sum(0)[None, :], "rest": rest}

    sums = _sums_of(vectors, product, {"gram": (weeks, weeks), "square": (1, weeks), "fourth": (1, weeks), "rest": (1, 3)})
    m, live, variance = sums["rest"][0]
    n = weeks
    correlations = (sums["gram"] ** 2).sum() / (n - 1) ** 2 - live
    spread = n / (n - 1) ** 3 * ((sums["square"] ** 2 - sums["fourth"]).sum() - n * ((n - 1) / n) ** 2 * correlations)
    weight = float(np.clip(spread / correlations, 0.0, 1.0)) if correlations > 1e-12 else 1.0
    return weight, variance / m, int(m)


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution of a symmetric positive definite system by elimination, row by row.

    As large as the calendar. Plain array steps: a threaded LAPACK was seen to stand still next to the driver's JVM.
    """
    work = np.hstack([a, b])
    n = len(a)
    for k in range(n):
        work[k] /= work[k, k]
        work[k + 1 :] -= np.multiply.outer(work[k + 1 :, k], work[k])
    for k in range(n - 1, 0, -1):
        work[:k, n:] -= np.multiply.outer(work[:k, k], work[k, n:])
    return work[:, n:]


def min_trace(base: DataFrame, residuals: DataFrame, leaf_level: int, value: str = "yhat", out: str = "rec") -> DataFrame:
    """Minimum-trace reconciliation with shrunk covariance, for any number of series.

    The shrunk covariance is a diagonal plus the weeks' residuals: W = D + U U'. Reconciling under D alone is
    ``wls_tree``, two passes over the edges; done to the forecasts and to each week's residuals alike, it leaves
    one weeks x weeks system (the Woodbury identity), which is all that the driver solves. Missing residuals
    read as zero. The calendar is held whole, the series never.
    """
    spark = base.sparkSession
    weeks = [r[0] for r in residuals.select("ds").distinct().orderBy("ds").collect()]
    dates = [r[0] for r in base.select("ds").distinct().orderBy("ds").collect()]
    if len(weeks) < 2 or not dates:
        raise ValueError("two weeks of residuals and a forecast are needed")
    vectors = reliable_checkpoint(_vectors(residuals, weeks, "residual", "u"))
    weight, variance, _ = shrinkage(vectors, len(weeks))
    floor = 1e-8 * max(variance, 1e-12)
    nodes = base.select("unique_id", "level", "parent_id").distinct()
    n = len(weeks)
    mean = F.aggregate("u", F.lit(0.0), lambda a, x: a + x) / n
    centred = vectors.withColumn("mean", mean).withColumn("u", F.transform("u", lambda x: x - F.col("mean")))
    squares = F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x) / (n - 1)
    scale = float(np.sqrt((1 - weight) / (n - 1)))
    known = nodes.join(centred, "unique_id", "left").select(
        "unique_id", "level", "parent_id",
        (F.coalesce(squares, F.lit(0.0)) * weight + floor).alias("variance"),
        F.coalesce(F.transform("u", lambda x: x * scale), F.array_repeat(F.lit(0.0), n)).alias("u"),
    )
    known = reliable_checkpoint(known)
    past = known.select("unique_id", "level", "parent_id", F.posexplode("u").alias("at", "v")).withColumn("ds", F.col("at"))
    ahead = base.select("unique_id", "level", "parent_id", (F.array_position(F.lit(dates), F.col("ds")).cast("int") + (n - 1)).alias("ds"), F.col(value).alias("v"))
    both = past.drop("at").unionByName(ahead)
    plain = reliable_checkpoint(wls_tree(both, known.select("unique_id", "variance"), leaf_level, "v", "r").select("unique_id", "ds", "v", "r"))
    places = list(range(n + len(dates)))
    rows = (
        _vectors(plain, places, "v", "v").join(_vectors(plain, places, "r", "r"), "unique_id")
        .join(known.select("unique_id", "variance"), "unique_id")
    )
    rows = reliable_checkpoint(rows)

    def product(part: pa.RecordBatch) -> dict[str, np.ndarray]:
        v, r, d = _lists(part, "v"), _lists(part, "r"), part.column("variance").to_numpy()
        return {"system": (v[:, :n] / d[:, None]).T @ (v - r)}

    system = _sums_of(rows, product, {"system": (n, len(places))})["system"]
    z = spark.sparkContext.broadcast(_solved(np.eye(n) + system[:, :n], system[:, n:]))

    def settle(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            r = _lists(part, "r")
            fixed = r[:, n:] - r[:, :n] @ z.value
            k = len(dates)
            ids = part.column("unique_id").take(pa.array(np.repeat(np.arange(part.num_rows), k)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(k), part.num_rows), pa.int32()), pa.array(fixed.ravel())], names=["unique_id", "at", out])

    kind = base.schema["unique_id"].dataType.simpleString()
    fixed = rows.select("unique_id", "r").mapInArrow(settle, f"unique_id {kind}, at int, {out} double")
    dated = fixed.select("unique_id", F.get(F.lit(dates), F.col("at")).alias("ds"), out)
    return base.join(dated, ["unique_id", "ds"])
