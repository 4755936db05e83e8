"""Exact ranks, distribution functions and quantiles without a one-task sort.

Every operator here starts from a table of distinct values with counts, so a
value shared by a third of all rows is one row. It is dealt by range of (key,
value) once and written: each (key, range) is sorted on its own, and only the
ranges' totals are accumulated in order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.session import reliable_checkpoint


def indexed(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``counts`` written by ranges of (keys, value), with the number of each row's range as ``_bucket``.

    Ranges only decide where the ordered pass is cut, so results do not depend on how even they are; what
    lies in a range is read from the written table, never dealt anew.
    """
    if "_bucket" in counts.columns:
        return counts
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reliable_checkpoint(counts.repartitionByRange(n, *keys, value).withColumn("_bucket", F.spark_partition_id()))


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **sums: Column) -> DataFrame:
    """Distinct (keys, value) with counts; partial aggregation runs map-side."""
    sums = sums or {"n": F.lit(1)}
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(c).cast("double").alias(name) for name, c in sums.items()])
    )


def running_totals(counts: DataFrame, keys: Sequence[str], value: str, cols: Sequence[str]) -> DataFrame:
    """Add ``<col>_below``: the sum of ``col`` over strictly smaller values of the key."""
    keys = list(keys)
    cut = indexed(counts, keys, value)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = cut.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0.0)) for c in cols})
    totals = cut.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0.0)).alias(f"_off_{c}") for c in cols],
    )
    joined = local.join(offsets, [*keys, "_bucket"])
    return joined.select(
        *[c for c in counts.columns if c != "_bucket"],
        *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"{c}_below") for c in cols],
    )


def quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: dict[str, Callable[[Column], Column]],
) -> DataFrame:
    """Linear-interpolated quantiles per key; a level may depend on the key's size.

    ``levels`` maps an output name to a function from the group size to the
    level in [0, 1]. Output: keys, ``n`` and one column per name.
    """
    keys = list(keys)
    counts = indexed(counts, keys, value)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    ranked = running_totals(counts, keys, value, ["n"])
    ranked = (
        ranked.join(totals, keys) if keys else ranked.withColumn("_total", totals.scalar())
    )
    total = F.col("_total")
    aggs = [F.max("_total").alias("_total")]
    for name, level in levels.items():
        position = (total - 1) * level(total)
        for side, rank in (("lo", F.floor(position) + 1), ("hi", F.ceil(position) + 1)):
            holds = (F.col("n_below") < rank) & (rank <= F.col("n_below") + F.col("n"))
            aggs.append(F.max(F.when(holds, F.col(value))).alias(f"_{side}_{name}"))
    picked = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for name, level in levels.items():
        position = (total - 1) * level(total)
        share = position - F.floor(position)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * share).alias(name))
    return picked.select(*keys, total.cast("long").alias("n"), *out)


def constant_level(q: float) -> Callable[[Column], Column]:
    return lambda _n: F.lit(float(q))


def average_ranks(counts: DataFrame, keys: Sequence[str], value: str, rank: str = "rank") -> DataFrame:
    """Tie-average rank of each distinct value."""
    ranked = running_totals(counts, keys, value, ["n"])
    return ranked.withColumn(rank, F.col("n_below") + (F.col("n") + 1) / 2).drop("n_below")


def spearman(pairs: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Spearman correlation per key over complete pairs, from joint counts.

    The joint counts serve both rankings and the final sums, so they are
    written once.
    """
    keys = list(keys)
    joint = (
        pairs.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys, x, y)
        .agg(F.count("*").cast("double").alias("n"))
    )
    joint = reliable_checkpoint(joint)

    def marginal(col: str, name: str) -> DataFrame:
        counts = joint.groupBy(*keys, col).agg(F.sum("n").alias("n"))
        return average_ranks(counts, keys, col, name).drop("n")

    ranked = joint.join(marginal(x, "_rx"), [*keys, x]).join(marginal(y, "_ry"), [*keys, y])
    n, rx, ry = F.col("n"), F.col("_rx"), F.col("_ry")
    sums = ranked.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum(n * rx).alias("sx"),
        F.sum(n * ry).alias("sy"),
        F.sum(n * rx * rx).alias("sxx"),
        F.sum(n * ry * ry).alias("syy"),
        F.sum(n * rx * ry).alias("sxy"),
    )
    cov = F.expr("sxy - sx * sy / n")
    spread = F.expr("(sxx - sx * sx / n) * (syy - sy * sy / n)")
    return sums.select(
        *keys,
        F.when(spread > 0, cov / F.sqrt(spread)).alias("spearman"),
        F.col("n").cast("long").alias("n_pairs"),
    )


def roc_auc(scored: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Exact ROC AUC in Mann-Whitney form from per-score class counts."""
    keys = list(keys)
    counts = value_counts(
        scored.filter(F.col(label).isNotNull()),
        keys,
        score,
        pos=F.col(label).cast("int"),
        neg=1 - F.col(label).cast("int"),
    )
    ranked = running_totals(counts, keys, score, ["neg"])
    sums = ranked.groupBy(*keys).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("wins"),
    )
    return sums.select(
        *keys,
        F.try_divide(F.col("wins"), F.col("n_pos") * F.col("n_neg")).alias("auc"),
        F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"),
    )


def ks_distance(samples: DataFrame, keys: Sequence[str], value: str, is_second: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance between the two sides of a flag."""
    keys = list(keys)
    counts = value_counts(
        samples, keys, value, b=is_second.cast("int"), a=(~is_second).cast("int")
    )
    counts = indexed(counts, keys, value)
    sizes = counts.groupBy(*keys).agg(F.sum("a").alias("_na"), F.sum("b").alias("_nb"))
    ranked = running_totals(counts, keys, value, ["a", "b"])
    ranked = (
        ranked.join(sizes, keys)
        if keys
        else ranked.withColumns({"_na": sizes.select("_na").scalar(), "_nb": sizes.select("_nb").scalar()})
    )
    gap = F.abs(
        F.try_divide(F.col("a_below") + F.col("a"), F.col("_na"))
        - F.try_divide(F.col("b_below") + F.col("b"), F.col("_nb"))
    )
    return ranked.groupBy(*keys).agg(F.max(gap).alias("ks"))
