"""Case definitions: three nested boolean masks over a line list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CaseDefinition:
    """Values that make a record probable, an exact match, or in the family."""

    # The normalised labels of a case line list.
    probable: tuple[str, ...] = ("CASO PROVAVEL",)
    exact: tuple[str, ...] = ("DENGUE",)
    family: tuple[str, ...] = ("DENGUE", "DENGUE COM SINAIS DE ALARME", "DENGUE GRAVE")
    class_col: str = "class_norm"
    disease_col: str = "disease_norm"

    def masks(self) -> dict[str, Column]:
        probable = F.coalesce(F.col(self.class_col).isin(*self.probable), F.lit(False))
        disease = F.col(self.disease_col)
        return {
            "probable": probable,
            "exact": probable & F.coalesce(disease.isin(*self.exact), F.lit(False)),
            "family": probable & F.coalesce(disease.isin(*self.family), F.lit(False)),
        }

    def mask(self, name: str) -> Column:
        masks = self.masks()
        if name not in masks:
            raise ValueError(f"unknown target {name!r}; have {sorted(masks)}")
        return masks[name]


def select_target(df: DataFrame, definition: CaseDefinition, name: str, *keys: str) -> DataFrame:
    """Rows of one target with all key columns present."""
    return df.filter(definition.mask(name)).dropna(subset=list(keys))


def matching_targets(definition: CaseDefinition) -> Column:
    """Array of the target names a row belongs to."""
    names = [F.when(mask, F.lit(name)) for name, mask in definition.masks().items()]
    return F.array_compact(F.array(*names))


def code_set(codes: Column, first: list[int], fallback: list[int], source: DataFrame) -> DataFrame:
    """Rows whose code is in ``first``, or in ``fallback`` if ``first`` never occurs.

    The choice is made once over the whole input, as a scalar subquery.
    """
    seen = source.agg(
        F.bool_or(F.coalesce(codes.isin(*first), F.lit(False))).alias("first"),
        F.bool_or(F.coalesce(codes.isin(*fallback), F.lit(False))).alias("fallback"),
    )
    use_fallback = seen.select(~F.col("first") & F.col("fallback")).scalar()
    return source.filter(F.when(use_fallback, codes.isin(*fallback)).otherwise(codes.isin(*first)))
