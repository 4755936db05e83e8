"""Named feature sets of the panel models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

CASE_LAGS = tuple(f"cases_lag_{n}" for n in range(1, 5))
RATE_LAGS = tuple(f"incidencia_100k_lag_{n}" for n in range(1, 5))
TREND = ("cases_delta_1", "cases_delta_2", "cases_growth_rate")
SEASON = ("sin_week", "cos_week", "sin_month", "cos_month")
CLIMATE = tuple(f"{c}_lag_{n}" for c in ("precip_sum", "temp_mean", "umidmed") for n in range(2, 9))


@dataclass(frozen=True)
class FeatureSet:
    name: str
    target: str
    numeric: tuple[str, ...]
    region: bool = False
    population: bool = False

    def numeric_columns(self) -> list[str]:
        return [*self.numeric, *(["populacao"] if self.population else [])]

    def input_columns(self) -> list[str]:
        return [*self.numeric_columns(), *(["ra"] if self.region else [])]

    def complete_rows(self, df: DataFrame) -> DataFrame:
        """Rows with every input, key and target column present."""
        needed = {*self.input_columns(), "epi_sunday", "ra", "cases", "populacao", self.target}
        return df.dropna(subset=[c for c in df.columns if c in needed])

    @property
    def is_rate(self) -> bool:
        return self.target == "incidencia_100k"


FEATURE_SETS = {
    f.name: f
    for f in (
        FeatureSet("lag-only", "cases", CASE_LAGS + TREND),
        FeatureSet("lag+clima", "cases", CASE_LAGS + TREND + CLIMATE + SEASON),
        FeatureSet("lag+clima+RA", "cases", CASE_LAGS + TREND + CLIMATE + SEASON, region=True),
        FeatureSet(
            "lag+clima+RA+incid-target", "incidencia_100k", RATE_LAGS + TREND + CLIMATE + SEASON,
            region=True, population=True,
        ),
    )
}


def feature_set(name: str) -> FeatureSet:
    if name not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {name!r}; have {list(FEATURE_SETS)}")
    return FEATURE_SETS[name]
