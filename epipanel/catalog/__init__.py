"""Named queries with their SQL equivalents."""

from __future__ import annotations

from epipanel.catalog.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    """Import every query module once and return both tables."""
    from epipanel.catalog import (  # noqa: F401
        aggregates,
        basics,
        bands,
        extras,
        forecasts,
        hierarchies,
        learning,
        readers,
        runs,
        scores,
        streams,
        texts,
        windows,
    )

    return QUERIES, ORACLES
