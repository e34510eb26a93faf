"""Registered queries: key -> (Spark builder over an sf folder, DuckDB oracle text or None).

Every builder reads the driver's tables (through the survey views) in full; no
row caps, id subsets or samples unless the limit is the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelspark.sources.survey_views import survey_view

SparkQuery = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, SparkQuery] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: SparkQuery) -> SparkQuery:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def views(spark: SparkSession, sf_dir: str, *names: str):
    out = tuple(survey_view(spark, sf_dir, n) for n in names)
    return out[0] if len(out) == 1 else out


def _load_all() -> None:
    # Importing the modules registers their queries.
    from parcelspark.plans import q_ingest, q_links, q_more, q_nested, q_reports, q_store, q_unified  # noqa: F401


def all_queries() -> dict[str, SparkQuery]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
