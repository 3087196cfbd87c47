"""Every query of the engine by name, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumentrace.plans import events, folds, inputs, records, reports, stages, texts

BOOKS = (events.book, records.book, reports.book, texts.book, stages.book, folds.book, inputs.book)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for b in BOOKS for k, v in b.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for b in BOOKS for k, v in b.sql.items()}
