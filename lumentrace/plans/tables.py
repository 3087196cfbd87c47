"""Access to the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumentrace.session import ready


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Book:
    """Queries by name, each with its SQL where there is one."""

    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, name: str, sql: str | None = None):
        def put(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return put
