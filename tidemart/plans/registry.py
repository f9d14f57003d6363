"""Registered queries: name -> (Spark callable, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, run: QueryFn, oracle: str | None = None) -> None:
    QUERIES[name] = run
    if oracle is not None:
        ORACLES[name] = oracle


class Data:
    """What a query reads: test tables by name, shared SQL over them, and the stand-in tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from tidemart.plans.standins import CleanTables

        self.spark, self.sf_dir = spark, sf_dir
        self.clean = CleanTables(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        from tidemart.plans.standins import load

        return load(self.spark, self.sf_dir, name)

    def sql(self, text: str) -> DataFrame:
        from tidemart.plans.standins import derived

        return derived(self.spark, self.sf_dir, text)


def on(name: str, run: Callable[[Data], DataFrame], oracle: str | None = None) -> None:
    query(name, lambda spark, sf_dir: run(Data(spark, sf_dir)), oracle)
