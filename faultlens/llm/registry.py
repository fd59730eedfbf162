"""Queries of this subpackage over the test tables, and the SQL some are compared with."""

from __future__ import annotations

from faultlens.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
