"""Run registered queries against their SQL oracle and compare rows and column names."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order, missing values alike."""
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object).where(frame[columns].notna(), None)
    order = frame.map(str).sort_values(columns).index
    return frame.loc[order].reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    got, want = normalised(got), normalised(want)
    unequal = (got != want) & ~(got.isna() & want.isna())
    if unequal.to_numpy().any():
        row = unequal.any(axis=1).idxmax()
        return f"row {row}: {got.loc[row].to_dict()} != {want.loc[row].to_dict()}"
    return None


def main(folder: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        got = query(spark, folder).toPandas()
        seconds = time.time() - started
        want = connection.execute(oracles[name]).df() if name in oracles else None
        problem = "no oracle" if want is None else differences(got, want)
        print(f"{name:28s} {len(got):7d} rows {seconds:6.2f}s  {problem or 'equal'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
