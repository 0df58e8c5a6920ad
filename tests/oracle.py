"""Compare a Spark result with the DuckDB result of its check SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(data_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{data_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(arrow_type: pa.DataType) -> str:
    if pa.types.is_large_string(arrow_type):
        return "string"
    if pa.types.is_timestamp(arrow_type):
        return "timestamp" if arrow_type.tz is None else "timestamp with zone"
    return str(arrow_type)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    found = []
    left = {f.name: _kind(f.type) for f in spark_table.schema}
    right = {f.name: _kind(f.type) for f in duck_table.schema}
    if left != right:
        found.append(f"schema: {left} against {right}")
        return found
    if spark_table.num_rows != duck_table.num_rows:
        found.append(f"rows: {spark_table.num_rows} against {duck_table.num_rows}")
    for mine, other in zip(_rows(spark_table), _rows(duck_table)):
        if mine != other:
            found.append(f"first different row: {mine} against {other}")
            break
    return found
