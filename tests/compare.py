"""Compare a Spark result with a SQL check, as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

SPARK_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT",
               "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A connection with every table of ``folder`` as a view."""
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(
            f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _bag(rows) -> Counter:
    return Counter(tuple(None if value is pd.NaT or value != value else value
                         for value in row) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs between the two, empty when nothing does."""
    relation = connection.sql(sql)
    kinds = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    found = {name: SPARK_KINDS.get(kind, kind) for name, kind in frame.dtypes}
    problems = []
    if found != kinds:
        problems.append(f"columns differ: {set(found.items()) ^ set(kinds.items())}")
    names = sorted(set(found) & set(kinds))
    quoted = ", ".join(f'"{name}"' for name in names)
    spark_rows = _bag(tuple(row) for row in frame.select(*names).collect())
    sql_rows = _bag(connection.sql(f"select {quoted} from ({sql})").fetchall())
    if spark_rows != sql_rows:
        problems.append(
            f"rows differ: {spark_rows.total()} and {sql_rows.total()}; "
            f"only spark {list((spark_rows - sql_rows).items())[:3]}; "
            f"only sql {list((sql_rows - spark_rows).items())[:3]} in {names}")
    return problems
