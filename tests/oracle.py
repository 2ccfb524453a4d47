"""Compare a registered query with its SQL on the same Parquet files."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        # the text tells 0.0 and -0.0 apart
        return None if math.isnan(value) else (repr(value) if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def sort_key(row):
    return tuple((v is not None, 0.0 if v in ("0.0", "-0.0") else v if v is not None else 0) for v in row)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(data, key=sort_key)


def compare(df, con, sql: str) -> list[str]:
    """Differences in words; an empty list means equal names, types, row count and values."""
    got_cols, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want_cols, want = table_of(names, answer.fetchall())
    problems = []
    if got_cols != want_cols:
        return [f"columns {got_cols} vs {want_cols}"]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    spark_types = dict(df.dtypes)
    duck_types = {d[0]: str(d[1]).upper() for d in answer.description}
    families = {"bigint": "INT", "int": "INT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOL", "date": "DATE"}
    for c in got_cols:
        family = families.get(spark_types[c], "?")
        duck = duck_types[c]
        if family not in duck or (spark_types[c] == "bigint" and duck != "BIGINT") or (spark_types[c] == "int" and duck != "INTEGER"):
            problems.append(f"type of {c}: {spark_types[c]} vs {duck}")
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[:2]}")
    return problems
