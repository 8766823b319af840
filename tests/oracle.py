"""Comparison of a query's rows with those of its SQL in DuckDB."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{source}')")
    return con


def plain(value):
    """Comparable across engines: NaN as text, numbers exact."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def differences(frame, con, sql):
    """Nothing if equal, else a short description."""
    found = con.execute(sql)
    names, wanted = rows([d[0] for d in found.description], found.fetchall())
    columns, got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    if columns != names:
        return f"columns {columns} and {names}"
    if len(got) != len(wanted):
        return f"{len(got)} and {len(wanted)} rows"
    other = [(a, b) for a, b in zip(got, wanted, strict=True) if a != b]
    return f"{len(other)} of {len(got)} rows differ, first {other[0]}" if other else ""
