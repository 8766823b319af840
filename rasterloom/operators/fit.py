"""Least-squares fits of sensor models, for any number of keys at once.

The rows stay where they are: a fit is one aggregate of products, combined
before its shuffle, to one row a key with the normal equations; solving them
takes a task some microseconds. Rounds that drop outliers repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import workspace


#: Keys whose facts go to every task, some ten MB; facts of more keys are joined by key, where Spark splits what is large.
BROADCAST = 100_000


def _beside(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Join `facts`, one checkpointed row a key, to the rows; these stay where they are, as a key may have very many."""
    return rows.join(F.broadcast(facts) if facts.count() <= BROADCAST else facts, keys)


def monomials(variables: Sequence[Column], degree: int) -> list[Column]:
    """All products of the variables up to a degree, from the constant on: 1, x, y, x x, x y, y y, ..."""
    found = [F.lit(1.0)]
    for n in range(1, degree + 1):
        for chosen in combinations_with_replacement(variables, n):
            product = chosen[0]
            for other in chosen[1:]:
                product = product * other
            found.append(product.cast("double"))
    return found


def _solve(size: int):
    def run(batches):
        for batch in batches:
            rows = []
            for sums in batch.column("sums").to_pylist():
                upper, right = sums[: size * (size + 1) // 2], sums[size * (size + 1) // 2 :]
                if any(x is None or not np.isfinite(x) for x in sums):
                    rows.append(None)
                    continue
                normal = np.zeros((size, size))
                normal[np.triu_indices(size)] = upper
                normal = normal + np.triu(normal, 1).T
                scale = 1 / np.sqrt(np.where(np.diag(normal) > 0, np.diag(normal), 1.0))
                even = normal * scale[:, None] * scale
                try:
                    lower = np.linalg.cholesky(even)
                except np.linalg.LinAlgError:
                    rows.append(None)
                    continue
                if np.diag(lower).min() < 1e-7:  # terms that the rows do not tell apart
                    rows.append(None)
                    continue
                rows.append((scale * np.linalg.solve(lower.T, np.linalg.solve(lower, scale * np.array(right)))).tolist())
            i = batch.schema.get_field_index("sums")
            yield batch.set_column(i, "sums", pa.array(rows, pa.list_(pa.float64())))

    return run


def least_squares(rows: DataFrame, keys: list[str], terms: Sequence[Column], target: Column, *, weight: Column | None = None) -> DataFrame:
    """(keys, n, coefficients): the coefficients, one a term, that minimise the weighted squares of target - sum(c * term).

    Null where the rows of a key do not determine them. Rows with a null or NaN
    in a term, the target or the weight take no part.
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    named = rows.select(*keys, *(t.cast("double").alias(f"x{i}") for i, t in enumerate(terms)), target.cast("double").alias("y"), w.alias("w"))
    xs = [f"x{i}" for i in range(len(terms))]
    for c in (*xs, "y", "w"):
        named = named.where(F.col(c).isNotNull() & ~F.isnan(c))
    products = [F.sum(F.col(a) * F.col(b) * F.col("w")) for i, a in enumerate(xs) for b in xs[i:]] + [F.sum(F.col(a) * F.col("y") * F.col("w")) for a in xs]
    sums = named.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*products).alias("sums"))
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInArrow(_solve(len(terms)), f"{kinds}, n long, sums array<double>").withColumnRenamed("sums", "coefficients")


def predict(coefficients: Column, terms: Sequence[Column]) -> Column:
    total = coefficients[0] * terms[0]
    for i, t in enumerate(terms[1:], 1):
        total = total + coefficients[i] * t
    return total


def robust(rows: DataFrame, keys: list[str], terms: Sequence[Column], target: Column, *, sigmas: float = 3.0, rounds: int = 5) -> DataFrame:
    """(keys, n, used, coefficients, rms): a fit that leaves out rows off by more than `sigmas` times the root mean square of those used.

    A row left out in one round may come back in the next. Rounds end early
    when no key's number of used rows changes.
    """
    held = workspace.cut(rows.select(*keys, *(t.cast("double").alias(f"t{i}") for i, t in enumerate(terms)), target.cast("double").alias("y")))
    xs, y = [F.col(f"t{i}") for i in range(len(terms))], F.col("y")
    whole = held.groupBy(*keys).agg(F.count("*").alias("n"))
    used, before = held, None
    for _ in range(rounds):
        found = workspace.cut(least_squares(used, keys, xs, y).withColumnRenamed("n", "used"))
        off = _beside(held, found.select(*keys, "coefficients"), keys).withColumn("off", y - predict(F.col("coefficients"), xs))
        inside = off if before is None else _beside(off, limit, keys).where(F.abs("off") <= F.col("limit"))
        spread = workspace.cut(inside.groupBy(*keys).agg(F.sqrt(F.avg(F.col("off") * F.col("off"))).alias("rms")))
        limit = spread.select(*keys, (F.col("rms") * sigmas).alias("limit"))
        used = _beside(off, limit, keys).where(F.abs("off") <= F.col("limit"))
        now = found.agg(F.sum("used")).first()[0]
        if now == before:
            break
        before = now
    return whole.join(found, keys).join(spread, keys).select(*keys, "n", "used", "coefficients", "rms")


def rational(rows: DataFrame, keys: list[str], numerator: Sequence[Column], denominator: Sequence[Column], target: Column, *, rounds: int = 4) -> DataFrame:
    """(keys, n, numerator, denominator): target = sum(a * numerator) / (1 + sum(b * denominator)), as rational sensor models have it.

    The products with the denominator make it linear; each round weighs rows by
    the denominator that the round before found.
    """
    size = len(numerator)
    held = workspace.cut(rows.select(*keys, *(t.cast("double").alias(f"a{i}") for i, t in enumerate(numerator)), *(t.cast("double").alias(f"b{i}") for i, t in enumerate(denominator)), target.cast("double").alias("y")))
    a, b, y = [F.col(f"a{i}") for i in range(size)], [F.col(f"b{i}") for i in range(len(denominator))], F.col("y")
    linear, weighed, weight = [*a, *(-y * t for t in b)], held, None
    for _ in range(rounds):
        found = workspace.cut(least_squares(weighed, keys, linear, y, weight=weight))
        under = 1 + predict(F.slice("coefficients", size + 1, len(b)), b)
        weighed = _beside(held, found.select(*keys, "coefficients"), keys).withColumn("under", under)
        weight = 1 / (F.col("under") * F.col("under"))
    return found.select(*keys, "n", F.slice("coefficients", 1, size).alias("numerator"), F.slice("coefficients", size + 1, len(b)).alias("denominator"))
