"""Comparing distributions: Wasserstein-1 and principal components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import running
from tidemark.operators.summary import covariance, standardized


def wasserstein(values: DataFrame, *by: str, group: str, left: str, right: str, value: str = "value") -> DataFrame:
    """(by..., distance): the area between the two empirical distribution functions; groups that lack a side have no row.

    Counts per distinct value with map-side combining, running sums by ranges of values.
    """
    rows = values.where(F.col(group).isin(left, right) & F.col(value).isNotNull() & ~F.isnan(value))
    counted = rows.groupBy(*by, F.col(value).alias("v")).agg(F.count_if(F.col(group) == left).alias("a"), F.count_if(F.col(group) == right).alias("b"))
    steps = running(counted, list(by), "v", ["a", "b"]).where("a_total > 0 and b_total > 0")
    upto = {k: (F.col(f"{k}_before") + F.col(k)) / F.col(f"{k}_total") for k in "ab"}
    area = F.sum(F.coalesce(F.abs(upto["a"] - upto["b"]) * (F.col("__next") - F.col("v")), F.lit(0.0)))
    return steps.groupBy(*by).agg(area.alias("distance")).where("distance is not null")


def components(df: DataFrame, columns: list[str], k: int = 2) -> tuple[DataFrame, DataFrame]:
    """(loadings, scores) of the first k principal components of the standardized columns.

    Rows lacking a value are left out. The covariance is one aggregation; only its d x d numbers come to the driver. Signs are fixed: the
    largest loading of a component is positive. loadings(component, column, loading, variance, ratio); scores adds pc1.. to the rows.
    """
    known = df.dropna(subset=columns)
    matrix = np.zeros((len(columns), len(columns)))
    for r in covariance(known, columns).collect():
        i, j = columns.index(r["row"]), columns.index(r["col"])
        matrix[i, j] = matrix[j, i] = r["cov"] if r["cov"] is not None else 0.0
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(columns))])
    total = values.sum() or 1.0
    rows = [(i + 1, c, float(vectors[j, i]), float(values[i]), float(values[i] / total)) for i in range(min(k, len(columns))) for j, c in enumerate(columns)]
    loadings = df.sparkSession.createDataFrame(rows, "component int, column string, loading double, variance double, ratio double")
    z = standardized(known, columns)
    score = [sum((F.col(f"z_{c}") * float(vectors[j, i]) for j, c in enumerate(columns)), F.lit(0.0)).alias(f"pc{i + 1}") for i in range(min(k, len(columns)))]
    return loadings, z.select(*known.columns, *score)
