"""Order statistics against plain Python, all rows in one group included."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classification, distribution, ranking, summary


def data(seed, n=400):
    rng = random.Random(seed)
    draw = lambda: rng.choice([0.0, -0.0, 1.0, rng.gauss(0, 1), rng.choice([-1, 1]) * rng.lognormvariate(0, 9), float(round(rng.gauss(5, 2))), 1 + 1e-9 * rng.random(), 5e-324, 1.7e308, -1.7e308])
    return [(rng.choice(["a", "b", None]), draw()) for _ in range(n)]


def place(ordered, q):
    at = q * (len(ordered) - 1)
    lo, hi = ordered[int(at)], ordered[-int(-at // 1)]
    return lo if lo == hi else lo + (hi - lo) * (at - int(at))


def test_value_ranges_follow_the_values(spark):
    values = sorted({v for _, v in data(1)} | {float("-inf"), float("inf")})
    got = [r["r"] for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", ranking.value_range(F.col("v")).alias("r")).orderBy("v").collect()]
    assert got == sorted(got) and len(set(got)) > 50


@pytest.mark.parametrize("seed", range(2))
def test_percentiles_are_exact(spark, seed):
    rows = [(g, v) for g, v in data(seed) if abs(v) < 1e300]
    nan = [("a", None), ("a", float("nan")), ("empty", None)]
    df = spark.createDataFrame([*rows, *nan], "g string, value double")
    wanted = {"least": 0.0, "p10": 0.1, "median": 0.5, "p90": 0.9, "most": 1.0}
    got = {r["g"]: r for r in ranking.percentiles(df, ["g"], "value", wanted).collect()}
    for g in ("a", "b", None):
        ordered = sorted(v for k, v in rows if k == g)
        assert got[g]["n"] == len(ordered)
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(place(ordered, q), rel=1e-12, abs=0)
    assert set(got) == {"a", "b", None} and ranking.percentiles(df.where("false"), ["g"], "value", wanted).count() == 0


def test_running_sums_in_both_directions(spark):
    rows = [(g, v, k % 4) for k, (g, v) in enumerate(dict.fromkeys((g, v + 0.0) for g, v in data(5)))]
    df = spark.createDataFrame(rows, "g string, v double, n bigint").groupBy("g", "v").agg(F.sum("n").alias("n"))
    for down in (False, True):
        got = {(r["g"], r["v"]): (r["n_before"], r["n_total"], r["__next"]) for r in ranking.running(df, ["g"], "v", ["n"], down).collect()}
        for g in ("a", "b", None):
            mine = {}
            for k, v, n in rows:
                if k == g:
                    mine[v] = mine.get(v, 0) + n
            ordered, sofar = sorted(mine, reverse=down), 0
            for v, then in zip(ordered, [*ordered[1:], None]):
                assert got[(g, v)] == (sofar, sum(mine.values()), then)
                sofar += mine[v]


def test_all_rows_in_one_group(spark):
    """No window sees the values of a group: those that order values are partitioned by range too."""
    n = 20_000
    df = spark.range(n).select(F.lit("one").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(5000)) / 7.0).alias("value"))
    values = sorted(r["value"] for r in df.collect())
    got = summary.described(df, "g").first()
    assert (got["n"], got["median"], got["min"], got["max"]) == (n, statistics.median(values), values[0], values[-1])
    steps = sorted((r["value"], r["y"]) for r in summary.ecdf(df, "g").collect())
    assert [v for v, _ in steps] == values and [y for _, y in steps] == pytest.approx([(i + 1) / n for i in range(n)])
    plan = summary.ecdf(df, "g")._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert any("value#" in x for x in specs) and all("__r#" in x for x in specs if "value#" in x)


def test_ranks_by_ranges(spark):
    rows = [(g, int(abs(v)) % 1000, k) for k, (g, v) in enumerate(data(7)) if abs(v) < 1e9]
    df = spark.createDataFrame(rows, "g string, pos bigint, id bigint")
    got = {r["id"]: r["rank"] for r in ranking.range_rank(df, ["g"], "pos", ["id"]).collect()}
    for g in ("a", "b", None):
        assert [got[k] for _, k in sorted((p, k) for h, p, k in rows if h == g)] == list(range(1, 1 + sum(h == g for h, _, _ in rows)))


def test_distance_and_scores_of_infinite_and_equal_values(spark):
    df = spark.createDataFrame([("l", 0.0), ("l", 1.0), ("l", 3.0), ("r", 5.0), ("r", 6.0), ("r", 8.0), ("r", None)], "side string, value double")
    assert distribution.wasserstein(df, group="side", left="l", right="r").first()["distance"] == 5.0
    assert distribution.wasserstein(df.where("side = 'l'"), group="side", left="l", right="r").count() == 0
    scored = spark.createDataFrame([(1, float("inf")), (0, float("-inf")), (1, 0.5), (0, 0.5)], "truth int, score double")
    assert classification.auroc(scored, truth="truth", score="score").first()["auroc"] == 0.875
