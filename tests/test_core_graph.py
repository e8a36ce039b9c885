"""Keys, ranks, components and the reference audit against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import finite, key
from tidemark.operators.components import connected_components
from tidemark.operators.ranking import bucketed_rank
from tidemark.operators.references import Child, Parent, orphan_references, orphans_by_month, orphans_found
from tidemark.sources.workspace import Workspace


def test_key_trims_white_space_and_case(spark):
    rows = spark.createDataFrame([(" A_1\t",), ("a_1",), (" A_1　",), ("",), (" \t\n",), (None,)], "k string")
    assert [r[0] for r in rows.select(key("k")).collect()] == ["a_1", "a_1", "a_1", None, None, None]


def test_finite(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,), (-0.0,)], "x double")
    assert [r[0] for r in rows.select(finite(F.col("x"))).collect()] == [True, False, False, False, False, True]


def test_bucketed_rank_is_a_rank(spark):
    random.seed(1)
    rows = [(random.choice(["a", "a", "a", "b", None]), i) for i in range(3000)] + [("a", 7), ("a", 7)]
    df = spark.createDataFrame(rows, "g string, i int")
    out = bucketed_rank(df, ["g"], F.xxhash64("i"), ["i"]).collect()
    for g in ("a", "b", None):
        assert sorted(r["rank"] for r in out if r["g"] == g) == list(range(1, 1 + sum(x[0] == g for x in rows)))
    assert bucketed_rank(df.where("false"), ["g"], F.xxhash64("i"), ["i"]).count() == 0


def union_find(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_graphs(spark, seed):
    random.seed(seed)
    edges = [(f"n{random.randrange(150):03d}", f"n{random.randrange(150):03d}") for _ in range(110)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("hub", f"h{i}") for i in range(60)]
    want = union_find([e for e in edges if e[0] != e[1]])
    got = connected_components(spark.createDataFrame([*edges, *edges[:20], (None, "x"), ("y", None), ("z", "z")], "a string, b string"), Workspace(spark))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), Workspace(spark)).count() == 0


T0 = datetime(2024, 3, 1)
CHILD, PARENT = "image_id string, parent_image_id string, asset_id string, ingest_ts timestamp_ntz, period int, salt int", "image_id string, ingest_ts timestamp_ntz, deleted_at timestamp_ntz, id int, word int"


def audit(spark, children, parents, period="day"):
    c, p = spark.createDataFrame(children, CHILD), spark.createDataFrame(parents, PARENT)
    return orphan_references(
        [Child("c", "parent_image_id", c, "image_id", "parent_image_id", "ingest_ts", "image"), Child("c", "asset_id", c, "image_id", "asset_id", "ingest_ts", "image")],
        [Parent("image", p, "image_id", "ingest_ts", "deleted_at")], period,
    )


def norm(k):
    return k.strip().lower() or None if k else None


def brute(children, parents):
    first, out = {}, set()
    for c in children:
        if (k := norm(c[0])) and c[3] is not None:
            first[k] = min(first.get(k, c[3]), c[3])
    for c in children:
        for field, ref in (("parent_image_id", norm(c[1])), ("asset_id", norm(c[2]))):
            k = norm(c[0])
            if not k or not ref:
                continue
            t = first.get(k)
            if t is None or not any(norm(p[0]) == ref and p[1] is not None and p[1] <= t and (p[2] is None or p[2] > t) for p in parents):
                out.add(("c", field, k))
    return out


@pytest.mark.parametrize("period", ["day", "month"])
def test_orphans_against_brute_force(spark, period):
    random.seed(3)
    t = lambda: T0 + timedelta(hours=random.randrange(24 * 90), microseconds=random.randrange(3))
    spell = lambda k: random.choice([k, k.upper(), f" {k}", f"{k}\t"])
    parents = [(spell(f"p{random.randrange(60)}"), s := t(), random.choice([None, None, s + timedelta(days=random.randrange(-1, 40))]), 1, 2) for _ in range(120)]
    parents += [("p1", T0, T0, 1, 2), (None, T0, None, 1, 2), (" ", T0, None, 1, 2), ("p2", None, None, 1, 2)]
    children = [(spell(f"c{random.randrange(150)}"), random.choice([None, " ", "p1", spell(f"p{random.randrange(70)}")]), random.choice([None, spell(f"p{random.randrange(70)}")]), t(), 5, 5) for _ in range(400)]
    children += [(None, "p1", None, T0, 5, 5), ("lost", "p3", None, None, 5, 5), *children[:30]]
    failed = audit(spark, children, parents, period)
    assert {tuple(r) for r in orphans_found(failed).collect()} == brute(children, parents)
    assert {r["why"] for r in failed.select("why").distinct().collect()} <= {"missing", "later", "withdrawn"}
    assert sum(r["n_references"] for r in orphans_by_month(failed).collect()) == failed.count()


def test_orphans_of_empty_tables(spark):
    assert audit(spark, [], [("p", T0, None, 1, 2)]).count() == 0
    assert [tuple(r) for r in orphans_found(audit(spark, [("C", "P", None, T0, 0, 0)], [])).collect()] == [("c", "parent_image_id", "c")]


def test_withdrawn_and_returned_parent(spark):
    d = timedelta(days=1)
    parents = [("p", T0, T0 + 10 * d, 0, 0), ("p", T0 + 20 * d, T0 + 30 * d, 0, 0), ("p", T0 + 40 * d, None, 0, 0)]
    times = {"a": 5, "b": 10, "c": 15, "d": 25, "e": 35, "f": 40, "g": 99}
    failed = audit(spark, [(k, "p", None, T0 + n * d, 0, 0) for k, n in times.items()], parents)
    assert {(r["image_id"], r["why"]) for r in failed.collect()} == {("b", "withdrawn"), ("c", "withdrawn"), ("e", "withdrawn")}
