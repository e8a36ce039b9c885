"""Parents and children: deltas, balanced choice of parents, pools of assets."""

from __future__ import annotations

from heapq import heapify, heappop, heapreplace

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.quotas import largest_remainder
from tidemark.operators.ranking import equal_join, bucketed_rank
from tidemark.sources.workspace import ship


def parent_child_deltas(children: DataFrame, stats: DataFrame, metrics: list[str]) -> DataFrame:
    """(image_id, parent_image_id, parent_m, child_m, delta_m): children and parents with statistics; the statistics of an id are its smallest values.

    The statistics are reduced to one row per id before both joins, so no image is computed twice.
    """
    one = stats.where(F.col("image_id").isNotNull()).groupBy("image_id").agg(*[F.min(m).alias(m) for m in metrics])
    edges = children.where(F.col("parent_image_id").isNotNull() & F.col("image_id").isNotNull()).select("image_id", "parent_image_id").distinct()
    child = one.select("image_id", *[F.col(m).alias(f"child_{m}") for m in metrics])
    parent = one.select(F.col("image_id").alias("parent_image_id"), *[F.col(m).alias(f"parent_{m}") for m in metrics])
    both = edges.join(child, "image_id").join(parent, "parent_image_id")
    return both.select("image_id", "parent_image_id", *[c for m in metrics for c in (F.col(f"parent_{m}"), F.col(f"child_{m}"), (F.col(f"child_{m}") - F.col(f"parent_{m}")).alias(f"delta_{m}"))])


def balanced_parents(parents: DataFrame, per_parent: int, quota: int, *by: str, seed: str = "42") -> DataFrame:
    """(by..., turn, image_id, capture_id, use): ``quota`` uses of parents, captures taking turns, no parent more than ``per_parent`` times.

    The set-based form of "least-loaded capture, then least-used parent": a parent's use u in its capture has the place (u, digest), captures come round by
    place, and the first ``quota`` turns are taken. Ranks within a capture are exact but cut by hash, so a capture of any size is no task of its own. Independent of batches and workers. Groups (split, label) are ranked apart; a null capture is a capture of its own.
    """
    keys, digest = [*by, "capture_id"], F.md5(F.concat(F.lit(seed), F.lit("|"), F.col("image_id")))
    rows = parents.where(F.col("image_id").isNotNull()).select(*keys, "image_id").distinct().withColumn("d", digest)
    # the number of the digest's first 15 digits, moved to the top, has its order
    number = F.shiftleft(F.conv(F.substring("d", 1, 15), 16, 10).cast("bigint"), 4)
    ranked = bucketed_rank(rows, keys, number, ["d", "image_id"], "__rank")
    # all first uses of a capture come before its second ones
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    uses = equal_join(ranked, sizes, keys).select("*", F.explode(F.sequence(F.lit(1), F.lit(per_parent))).alias("use")).withColumn("round", (F.col("use") - 1) * F.col("__n") + F.col("__rank"))
    uses = uses.where(F.col("round") <= quota)
    # no more rounds than it takes to have ``quota`` turns: what a task sorts is that many turns and one round
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(*by).orderBy("round").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rounds = uses.groupBy(*by, "round").agg(F.count(F.lit(1)).alias("__c")).withColumn("__before", before).where(F.col("__before") < quota).drop("__before", "__c")
    turn = F.row_number().over(Window.partitionBy(*by).orderBy("round", "d", "image_id", "use"))
    return equal_join(uses, rounds, [*by, "round"]).withColumn("turn", turn).where(F.col("turn") <= quota).select(*by, "turn", "image_id", "capture_id", "use")


def eligible_sources(used: DataFrame, priority: DataFrame) -> DataFrame:
    """(split, target, source): the first source by priority that still has a parent below its cap. ``used(split, source, n_free)``."""
    open_ = priority.join(used.where("n_free > 0"), ["split", "source"])
    return open_.groupBy("split", "target").agg(F.min_by("source", "priority").alias("source"))


def sampled(parents: DataFrame, outcomes: DataFrame, quotas: DataFrame, caps: DataFrame) -> DataFrame:
    """(split, target, attempt, image_id, source, accepted): the accept/reject loop, one sequential group per split.

    ``parents(split, source, capture_id, image_id)``, ``outcomes(image_id, boost)``: the label boost an attempt on the parent gives, an attempt on a parent without one fails; ``quotas(split, target, priority,
    source, quota)``, ``caps(split, most)``. Each attempt takes the first source with a parent below the cap, the capture with the fewest accepted uses, and its
    least-used parent that hasn't failed for this target; it is accepted if the source label raised by the boost is the target. A target ends at its quota, after
    max(20 * quota, quota + 1) attempts, or when no parent is left. Independent of the number of workers; ties go to the smaller key.

    The loop is sequential by nature, so a split is one group. It is bounded by the quotas, not by the data: in A attempts no more than the first A parents of a capture and
    the first A captures of a source can be reached, so only those are handed on, and the result is that of the whole table.
    """
    ship(parents.sparkSession)
    attempts = quotas.select("split", "target", "quota").distinct().groupBy("split").agg(F.sum(F.greatest(20 * F.col("quota"), F.col("quota") + 1)).alias("attempts"))
    most = attempts.agg(F.max("attempts")).first()[0] or 0
    rows = parents.join(outcomes, "image_id", "left")
    place = F.row_number().over(Window.partitionBy("split", "source", "capture_id").orderBy("image_id"))
    rows = rows.withColumn("__place", place).where(F.col("__place") <= most).drop("__place")
    place = F.row_number().over(Window.partitionBy("split", "source").orderBy("capture_id"))
    captures = rows.select("split", "source", "capture_id").distinct().withColumn("__place", place).where(F.col("__place") <= most).drop("__place")
    rows = rows.join(captures, ["split", "source", "capture_id"], "left_semi").join(F.broadcast(caps), "split")
    plan = quotas.select("split", F.struct("target", "priority", "source", "quota").alias("q")).groupBy("split").agg(F.collect_list("q").alias("plan"))
    joined = rows.join(F.broadcast(plan), "split")

    def run(key: tuple, one: pd.DataFrame) -> pd.DataFrame:
        plan = sorted((int(q["target"]), int(q["priority"]), int(q["source"]), int(q["quota"])) for q in one["plan"].iloc[0])
        most, used, load, out = int(one["most"].iloc[0]), {}, {}, []
        pools: dict[int, dict[str, list[tuple[str, int | None]]]] = {}
        for r in one.sort_values(["capture_id", "image_id"]).itertuples(index=False):
            pools.setdefault(int(r.source), {}).setdefault(str(r.capture_id), []).append((r.image_id, None if pd.isna(r.boost) else int(r.boost)))

        def first(turns: list, heaps: dict, failed: set):
            """The capture with the fewest accepted uses and its least-used parent; both heaps are put right where their tops are out of date."""
            while turns:
                n, capture = turns[0]
                if n != load.get(capture, 0):
                    heapreplace(turns, (load[capture], capture))
                    continue
                heap = heaps[capture]
                while heap:
                    n, image, at = heap[0]
                    if image in failed or used.get(image, 0) >= most:
                        heappop(heap)
                    elif n != used.get(image, 0):
                        heapreplace(heap, (used[image], image, at))
                    else:
                        return capture, image, at
                heappop(turns)
            return None

        for target in sorted({p[0] for p in plan}):
            steps = [p for p in plan if p[0] == target]
            quota, got, tries, failed = steps[0][3], 0, 0, set()
            heaps = {}
            for _, _, source, _ in steps:
                pool = {c: [(used.get(p[0], 0), p[0], k) for k, p in enumerate(ps) if used.get(p[0], 0) < most] for c, ps in pools.get(source, {}).items()}
                turns = [(load.get(c, 0), c) for c in pool]
                for h in (turns, *pool.values()):
                    heapify(h)
                heaps[source] = turns, pool
            while got < quota and tries < max(20 * quota, quota + 1):
                choice = None
                for _, _, source, _ in steps:
                    if found := first(*heaps[source], failed):
                        choice = source, found
                        break
                if choice is None:
                    break
                tries += 1
                source, (capture, image, at) = choice
                boost = pools[source][capture][at][1]
                good = boost is not None and min(5, source + boost) == target
                if good:
                    used[image], load[capture], got = used.get(image, 0) + 1, load.get(capture, 0) + 1, got + 1
                else:
                    failed.add(image)
                out.append((key[0], target, tries, image, source, good))
        return pd.DataFrame(out, columns=["split", "target", "attempt", "image_id", "source", "accepted"])

    return joined.groupBy("split").applyInPandas(run, "split string, target int, attempt int, image_id string, source int, accepted boolean")


def numbered(accepted: DataFrame, order: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Accepted attempts with a running uid over the splits in ``order``: 1, 2, ... by split, target and attempt. Their number is that of the quotas."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    return accepted.where("accepted").withColumn("uid", F.row_number().over(Window.orderBy(pos, "target", "attempt")).cast("bigint"))


def asset_pools(assets: DataFrame, ratios: DataFrame, id: str = "asset_id") -> DataFrame:
    """(id, split): the distinct assets in order of their id cut into slices by ``ratios(split, pos, ratio)``, each split getting one at least where there are enough.

    Assets are a dimension of some dozens of rows; the slices are a join of ranks with running quotas.
    """
    ids = assets.where(F.col(id).isNotNull()).select(id).distinct()
    ranked = ids.withColumn("r", F.row_number().over(Window.orderBy(id)))
    n = ids.agg(F.count(F.lit(1)).alias("n"))
    quotas = largest_remainder(ratios.withColumn("n", n.scalar()), [], "split", "ratio", F.col("n"))
    every = Window.partitionBy(F.lit(1))
    missing = F.sum(F.when((F.col("quota") == 0) & (F.col("ratio") > 0), 1).otherwise(0)).over(every)
    enough = F.col("n") >= F.count(F.lit(1)).over(every)
    biggest = F.row_number().over(every.orderBy(F.desc("quota"), "split")) == 1
    given = F.when(~enough, F.col("quota")).when((F.col("quota") == 0) & (F.col("ratio") > 0), 1).otherwise(F.col("quota") - F.when(biggest, missing).otherwise(0))
    upto = F.sum("given").over(every.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slices = quotas.withColumn("given", given).withColumn("last", upto).select("split", (F.col("last") - F.col("given")).alias("before"), "last")
    return ranked.join(F.broadcast(slices), (F.col("r") > F.col("before")) & (F.col("r") <= F.col("last"))).select(id, "split")
