"""Clusters of similar records: parallel pivot correlation clustering over the cells of a logarithmic grid.

Two records are alike when they differ by at most ``tolerance`` of the larger absolute value in every metric. On the scale
u = sign * (ln|x| / w + offset), with w just under -ln(1 - tolerance), that is a distance of at most 1 (plus a hair) in each of the dimensions. So:

* Records of one unit cell are all alike. A cell stands for its records, however many there are: copies and dense groups cost one node, not pairs. A cell's id is a 64-bit
  hash of its place; should two places ever share one, they are hashed anew.
* Cells are compared only within blocks of ``BLOCK`` cells a side (a block holds at most BLOCK**d cells, whatever the data), by their bounding boxes. A pair is
  certain (its boxes decide it) or open (only its records can).
* Open pairs are decided by cutting both cells in halves, in every dimension, again and again: smaller boxes decide most, and only parts with few records are
  compared record by record. Two crowded cells never meet record by record as wholes.
* Pivot rounds over the cells of which two records are alike. Cells whose hash is smaller than that
  of all their neighbours are pivots. A record goes to the closest pivot record that it is alike to; records that none is alike to go into the next pass,
  with the links that they have among themselves. So every member is alike to the record its cluster is built about. Then each cluster's medoid is found.

For groups closed under likeness (:func:`linked_groups`) the pivot clusters are joined where alike rows cross them. Open pairs are looked at only if
certain links haven't joined their cells already.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import finite, key
from tidemark.operators.components import connected_components
from tidemark.sources.workspace import Workspace

TOLERANCE = 0.01
METRICS = ("laplacian_var", "tenengrad", "rms_contrast", "brightness_mean")
BLOCK = 6
OFFSET = 4_000_000
#: Records are alike up to a distance of 1.00003 on the scale of u: up to SURE they are for certain, from NEVER on they aren't, between the two their values decide.
SURE, NEVER = 1.00002, 1.00004
#: Parts of an open pair with so many pairs of records at most are compared record by record.
DIRECT = 1024


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


class Grid:
    """The records of a table on the grid. ``rows(image, cell, v0.., u0..)``: distinct images with distinct finite values; the rest isn't a record.

    Rows with a null or blank key or a value that is null, NaN or infinite don't take part. Both zeros are the same value, alike only to zero;
    values of different sign are never alike. An empty table gives empty results. Extra columns aren't read.
    """

    def __init__(self, stats: DataFrame, work: Workspace, id: str = "image_id", metrics: tuple[str, ...] = METRICS, tolerance: float = TOLERANCE):
        self.work, self.d, self.tolerance = work, len(metrics), tolerance
        w = -math.log(1 - tolerance) * 0.99997
        rows = stats.select(key(id).alias("image"), *[(F.col(m).cast("double") + F.lit(0.0)).alias(f"v{i}") for i, m in enumerate(metrics)])
        rows = rows.where(F.col("image").isNotNull() & _all([finite(F.col(f"v{i}")) for i in range(self.d)])).distinct()

        def u(v: Column) -> Column:
            size = F.ln(F.abs(v)) / F.lit(w) + F.lit(float(OFFSET))
            return F.when(v > 0, size).when(v < 0, -size).otherwise(0.0)

        rows = rows.select("*", *[u(F.col(f"v{i}")).alias(f"u{i}") for i in range(self.d)])
        place = [F.floor(f"u{i}") for i in range(self.d)]
        self._gather(rows.withColumn("cell", F.xxhash64(*place)))
        for again in range(1, 100):
            # a cell that isn't a unit cell: places that share a hash
            shared = self.cells.where(reduce(lambda a, b: a | b, [F.floor(f"lou{i}") != F.floor(f"hiu{i}") for i in range(self.d)])).select("cell")
            if shared.isEmpty():
                break
            moved = self.rows.join(shared, "cell", "left_semi").withColumn("cell", F.xxhash64(F.lit(again), *place))
            self._gather(self.rows.join(shared, "cell", "left_anti").unionByName(moved))
        self.pairs = work.cut(self._pairs(), "pairs")

    def _gather(self, rows: DataFrame) -> None:
        self.rows = self.work.cut(rows, "grid")
        self.cells = self.work.cut(self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *self._boxes()), "cells")

    def _boxes(self) -> list[Column]:
        return [f(f"u{i}").alias(f"{n}u{i}") for i in range(self.d) for n, f in (("lo", F.min), ("hi", F.max))]

    def _sides(self, name: str) -> list[Column]:
        """The columns of a box under the names of a pair's side."""
        return [F.col(f"{n}u{i}").alias(f"{name}{n}{i}") for i in range(self.d) for n in ("lo", "hi")]

    def only(self, rows: DataFrame) -> Grid:
        """The grid of a part of the rows: boxes and pairs are those of the part."""
        part = object.__new__(Grid)
        part.work, part.d, part.tolerance = self.work, self.d, self.tolerance
        part._gather(rows)
        part.pairs = self.work.cut(part._pairs(), "pairs")
        return part

    def alike(self, a: list[Column], b: list[Column]) -> Column:
        return _all([F.abs(x - y) <= F.lit(self.tolerance) * F.greatest(F.abs(x), F.abs(y)) for x, y in zip(a, b)])

    def _verdict(self) -> tuple[Column, Column]:
        """(near, certain) of two boxes alo0.. and blo0..: whether records of them may be alike, and whether two are for certain.

        Boxes are no wider than a unit cell and touch records on each side. If all records agree in all dimensions but one, the facing records of that one decide.
        """
        c, ds = F.col, range(self.d)
        gap = [F.greatest(c(f"alo{i}"), c(f"blo{i}")) - F.least(c(f"ahi{i}"), c(f"bhi{i}")) for i in ds]
        span = [F.greatest(c(f"ahi{i}"), c(f"bhi{i}")) - F.least(c(f"alo{i}"), c(f"blo{i}")) for i in ds]
        unsettled = reduce(lambda x, y: x + y, [F.when(s <= SURE, 0).otherwise(1) for s in span])
        return _all([g < NEVER for g in gap]), (unsettled <= 1) & _all([g <= SURE for g in gap])

    def _pairs(self) -> DataFrame:
        """(a, b, certain): cells a < b whose boxes come within reach in every dimension."""
        ds = range(self.d)
        home = self.cells.select(F.col("cell").alias("b"), *self._sides("b"), *[F.expr(f"cast(floor(floor(lou{i}) / {BLOCK}) as int)").alias(f"k{i}") for i in ds])
        reach = self.cells
        for i in ds:
            spread = F.expr(f"sequence(cast(floor(floor(lou{i} - {NEVER}) / {BLOCK}) as int), cast(floor(floor(hiu{i} + {NEVER}) / {BLOCK}) as int))")
            reach = reach.withColumn(f"k{i}", F.explode(spread))
        reach = reach.select(F.col("cell").alias("a"), *self._sides("a"), *[f"k{i}" for i in ds])
        near, certain = self._verdict()
        return reach.join(home, [f"k{i}" for i in ds]).where((F.col("a") < F.col("b")) & near).select("a", "b", certain.alias("certain"))

    def _part(self, level: int) -> Column:
        """The number of a record's part of its cell, cut into 2**level in every dimension."""
        return reduce(lambda x, y: x + y, [F.shiftleft(F.floor((F.col(f"u{i}") - F.floor(f"u{i}")) * float(1 << level)), level * i) for i in range(self.d)])

    def confirmed(self, open_pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of which two records are alike, by cutting both cells into ever smaller parts.

        A pair of parts is met (its boxes decide it), out of reach, small (its records are compared), or goes on to parts of half the width. A pair of cells that has met is
        done. At most 60 / d halvings; a part is then so narrow that only records at the very tolerance are left, and those are compared.
        """
        ds, work = range(self.d), self.work
        live = work.cut(open_pairs.select("a", "b", F.lit(0).cast("bigint").alias("pa"), F.lit(0).cast("bigint").alias("pb")), "open")
        near, certain = self._verdict()
        met, most = [], 60 // self.d
        for level in range(most + 1):
            if live.isEmpty():
                break
            cells = live.select(F.col("a").alias("cell")).union(live.select(F.col("b").alias("cell"))).distinct()
            rows = self.rows.join(cells, "cell", "left_semi").withColumn("up", self._part(max(level - 1, 0))).withColumn("part", self._part(level))
            parts = rows.groupBy("cell", "up", "part").agg(F.count(F.lit(1)).alias("n"), *self._boxes())
            one = parts.select(F.col("cell").alias("a"), F.col("up").alias("pa"), F.col("part").alias("qa"), F.col("n").alias("an"), *self._sides("a"))
            two = parts.select(F.col("cell").alias("b"), F.col("up").alias("pb"), F.col("part").alias("qb"), F.col("n").alias("bn"), *self._sides("b"))
            small = (F.col("an") * F.col("bn") <= DIRECT) | F.lit(level == most)
            tried = work.cut(live.join(one, ["a", "pa"]).join(two, ["b", "pb"]).where(near).select("a", "b", "qa", "qb", certain.alias("certain"), small.alias("small")), "tried")
            met.append(tried.where("certain").select("a", "b").distinct())
            left = tried.join(met[-1], ["a", "b"], "left_anti")
            p = rows.select(F.col("cell").alias("a"), F.col("part").alias("qa"), *[F.col(f"v{i}").alias(f"p{i}") for i in ds])
            q = rows.select(F.col("cell").alias("b"), F.col("part").alias("qb"), *[F.col(f"v{i}").alias(f"q{i}") for i in ds])
            near_by = self.alike([F.col(f"p{i}") for i in ds], [F.col(f"q{i}") for i in ds])
            met.append(work.cut(left.where("small").join(p, ["a", "qa"]).join(q, ["b", "qb"]).where(near_by).select("a", "b").distinct(), "met"))
            live = work.cut(left.where("not small").join(met[-1], ["a", "b"], "left_anti").select("a", "b", F.col("qa").alias("pa"), F.col("qb").alias("pb")), "open")
        return reduce(DataFrame.unionAll, met) if met else open_pairs.select("a", "b").where("false")

    def links(self) -> DataFrame:
        """(a, b): all pairs of cells of which two records are alike, each once.

        An open pair is first tried with the records that lie farthest towards each other, which settles nearly all pairs of crowded cells; what those don't settle is
        cut into parts.
        """
        ds, sides = range(self.d), range(2**self.d)
        sure, open_pairs = self.pairs.where("certain").select("a", "b"), self.pairs.where("not certain").select("a", "b")
        if open_pairs.isEmpty():
            return sure
        ends = []
        for side in sides:
            towards = reduce(lambda x, y: x + y, [F.col(f"u{i}") - F.floor(f"u{i}") if side >> i & 1 else F.floor(f"u{i}") - F.col(f"u{i}") for i in ds])
            ends.append(F.max_by(F.array(*[F.col(f"v{i}") for i in ds]), F.struct(towards, F.array(*[F.col(f"v{i}") for i in ds]))))
        cells = open_pairs.select(F.col("a").alias("cell")).union(open_pairs.select(F.col("b").alias("cell"))).distinct()
        corners = self.rows.join(cells, "cell", "left_semi").groupBy("cell").agg(F.array(*ends).alias("ends"), F.array(*[F.floor(F.min(f"u{i}")) for i in ds]).alias("at"))
        one = corners.select(F.col("cell").alias("a"), F.col("ends").alias("ea"), F.col("at").alias("xa"))
        two = corners.select(F.col("cell").alias("b"), F.col("ends").alias("eb"), F.col("at").alias("xb"))
        side = reduce(lambda x, y: x + y, [F.when(F.col("xb")[i] > F.col("xa")[i], 1 << i).otherwise(0) for i in ds])
        faced = open_pairs.join(one, "a").join(two, "b").withColumn("p", F.get("ea", side)).withColumn("q", F.get("eb", F.lit(len(sides) - 1) - side))
        tried = self.work.cut(faced.select("a", "b", self.alike([F.col("p")[i] for i in ds], [F.col("q")[i] for i in ds]).alias("met")), "faced")
        rest = self.confirmed(tried.where("not met").select("a", "b"))
        return self.work.cut(sure.unionAll(tried.where("met").select("a", "b")).unionAll(rest), "cell-links")


def pivots(links: DataFrame, work: Workspace, most_rounds: int = 100) -> DataFrame:
    """(cell, pivot) of every cell with a link: local minima of the cells' ids, which are hashes, absorb their neighbours, round by round.

    Each round aggregates with map-side combining and joins by cell; what is left is written to the shared folder. The smallest cell left is always a
    pivot, so every round ends cells; log(n) rounds are to be expected.
    """
    both = work.cut(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionAll(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).where("x <> y"), "links")
    left, done = both, []
    for _ in range(most_rounds):
        chosen = left.groupBy("x").agg(F.min("y").alias("m")).where("x < m").select(F.col("x").alias("pivot"))
        taken = left.join(chosen, left["y"] == chosen["pivot"]).groupBy("x").agg(F.min("pivot").alias("pivot")).select(F.col("x").alias("cell"), "pivot")
        settled = work.cut(chosen.select(F.col("pivot").alias("cell"), "pivot").unionAll(taken), "settled")
        done.append(settled)
        gone = settled.select("cell")
        rest = work.cut(left.join(gone, left["x"] == gone["cell"], "left_anti").join(gone, left["y"] == gone["cell"], "left_anti"), "links")
        left = rest
        if left.isEmpty():
            break
    else:
        raise RuntimeError(f"pivots: no end after {most_rounds} rounds")
    settled = work.cut(reduce(DataFrame.unionAll, done), "settled")
    # a cell all of whose neighbours went to other pivots is left alone: a cluster of its own
    alone = both.select(F.col("x").alias("cell")).distinct().join(settled.select("cell"), "cell", "left_anti")
    return work.cut(settled.unionAll(alone.select("cell", F.col("cell").alias("pivot"))), "pivots")


def linked_groups(grid: Grid, least: int = 8) -> DataFrame:
    """(image_id, cluster_key): groups of at least ``least`` distinct images linked by alike rows, with no alike row outside.

    Rows of one image hold their cells together. Pivot clusters first; then certain links that cross them, images that lie in several of them, and those open
    pairs whose clusters are still apart.
    """
    work, certain = grid.work, grid.pairs.where("certain")
    owner = pivots(certain.select("a", "b"), work)
    image_cells = work.cut(grid.rows.select("image", "cell").join(owner, "cell", "left").select("image", F.coalesce("pivot", "cell").alias("pivot")).distinct(), "image-cells")
    firsts = image_cells.groupBy("image").agg(F.min("pivot").alias("first"), F.max("pivot").alias("last")).where("first < last").select("image", "first")
    several = image_cells.join(firsts, "image").where("pivot <> first").select(F.col("pivot").alias("a"), F.col("first").alias("b"))

    def owned(pairs: DataFrame) -> DataFrame:
        one = owner.select(F.col("cell").alias("a"), F.col("pivot").alias("pa"))
        two = owner.select(F.col("cell").alias("b"), F.col("pivot").alias("pb"))
        joined = pairs.select("a", "b").join(one, "a", "left").join(two, "b", "left")
        return joined.select("a", "b", F.coalesce("pa", "a").alias("pa"), F.coalesce("pb", "b").alias("pb")).where("pa <> pb")

    crossing = owned(certain).select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    first = work.cut(connected_components(crossing.unionAll(several), work), "components")
    open_pairs = owned(grid.pairs.where("not certain")).select("a", "b", F.col("pa").alias("x"), F.col("pb").alias("y"))
    now = first.select("node", "component")
    apart = open_pairs.join(now.select(F.col("node").alias("x"), F.col("component").alias("cx")), "x", "left").join(now.select(F.col("node").alias("y"), F.col("component").alias("cy")), "y", "left")
    apart = work.cut(apart.select("a", "b", F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y")).where("x <> y"), "apart")
    member = image_cells.join(first.withColumnRenamed("node", "pivot"), "pivot", "left").select("image", F.coalesce("component", "pivot").alias("group"))
    if not apart.isEmpty():
        more = apart.join(grid.confirmed(apart.select("a", "b")), ["a", "b"]).select(F.col("x").alias("a"), F.col("y").alias("b"))
        second = work.cut(connected_components(more, work), "components").select(F.col("node").alias("group"), F.col("component").alias("joined"))
        member = member.join(second, "group", "left").select("image", F.coalesce("joined", "group").alias("group"))
    member = work.cut(member.distinct(), "members")
    large = member.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("group")
    kept = member.join(large, "group")
    names = kept.groupBy("group").agg(F.min("image").alias("cluster_key"))
    return kept.join(names, "group").select(F.col("image").alias("image_id"), "cluster_key")


def clusters(grid: Grid) -> DataFrame:
    """(image, cell, u.., v.., cluster, pivot_image, w..): every record with the pivot cell of its cluster, and the image and values of the pivot record.

    The pivot record of a pivot cell is the one closest to the middle of the cell's box. A record joins the closest pivot record among those it is
    alike to; the records of the pivot cell all are, and a cell without neighbours is its own pivot cell. What is alike to no pivot record is clustered in the next
    pass, which ends since a pass settles its pivot cells.
    """
    ds, work = range(grid.d), grid.work
    us, vs, ws = [f"u{i}" for i in ds], [f"v{i}" for i in ds], [f"w{i}" for i in ds]
    done, left = [], grid
    while True:
        links = left.links()
        owner = pivots(links, work)
        alone = left.cells.join(owner.select("cell"), "cell", "left_anti").select("cell")
        chosen = work.cut(owner.where("cell = pivot").select("pivot").unionAll(alone.select(F.col("cell").alias("pivot"))), "chosen")
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).select(F.col("a").alias("cell"), F.col("b").alias("pivot"))
        reach = both.join(chosen, "pivot", "left_semi").unionByName(chosen.select(F.col("pivot").alias("cell"), "pivot"))
        middle = left.cells.join(chosen, F.col("cell") == F.col("pivot"), "left_semi").select("cell", *[((F.col(f"lou{i}") + F.col(f"hiu{i}")) / 2).alias(f"c{i}") for i in ds])
        off = F.greatest(*[F.abs(F.col(f"u{i}") - F.col(f"c{i}")) for i in ds])
        place = F.struct(*[F.col(f"u{i}").alias(f"c{i}") for i in ds], *[F.col(f"v{i}").alias(f"w{i}") for i in ds], F.col("image").alias("pivot_image"))
        centres = left.rows.join(middle, "cell").groupBy(F.col("cell").alias("pivot")).agg(F.min_by(place, F.struct(off, F.col("image"), *[F.col(v) for v in vs])).alias("x")).select("pivot", "x.*")
        near = left.alike([F.col(v) for v in vs], [F.col(w) for w in ws])
        pick = F.min(F.when(near, F.struct(off.alias("far"), F.col("pivot"), F.col("pivot_image"), *ws)))
        placed = work.cut(left.rows.join(reach.join(centres, "pivot"), "cell", "left").groupBy("image", "cell", *us, *vs).agg(pick.alias("m")), "placed")
        done.append(placed.where("m is not null").select("image", "cell", *us, *vs, F.col("m.pivot").alias("cluster"), "m.pivot_image", *[f"m.{w}" for w in ws]))
        rest = placed.where("m is null").select("image", *vs, *us, "cell")
        if rest.isEmpty():
            return reduce(DataFrame.unionAll, done)
        left = left.only(rest)


def members(grid: Grid) -> DataFrame:
    """(image_id, cluster, pivot_image): the whole division, clusters of one image too. An image that was measured more than once may lie in several clusters."""
    return clusters(grid).select(F.col("image").alias("image_id"), "cluster", "pivot_image").distinct()


def cover(grid: Grid) -> DataFrame:
    """One row: records, records in clusters, and those of them that aren't alike to their cluster's pivot record."""
    ds, made = range(grid.d), grid.work.cut(clusters(grid), "members")
    near = grid.alike([F.col(f"v{i}") for i in ds], [F.col(f"w{i}") for i in ds])
    n = grid.rows.agg(F.count(F.lit(1)).alias("n"))
    return made.agg(F.count(F.lit(1)).alias("n_placed"), F.count_if(~near).alias("n_beyond")).select(n.scalar().alias("n_records"), "n_placed", "n_beyond")


def described(grid: Grid, typical: int = 3) -> DataFrame:
    """One row per cluster of two or more images: its size, the medoid image, the most typical images and the share of its records that are alike to the medoid.

    The medoid is the member whose summed squared distance to all members is smallest, which is the member closest to their mean: two aggregations,
    no pairs. Ties go to the smaller image. The first ``typical`` are taken with a limit before the shuffle, so a cluster of any size is no hot task. Clusters of one image
    are in :func:`members`.
    """
    ds = range(grid.d)
    made = grid.work.cut(clusters(grid), "members")
    middle = made.groupBy("cluster").agg(F.countDistinct("image").alias("n_images"), F.count(F.lit(1)).alias("n_rows"), *[F.avg(f"u{i}").alias(f"m{i}") for i in ds]).where("n_images > 1")
    away = F.round(reduce(lambda a, b: a + b, [(F.col(f"u{i}") - F.col(f"m{i}")) ** 2 for i in ds]), 9)
    values = F.array(*[F.col(f"v{i}") for i in ds])
    placed = made.join(middle, "cluster").groupBy("cluster", "n_images", "n_rows", "image").agg(F.min(F.struct(away.alias("away"), values.alias("v"))).alias("x"))
    placed = placed.select("cluster", "n_images", "n_rows", "image", "x.away", "x.v")
    first = placed.withColumn("place", F.row_number().over(Window.partitionBy("cluster").orderBy("away", "image"))).where(F.col("place") <= typical)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "image"))), lambda x: x["image"])
    out = grid.work.cut(first.groupBy("cluster", "n_images", "n_rows").agg(listed.alias("typical"), F.min_by("v", "place").alias("medoid_values")), "described")
    near = grid.alike([F.col(f"v{i}") for i in ds], [F.col("medoid_values")[i] for i in ds])
    within = made.join(out.select("cluster", "medoid_values"), "cluster").groupBy("cluster").agg(F.avg(near.cast("int")).alias("within"))
    return out.join(within, "cluster").select("cluster", F.element_at("typical", 1).alias("medoid"), "n_images", "n_rows", "typical", "within")
