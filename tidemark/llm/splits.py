"""Train, validation and test splits that keep related records together.

Records are tied when they share an image, capture, group or parent key, or one is the parent of the other; ties carry on. The ties are first
contracted: a record hangs on its *hub* (its capture, else its group, else its image or parent), and only hubs with an image, parent or group in common
give edges, so the graph to be searched has no more nodes than there are hubs that are tied to others.

The components are allotted by a min-cost flow: bundles of components with the same size and labels are the supply, every split has a quota of records and one for each
label, and a deviation from a quota costs its square over the quota. A component can't be divided, so a unit of the flow is a whole component:

1. Components of more than ``HEAVY`` of all records (at most 1 / HEAVY) are placed first, since what they leave of the quotas is what the others must fill.
2. A bundle of n alike components gives each split the whole part of its share of n, the shares being those that the heavy ones leave: no order of the others could do better
   for these. First bundles of identical labels, then what is left over (less than one component a split and bundle) by a coarser profile.
3. What is still left over, a bounded number of components, is sent through the network one by one, each along the cheapest arc, and then the flow is improved along cycles of
   negative cost (a component that changes its split, or two that change places), heavy ones included, until there are none.

Which members of a bundle go where is decided by the rank of their hash.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import key
from tidemark.operators.components import connected_components
from tidemark.operators.ranking import bucketed_rank
from tidemark.sources.workspace import Workspace

SHARES = (("train", 0.70), ("val", 0.15), ("test", 0.15))
HEAVY = 0.0005
LABELS = 6  # label 1..5, and one for all others
_COUNTS = [f"l{k}" for k in range(1, LABELS + 1)]


@dataclass(frozen=True)
class Fields:
    image: str = "image_id"
    capture: str = "capture_id"
    group: str = "group_id"
    parent: str = "parent_image_id"
    label: str = "label"
    row: str = "relative_path"  # tells records without any key apart, where the table has it


class Ties:
    """The ties of a table. ``hubs(hub, component)``: of every hub with a tie to another.

    Null and blank keys tie nothing; a record without any key is related to none and gets a hub of its own (records that ``fields.row`` and label don't tell apart
    share one). Repeated rows change nothing. Whether a parent is in the table doesn't matter: what names the same parent is tied. An empty table has no hubs.
    """

    def __init__(self, records: DataFrame, work: Workspace, fields: Fields = Fields()):
        self.work = work
        i, c, g, p = (key(x) for x in (fields.image, fields.capture, fields.group, fields.parent))
        tag = lambda t, x: F.concat(F.lit(t), x)
        label = F.when(F.col(fields.label).between(1, 5), F.col(fields.label)).otherwise(LABELS).cast("int")
        apart = F.col(fields.row) if fields.row in records.columns else F.lit(None)
        rows = records.select(i.alias("i"), c.alias("c"), g.alias("g"), p.alias("p"), label.alias("label"), F.when(F.coalesce(i, c, g, p).isNull(), F.xxhash64(apart.cast("string"), label)).alias("apart"))
        none = F.concat(F.lit("n:"), F.hex("apart"))
        self.rows = rows.withColumn("hub", F.coalesce(tag("c:", F.col("c")), tag("g:", F.col("g")), tag("i:", F.col("i")), tag("i:", F.col("p")), none))
        named = self.rows.where("not startswith(hub, 'n:')")
        # what a record names besides its hub: its image, its parent, its group. Only a key that several hubs name ties anything. The hubs of a key are told apart by a 64-bit
        # hash, of which the least and the largest combine before the shuffle, so a key of any number of records is no task of its own
        names = F.array_compact(F.array(tag("i:", F.col("i")), tag("i:", F.col("p")), tag("g:", F.col("g"))))
        touched = named.select("hub", F.explode(names).alias("key"))
        ends = touched.groupBy("key").agg(F.min(F.xxhash64("hub")).alias("lo"), F.max(F.xxhash64("hub")).alias("hi")).where("lo < hi").select("key")
        shared = work.cut(touched.join(ends, "key").distinct(), "shared")
        first = shared.groupBy("key").agg(F.min("hub").alias("first"))
        edges = shared.join(first, "key").where("hub <> first").select(F.col("hub").alias("a"), F.col("first").alias("b"))
        self.hubs = work.cut(connected_components(edges, work), "hubs").select(F.col("node").alias("hub"), "component")

    def capture_pairs(self) -> DataFrame:
        """(capture_a, capture_b), a < b: all pairs of captures that must share a split."""
        captures = self._captures()
        a, b = captures.withColumnRenamed("capture", "capture_a"), captures.withColumnRenamed("capture", "capture_b")
        return a.join(b, "component").where("capture_a < capture_b").select("capture_a", "capture_b")

    def _captures(self) -> DataFrame:
        return self.hubs.where("startswith(hub, 'c:')").select(F.expr("substring(hub, 3)").alias("capture"), "component")

    def capture_classes(self) -> DataFrame:
        """(capture_id, class_id, n_captures): every capture that is tied to another, with the smallest capture it is tied to and the number of all of them: one row a capture, no pairs."""
        captures = self._captures()
        classes = captures.groupBy("component").agg(F.min("capture").alias("class_id"), F.count(F.lit(1)).alias("n_captures")).where("n_captures > 1")
        return captures.join(classes, "component").select(F.col("capture").alias("capture_id"), "class_id", "n_captures")

    def components(self) -> DataFrame:
        """(component, l1..l6): records of each component by label (6: none of 1..5). Counted per hub first, so no component is one task."""
        by_hub = self.rows.groupBy("hub").agg(*[F.count_if(F.col("label") == k).alias(f"l{k}") for k in range(1, LABELS + 1)])
        named = by_hub.join(self.hubs, "hub", "left").withColumn("component", F.coalesce("component", "hub"))
        return named.groupBy("component").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(1, LABELS + 1)])


class Network:
    """The flow from components to splits. ``sums[k]``: records of split k, all and by label; ``quota`` the same; a deviation costs its square over the quota.

    A split that holds more than its quota of records costs more: light components can fill up what is missing, but not undo what is too much.
    """

    def __init__(self, quota: np.ndarray, placed: np.ndarray, over: float = 0.0):
        self.weight = np.where(quota > 0, 1 / np.maximum(quota, 1e-300), 0.0)
        self.weight[:, 0] *= LABELS
        self.quota, self.sums, self.over = quota, placed.astype(float).copy(), over

    def _cost(self, sums: np.ndarray, k: int) -> np.ndarray:
        d = sums - self.quota[k]
        return (d * d) @ self.weight[k] + self.over * np.maximum(d[..., 0], 0.0) ** 2 * self.weight[k, 0]

    def cost(self) -> float:
        return float(sum(self._cost(self.sums[k], k) for k in range(len(self.quota))))

    def place(self, units: np.ndarray) -> np.ndarray:
        """The split of each unit (a row of counts: all, by label), the largest first, each along the cheapest arc; of equal ones the first."""
        at = np.zeros(len(units), int)
        for u in np.argsort(-units[:, 0], kind="stable"):
            at[u] = min(range(len(self.quota)), key=lambda k: (self._cost(self.sums[k] + units[u], k) - self._cost(self.sums[k], k), k))
            self.sums[at[u]] += units[u]
        return at

    def improve(self, units: np.ndarray, at: np.ndarray, width: int = 64) -> np.ndarray:
        """``at`` after cancelling cycles of negative cost: one unit moves from i to j, one goes there and another comes back, or up to three move anyhow.

        Of each pair of splits the ``width`` units that are cheapest to send are paired with all that may come back; only when that ends, the cheapest of all moves are combined in twos
        and threes. Every step lowers the cost by a fixed part of it at least, so it ends.
        """
        at = at.copy()
        while True:
            total = self.cost()
            best = self._cycle(units, at, width)
            for depth, few in ((2, width // 3), (3, width // 8)):
                if best[0] >= -1e-6 * total - 1e-12:
                    best = self._combination(units, at, depth, few)
            if best[0] >= -1e-6 * total - 1e-12:
                return at
            for u, k in best[1]:
                self.sums[at[u]] -= units[u]
                self.sums[k] += units[u]
                at[u] = k

    def _cycle(self, units: np.ndarray, at: np.ndarray, width: int) -> tuple[float, tuple]:
        best, n = (0.0, ()), len(self.quota)
        now = [self._cost(self.sums[k], k) for k in range(n)]
        for i in range(n):
            here = np.nonzero(at == i)[0]
            if not len(here):
                continue
            out = self._cost(self.sums[i] - units[here], i) - now[i]
            for j in range(n):
                if i == j:
                    continue
                gain = out + self._cost(self.sums[j] + units[here], j) - now[j]
                u = int(np.argmin(gain))
                if gain[u] < best[0]:
                    best = (gain[u], ((here[u], j),))
                there = np.nonzero(at == j)[0]
                if i < j and len(there):
                    for v in np.argsort(gain, kind="stable")[:width]:
                        swap = units[there] - units[here[v]]
                        both = self._cost(self.sums[i] + swap, i) + self._cost(self.sums[j] - swap, j) - now[i] - now[j]
                        w = int(np.argmin(both))
                        if both[w] < best[0]:
                            best = (both[w], ((here[v], j), (there[w], i)))
        return best

    def _combination(self, units: np.ndarray, at: np.ndarray, depth: int, few: int) -> tuple[float, tuple]:
        """The best ``depth`` moves of different units among the ``few`` cheapest moves of each pair of splits."""
        n, moves = len(self.quota), []
        for i in range(n):
            here = np.nonzero(at == i)[0]
            for j in range(n):
                if i != j and len(here):
                    gain = self._cost(self.sums[i] - units[here], i) + self._cost(self.sums[j] + units[here], j)
                    moves += [(here[u], i, j) for u in np.argsort(gain, kind="stable")[:few]]
        if len(moves) < depth:
            return 0.0, ()
        change = np.zeros((len(moves), n, units.shape[1]))
        for m, (u, i, j) in enumerate(moves):
            change[m, i] -= units[u]
            change[m, j] += units[u]
        chosen = np.array(list(combinations(range(len(moves)), depth)))
        who = np.array([u for u, _, _ in moves])[chosen]
        chosen = chosen[[len(set(r)) == depth for r in who]]
        if not len(chosen):
            return 0.0, ()
        sums = self.sums + change[chosen].sum(1)
        cost = sum(self._cost(sums[:, k], k) for k in range(n)) - self.cost()
        m = int(np.argmin(cost))
        return float(cost[m]), tuple((moves[c][0], moves[c][2]) for c in chosen[m])


def quotas(totals: np.ndarray, shares: tuple = SHARES) -> np.ndarray:
    """(split, all and by label): the quotas in records."""
    return np.array([[p] for _, p in shares]) * totals[None, :]


def _profile(x: Column) -> Column:
    """A size in quarter octaves: at most 250 over all bigints."""
    return F.floor(F.log2(x.cast("double")) * 4).cast("int")


def _dealt(rows: DataFrame, bundle: list[str], shares: list[list[float]], names: list[str]) -> DataFrame:
    """``rows`` with split: of each bundle the whole part of its share for every split, by rank of the hash; null for those left over.

    ``shares``: per stratum (the commonest label) and split. Bundles are counted and ranked without being gathered.
    """
    sizes = rows.groupBy(*bundle).agg(F.count(F.lit(1)).alias("__n"))
    ranked = bucketed_rank(rows, bundle, F.xxhash64(F.lit(11), "component"), ["component"]).join(sizes, bundle)
    split, upto = F.lit(None).cast("string"), F.lit(0)
    for k, name in enumerate(names):
        share = F.element_at(F.array(*[F.lit(float(s[k])) for s in shares]), F.col("stratum"))
        upto = upto + F.floor(F.col("__n") * share)
        split = F.coalesce(split, F.when(F.col("rank") <= upto, name))
    return ranked.withColumn("split", split).drop("rank", "__n")


def allotted(components: DataFrame, work: Workspace, shares: tuple = SHARES) -> DataFrame:
    """(component, split) of (component, l1..l6). The driver sees sums, the heavy components and those left over by the profiles: bounded numbers whatever the data."""
    spark, names = components.sparkSession, [s for s, _ in shares]
    size = sum((F.col(c) for c in _COUNTS), F.lit(0))
    top = F.greatest(*_COUNTS)
    stratum = F.coalesce(*[F.when(F.col(c) == top, F.lit(k)) for k, c in enumerate(_COUNTS, 1)])
    rows = components.select("component", *_COUNTS, size.alias("size"), stratum.alias("stratum"))
    columns = ["size", *_COUNTS]

    def vectors(found: list) -> np.ndarray:
        return np.array([[r[c] for c in columns] for r in found], float).reshape(len(found), len(columns))

    totals = np.array([x or 0 for x in rows.agg(*[F.sum(c) for c in columns]).first()], float)
    quota = quotas(totals, shares)
    heavy = sorted(rows.where(F.col("size") > totals[0] * HEAVY).collect(), key=lambda r: r["component"])
    units = vectors(heavy)
    # heavy ones: what is over a quota can't be made good by light ones, what is below can
    first = Network(quota, np.zeros_like(quota), over=1000.0)
    at = first.improve(units, first.place(units))
    left = np.maximum(quota - first.sums, 0.0)
    whole = left[:, 0] / max(left[:, 0].sum(), 1e-300)
    by_stratum = [(left[:, k] / left[:, k].sum() if left[:, k].sum() > 0 else whole).tolist() for k in range(1, LABELS + 1)]

    light = rows.where(F.col("size") <= totals[0] * HEAVY)
    exact = work.cut(_dealt(light, ["stratum", *_COUNTS], by_stratum, names), "dealt")
    profile = F.concat_ws("_", _profile(F.col("size")), F.floor(F.greatest(*_COUNTS) * 8 / F.col("size")))
    again = exact.where("split is null").drop("split").withColumn("profile", profile)
    coarse = work.cut(_dealt(again, ["stratum", "profile"], by_stratum, names), "dealt-again")
    done = exact.where("split is not null").select("component", "split", *columns).unionByName(coarse.where("split is not null").select("component", "split", *columns))
    sums = {r["split"]: [r[c] for c in columns] for r in done.groupBy("split").agg(*[F.sum(c).alias(c) for c in columns]).collect()}
    # at most len(shares) of each of 250 * 6 * 9 profiles
    rest = sorted(coarse.where("split is null").collect(), key=lambda r: r["component"])
    placed = np.array([sums.get(n, [0] * len(columns)) for n in names], float)
    for k, u in zip(at, units):
        placed[k] += u
    last = Network(quota, placed)
    more = vectors(rest)
    ends = last.improve(np.concatenate([units, more]), np.concatenate([at, last.place(more)]).astype(int))
    named = spark.createDataFrame([(r["component"], names[k]) for r, k in zip([*heavy, *rest], ends)], "component string, split string")
    return done.select("component", "split").unionByName(named)


def assigned(ties: Ties, shares: tuple = SHARES) -> DataFrame:
    """(hub, split) of every hub, written to the shared folder."""
    work = ties.work
    split_of = allotted(work.cut(ties.components(), "components"), work, shares)
    named = ties.rows.select("hub").distinct().join(ties.hubs, "hub", "left").select("hub", F.coalesce("component", "hub").alias("component"))
    return work.cut(named.join(split_of, "component").select("hub", "split"), "assigned")


def splits(ties: Ties, hubs: DataFrame) -> DataFrame:
    """(image_id, split) of every image key; all records of an image lie in one component. Records without image key are in no row here, but count in the shares."""
    rows = ties.rows.where("i is not null").select("hub", F.col("i").alias("image_id")).distinct()
    return rows.join(hubs, "hub").groupBy("image_id").agg(F.min("split").alias("split"))


def apart(ties: Ties, hubs: DataFrame) -> DataFrame:
    """One row: image keys assigned, and the captures, groups and parents whose records came into more than one split, each counted for itself."""
    rows = ties.rows.join(hubs, "hub").select("split", "i", "c", "g", "p")
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in "icgp"])
    # an image as a parent is the same key as an image
    by_key = rows.select("split", F.inline(keys)).where("key is not null").select("split", F.when(F.col("kind") == "p", "i").otherwise(F.col("kind")).alias("kind"), "key", (F.col("kind") == "i").alias("own"))
    counted = by_key.groupBy("kind", "key").agg(F.min("split").alias("lo"), F.max("split").alias("hi"), F.max("own").alias("own"))
    torn = lambda k: F.count_if((F.col("kind") == k) & (F.col("lo") != F.col("hi")))
    return counted.agg(F.count_if((F.col("kind") == "i") & F.col("own")).alias("n_images"), torn("i").alias("images_apart"), torn("c").alias("captures_apart"), torn("g").alias("groups_apart"))


def shares_reached(ties: Ties, hubs: DataFrame, shares: tuple = SHARES) -> DataFrame:
    """Per split and label (6: none of 1..5; null: all): records, the share of the label's records, and the target share."""
    spark = ties.rows.sparkSession
    by_hub = ties.rows.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = by_hub.join(hubs, "hub").groupBy("split", "label").agg(F.sum("n").alias("n_records"))
    counts = counts.unionByName(counts.groupBy("split").agg(F.sum("n_records").alias("n_records")).withColumn("label", F.lit(None).cast("int")))
    target = spark.createDataFrame([(s, float(p)) for s, p in shares], "split string, target_share double")
    share = F.col("n_records") / F.sum("n_records").over(Window.partitionBy("label"))
    return counts.withColumn("share", share).join(target, "split").select("split", "label", "n_records", "share", "target_share")
