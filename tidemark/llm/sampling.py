"""Drawing samples whose categories match target shares: divisor-method priorities.

Within a category the records get a random rank (of a hash), and the priority (rank - 0.5) / target. The records of the minimum come first, then the
globally smallest priorities up to the sample size. A category that runs out simply has no more priorities; the others take its seats.

The cut-off priority follows from the category counts alone: how many seats a category gets is computed over the rows of the targets (one row per
category), and a record is kept if its rank is within its category's seats. The hashes are cut into ranges; the counts per range tell which ranges lie wholly within the
seats, so only records of ranges that the seats reach are ever ranked, each range in a task of its own.

A record that comes with several categories is drawn for one of them, for each request the one that lacks most: whose wanted number is largest against the
records it has.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import key
from tidemark.sources.workspace import Workspace, ship

SEED = 7
#: About so many records of a category lie in one range of the hash.
RANGE_ROWS = 100_000


def _seats(shares: list[float], floors: list[int], available: list[int], total: int) -> list[int]:
    """Seats per category: floors first, then by smallest (rank - 0.5) / share, ties to the earlier category; at most what is there."""
    seats = [min(f, a) for f, a in zip(floors, available)]
    left = total - sum(seats)
    open_ = [i for i, s in enumerate(shares) if s > 0 and seats[i] < available[i]]
    if left <= 0 or not open_:
        return seats
    # a cut-off below which surely no more than ``left`` seats are given, then one by one
    low, high = 0.0, max((available[i] + 1) / shares[i] for i in open_)

    def upto(cut: float) -> list[int]:
        return [max(seats[i], min(available[i], int(cut * shares[i] + 0.5))) if i in inside else seats[i] for i in range(len(seats))]

    inside = set(open_)
    for _ in range(200):
        mid = (low + high) / 2
        if sum(upto(mid)) - sum(seats) <= left:
            low = mid
        else:
            high = mid
    got = upto(low)
    left -= sum(got) - sum(seats)
    heap = [((got[i] + 0.5) / shares[i], i) for i in open_ if got[i] < available[i]]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i], left = got[i] + 1, left - 1
        if got[i] < available[i]:
            heapq.heappush(heap, ((got[i] + 0.5) / shares[i], i))
    return got


def allocate(wanted: DataFrame) -> DataFrame:
    """``wanted`` with seats, filled, reached and shortfall.

    The sample size of a request is floor(sample_share * n_eligible). Seats are computed per request over its rows of the targets. filled: the category has enough records;
    reached: its seats are its minimum and the whole part of its wanted number at least; shortfall: the seats that lack to that.
    """
    ship(wanted.sparkSession)
    schema = wanted.withColumn("seats", F.lit(0).cast("bigint")).schema
    order = [c for c in wanted.columns if c.startswith("__c")]

    def seat(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values(order).reset_index(drop=True)
        total = int((one["sample_share"].fillna(0).max() or 0) * one["n_eligible"].max())
        one["seats"] = _seats(one["target_share"].fillna(0).tolist(), one["min_rows"].fillna(0).astype(int).clip(lower=0).tolist(), one["drawable"].astype(int).tolist(), total)
        return one

    at_least = F.greatest(F.coalesce(F.col("min_rows"), F.lit(0)).cast("bigint"), F.floor(F.coalesce("target_share", F.lit(0.0)) * F.coalesce("sample_share", F.lit(0.0)) * F.col("n_eligible")))
    return wanted.groupBy("request_id").applyInPandas(seat, schema).select(
        "*", (F.col("available") >= F.col("needed")).alias("filled"), (F.col("seats") >= at_least).alias("reached"), F.greatest(at_least - F.col("seats"), F.lit(0)).alias("shortfall"),
    )


class QuotaSample:
    """The samples of all requests, their report, and the categories that can't be filled.

    A record counts as available in every category that one of its rows names; it is drawn for one of them only, so that no sample holds it twice: for each
    request the category with the largest needed / available, of equal ones the smallest. Null or blank keys and categories outside the range are not eligible.
    Rows of one request for one category are one row: their shares add up, the larger minimum holds. Null shares want nothing, null minima are 0. Without eligible
    records every category that wants any can't be filled and no sample has a row. Extra columns are not read.

    The eligible records (one row per key, with the set of its categories, which the range bounds) and the report are written to the shared folder: everything after
    starts from there.
    """

    def __init__(self, images: DataFrame, targets: DataFrame, id: str = "image_id", categories: tuple[str, ...] = ("label", "source_label"), low: int = 1, high: int = 5):
        self.categories, spark = list(categories), images.sparkSession
        self.work = work = Workspace(spark)
        self._c = [f"__c{i}" for i in range(len(self.categories))]
        rows = images.select(key(id).alias("id"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(self.categories)]).where(F.col("id").isNotNull())
        for c in self._c:
            rows = rows.where(F.col(c).between(low, high))
        # 60 bits of a digest that any engine can make, moved to the top of a bigint
        draw = F.shiftleft(F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}|"), F.col("id"))), 1, 15), 16, 10).cast("bigint"), 4)
        self.records = work.cut(rows.groupBy("id").agg(F.collect_set(F.struct(*self._c)).alias("in")).withColumn("h", draw), "eligible")
        each = self.records.select(F.inline("in"), (F.size("in") == 1).alias("alone"))
        counts = each.groupBy(*self._c).agg(F.count(F.lit(1)).alias("available"), F.count_if("alone").alias("alone"))
        self.n = self.records.count()
        self.bits = min(20, max(4, math.ceil(math.log2(self.n / RANGE_ROWS + 1))))

        merged = targets.groupBy("request_id", *[F.col(c).alias(f"__c{i}") for i, c in enumerate(self.categories)]).agg(
            F.sum("target_share").alias("target_share"), F.max("min_rows").alias("min_rows"), F.max("sample_share").alias("sample_share")
        )
        needed = F.greatest(F.coalesce(F.col("min_rows").cast("double"), F.lit(0.0)), F.coalesce("target_share", F.lit(0.0)) * F.coalesce("sample_share", F.lit(0.0)) * F.lit(self.n))
        wanted = merged.join(counts, self._c, "left").select(
            "request_id", *self._c, "target_share", "min_rows", "sample_share", F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("alone", F.lit(0)).alias("alone"),
            F.lit(self.n).cast("bigint").alias("n_eligible"), needed.alias("needed"),
        )
        wanted = work.cut(wanted, "wanted")
        # records with several categories: for each request one of them
        several = self.records.where("size(in) > 1").select("id", "h", F.inline("in")).join(wanted, self._c)
        least = F.min(F.struct((-F.col("needed") / F.col("available")).alias("lack"), *self._c))
        self.dealt = work.cut(several.groupBy("request_id", "id", "h").agg(least.alias("m")).select("request_id", "id", "h", *[F.col(f"m.{c}").alias(c) for c in self._c]), "dealt")
        dealt = self.dealt.groupBy("request_id", *self._c).agg(F.count(F.lit(1)).alias("dealt"))
        drawable = wanted.join(dealt, ["request_id", *self._c], "left").withColumn("drawable", F.col("alone") + F.coalesce("dealt", F.lit(0))).drop("alone", "dealt")
        self._report = work.cut(allocate(drawable), "report")
        self.report = self._report.select(
            "request_id", *[F.col(f"__c{i}").alias(c) for i, c in enumerate(self.categories)], "target_share", "min_rows", "sample_share", "available", "drawable", "n_eligible", "needed",
            "seats", "filled", "reached", "shortfall",
        )

    def sample(self) -> DataFrame:
        """(request_id, id, categories..., priority): the drawn records of every request, with (rank - 0.5) / target as priority."""
        c, part = self._c, F.shiftrightunsigned("h", 64 - self.bits).alias("__b")
        seats = self._report.where("seats > 0").select("request_id", *c, "target_share", "seats")
        alone = self.records.where("size(in) = 1").select("id", "h", part, *[F.col("in")[0][k].alias(k) for k in c])
        dealt = self.dealt.select("request_id", *c, "id", "h", part)
        by_range = alone.groupBy(*c, "__b").agg(F.count(F.lit(1)).alias("n")).join(seats, c).select("request_id", *c, "__b", "n")
        by_range = by_range.unionByName(dealt.groupBy("request_id", *c, "__b").agg(F.count(F.lit(1)).alias("n"))).groupBy("request_id", *c, "__b").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy("request_id", *c).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        before = by_range.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
        reached = before.join(seats, ["request_id", *c]).where("before < seats")
        rows = alone.join(reached, [*c, "__b"]).unionByName(dealt.join(reached, ["request_id", *c, "__b"]))
        rank = F.row_number().over(Window.partitionBy("request_id", *c, "__b").orderBy("h", "id")) + F.col("before")
        kept = rows.withColumn("rank", rank).where(F.col("rank") <= F.col("seats"))
        return kept.select("request_id", F.col("id").alias("image_id"), *[F.col(f"__c{i}").alias(k) for i, k in enumerate(self.categories)], F.try_divide(F.col("rank") - 0.5, "target_share").alias("priority"))

    def unfilled(self) -> DataFrame:
        """(request_id, categories...) of the rows of the targets that can't be filled."""
        return self.report.where(~F.col("filled")).select("request_id", *self.categories)
