"""Integer quotas from ratios, ratio specifications and priorities (small configuration tables)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")
#: Shares of the synthetic images by split and label, the sources a target label may have, and the uses of one parent.
SPLIT_QUOTAS = {"train": 2800, "val": 400, "test": 400}
LABEL_RATIOS = {3: 0.15, 4: 0.25, 5: 0.60}
SOURCES = {3: (1, 2), 4: (2, 3), 5: (2, 3)}
MOST_PER_PARENT = {"train": 2, "val": 1, "test": 1}


def largest_remainder(ratios: DataFrame, group: list[str], name: str, ratio: str, total: Column) -> DataFrame:
    """``ratios`` with a bigint ``quota`` per row: floor(total * ratio / sum), the seats left going to the largest remainders.

    Ties go to the smaller name as text. The quotas of a group add up to its total. Null ratios count as 0; a group without a positive ratio gets no quota (null).
    One window per group: the rows are a configuration, a few per group.
    """
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    share = F.coalesce(F.col(ratio).cast("double"), F.lit(0.0))
    exact = total.cast("double") * F.try_divide(share, F.sum(share).over(part))
    rows = ratios.withColumn("__whole", F.floor(F.round(exact, 9))).withColumn("__rest", F.round(exact, 9) - F.col("__whole")).withColumn("__total", total)
    place = F.row_number().over(part.orderBy(F.desc("__rest"), F.col(name).cast("string")))
    left = F.col("__total") - F.sum("__whole").over(part)
    return rows.withColumn("quota", (F.col("__whole") + F.when(place <= left, 1).otherwise(0)).cast("bigint")).drop("__whole", "__rest", "__total")


def quotas(ratios: dict, total: int) -> dict:
    """The same rule on the driver, for configuration checks."""
    whole = sum(ratios.values())
    if total < 0 or whole <= 0 or any(r < 0 for r in ratios.values()):
        raise ValueError("ratios must be positive and the total not negative")
    exact = {k: round(total * r / whole, 9) for k, r in ratios.items()}
    out = {k: math.floor(x) for k, x in exact.items()}
    for k in sorted(ratios, key=lambda k: (-(exact[k] - out[k]), str(k)))[: total - sum(out.values())]:
        out[k] += 1
    return out


def parse_ratios(text: str, names=int) -> dict:
    """``3:0.15,4:0.25`` as a dict; blank parts are skipped, an empty or malformed text is an error."""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        left, colon, right = part.partition(":")
        if not colon:
            raise ValueError(f"no ratio in {part!r}")
        out[names(left.strip())] = float(right)
    if not out:
        raise ValueError("no ratios")
    return out


def parse_source_mix(text: str) -> dict[int, dict[int, float]]:
    """``3=1:0.3|2:0.7,4=2:1`` as target label -> source label -> ratio; a source must lie below its target and be allowed for it."""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        left, equals, right = part.partition("=")
        if not equals:
            raise ValueError(f"no mix in {part!r}")
        target, mix = int(left), parse_ratios(right.replace("|", ","))
        if target not in SOURCES or any(s not in SOURCES[target] or s >= target for s in mix):
            raise ValueError(f"sources {sorted(mix)} aren't allowed for target {target}")
        out[target] = mix
    return out


def source_priority(mix: DataFrame) -> DataFrame:
    """``mix(split, target, source, ratio)`` with ``priority`` 1, 2, ...: larger ratios first, then smaller labels. Outside train, target 5 takes source 3 only."""
    kept = mix.where((F.col("split") == "train") | (F.col("target") != 5) | (F.col("source") == 3))
    return kept.withColumn("priority", F.row_number().over(Window.partitionBy("split", "target").orderBy(F.desc("ratio"), "source")))


def most_per_parent(split: Column) -> Column:
    """How often a parent may be used: twice in train, once elsewhere."""
    return F.when(split == "train", MOST_PER_PARENT["train"]).otherwise(MOST_PER_PARENT["val"])
