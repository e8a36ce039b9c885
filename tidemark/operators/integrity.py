"""Audits as set algebra: every check gives a number of violations, 0 being a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.derive import id_text
from tidemark.sources.release import six_views

SPLIT_PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))
FIELDS = ("image_id", "group_id", "capture_id")


def duplicate_keys(df: DataFrame, key: str, first: int = 5) -> DataFrame:
    """(key, n): the first ``first`` keys, sorted, that come more than once. Null keys aren't keys."""
    counted = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.orderBy("key").limit(first)


def split_overlaps(real: DataFrame, fields: tuple[str, ...] = FIELDS, split: str = "split") -> DataFrame:
    """(field, left, right, overlap): distinct ids that two splits share, for each field and pair; null ids count as one id.

    One pass: per id a bit mask of its splits (combined on the map side), then one conditional count per pair; nothing is intersected pairwise.
    """
    bit = F.when(F.col(split) == "train", 1).when(F.col(split) == "val", 2).when(F.col(split) == "test", 4).otherwise(0)
    ids = real.select(bit.alias("bit"), F.inline(F.array(*[F.struct(F.lit(f).alias("field"), id_text(F.col(f)).alias("id")) for f in fields])))
    masks = ids.groupBy("field", "id").agg(F.bit_or("bit").alias("mask"))
    number = {"train": 1, "val": 2, "test": 4}
    counts = masks.groupBy("field").agg(*[F.count_if(F.col("mask").bitwiseAND(number[a] + number[b]) == number[a] + number[b]).alias(f"{a}_{b}") for a, b in SPLIT_PAIRS])
    rows = F.array(*[F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"), F.col(f"{a}_{b}").alias("overlap")) for a, b in SPLIT_PAIRS])
    return counts.select("field", F.inline(rows))


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys only in left, only in right, in both. Null keys count as the id ``nan``."""
    both = left.select(id_text(F.col(key)).alias("k"), F.lit(1).alias("side")).unionAll(right.select(id_text(F.col(key)).alias("k"), F.lit(2).alias("side")))
    masks = both.groupBy("k").agg(F.bit_or("side").alias("mask"))
    return masks.agg(*[F.count_if(F.col("mask") == m).alias(n) for m, n in ((1, "only_left"), (2, "only_right"), (3, "in_both"))])


def missing_from(left: DataFrame, right: DataFrame, key: str, *by: str) -> DataFrame:
    """Per ``by``: distinct keys of left that right lacks under the same ``by``; groups that lack none have 0."""
    a = left.select(*by, id_text(F.col(key)).alias("k")).distinct().withColumn("l", F.lit(1))
    b = right.select(*by, id_text(F.col(key)).alias("k")).distinct().withColumn("r", F.lit(1))
    return a.join(b, [*by, "k"], "left").groupBy(*by).agg(F.count_if(F.col("r").isNull()).alias("missing"))


def parent_leaks(synthetic: DataFrame, real: DataFrame, trained: str = "train") -> DataFrame:
    """(split, n_leaks): synthetic rows of the ``trained`` split whose parent is a real image of another split. Rows count, not distinct parents."""
    parents = real.where(F.col("split") != trained).select("split", id_text(F.col("image_id")).alias("parent")).distinct()
    children = synthetic.where(F.col("split") == trained).groupBy(id_text(F.col("parent_image_id")).alias("parent")).agg(F.count(F.lit(1)).alias("n"))
    return parents.join(children, "parent", "left").groupBy("split").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_leaks"))


def asset_mismatches(synthetic: DataFrame) -> DataFrame:
    """(split, n_mismatched): rows whose asset_split isn't their split, null included; a split without synthetic rows has no row."""
    return synthetic.groupBy("split").agg(F.count_if(~F.col("asset_split").eqNullSafe(F.col("split"))).alias("n_mismatched"))


def parent_capture_faults(synthetic: DataFrame, real: DataFrame) -> DataFrame:
    """(split, n_bad): synthetic rows whose parent is unknown, or whose parent's capture holds no real image of the row's split. Null parents don't count.

    A real id that comes more than once counts with its smallest capture. Children are gathered by parent first, so a parent with very many children isn't a hot join key.
    """
    children = synthetic.where(F.col("parent_image_id").isNotNull()).groupBy("split", F.col("parent_image_id").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    parents = real.groupBy(F.col("image_id").alias("p")).agg(F.min(id_text(F.col("capture_id"))).alias("capture"))
    captures = real.select(F.col("split"), id_text(F.col("capture_id")).alias("capture"), F.lit(True).alias("there")).distinct()
    judged = children.join(parents, "p", "left").join(captures, ["split", "capture"], "left")
    return judged.groupBy("split").agg(F.coalesce(F.sum(F.when(F.col("there").isNull(), F.col("n"))), F.lit(0)).alias("n_bad"))


def asset_lookup(synthetic: DataFrame, assets: DataFrame) -> DataFrame:
    """(verdict, n): synthetic rows by what the asset table says: no_asset (null), unknown, wrong_pool (its pool isn't the row's split) or ok.

    The asset of an id is its smallest pool. The left join keeps every row.
    """
    pools = assets.where(F.col("asset_id").isNotNull()).groupBy("asset_id").agg(F.min("asset_split").alias("pool"))
    counted = synthetic.groupBy("asset_id", "split").agg(F.count(F.lit(1)).alias("n")).join(pools, "asset_id", "left")
    verdict = F.when(F.col("asset_id").isNull(), "no_asset").when(F.col("pool").isNull(), "unknown").when(F.col("pool").eqNullSafe(F.col("split")), "ok").otherwise("wrong_pool")
    return counted.groupBy(verdict.alias("verdict")).agg(F.sum("n").alias("n"))


def asset_map(rows: DataFrame, assets: DataFrame) -> DataFrame:
    """``rows`` with asset_pool: the split of their asset, null where the asset is null or unknown. A repeated asset counts with its smallest pool; every row stays."""
    pools = assets.where(F.col("asset_id").isNotNull()).groupBy(F.col("asset_id").alias("__a")).agg(F.min("asset_split").alias("asset_pool"))
    return rows.join(pools, F.col("asset_id") == F.col("__a"), "left").drop("__a")


def enrichment_faults(assets: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(asset_id, fault): assets without a description (``no_description``), or with a row whose pool isn't that of their description (``other_split``)."""
    own = assets.where(F.col("asset_id").isNotNull()).groupBy("asset_id").agg(F.min("asset_split").alias("lo"), F.max("asset_split").alias("hi"))
    both = own.join(descriptions.select("asset_id", F.col("asset_split").alias("said"), F.lit(True).alias("there")), "asset_id", "left")
    agrees = F.col("lo").eqNullSafe(F.col("said")) & F.col("hi").eqNullSafe(F.col("said"))
    fault = F.when(F.col("there").isNull(), "no_description").when(~agrees, "other_split")
    return both.select("asset_id", fault.alias("fault")).where("fault is not null")


def enriched_assets(assets: DataFrame, descriptions: DataFrame, strict: bool = False) -> DataFrame:
    """The manifest with each asset's description from ``descriptions``, in the public order of columns. ``strict``: any fault is ``CheckFailed`` (assets are some dozens of rows)."""
    if strict and (bad := enrichment_faults(assets, descriptions).orderBy("asset_id").collect()):
        raise CheckFailed("; ".join(f"{r['asset_id']}: {r['fault']}" for r in bad))
    told = descriptions.select("asset_id", F.col("description").alias("__d"))
    columns = ("asset_id", "asset_filename", "release_relative_path", "asset_split", "description", "preparation_category", "width", "height", "mode", "sha256")
    return assets.drop("description").join(told, "asset_id").withColumnRenamed("__d", "description").select(*columns)


def selected_rows(images: DataFrame, ids: list[str], origin: str, label: int) -> DataFrame:
    """The rows of ``ids`` in the order asked for (place from 1). An id that isn't there is ``KeyError``; one of another origin or label is ``ValueError``.

    ``ids``: a list of configuration; only its rows come to the driver, to be looked at. A repeated image counts with its smallest label and origin.
    """
    spark = images.sparkSession
    asked = spark.createDataFrame([(k, i) for k, i in enumerate(ids, 1)], "place int, image_id string")
    rows = images.join(asked.select("image_id").distinct(), "image_id", "left_semi")
    found = {r["image_id"]: r for r in rows.groupBy("image_id").agg(F.min("origin").alias("origin"), F.min("label").alias("label")).collect()}
    if missing := [i for i in ids if i not in found]:
        raise KeyError(f"not there: {missing}")
    if wrong := [i for i in ids if found[i]["origin"] != origin]:
        raise ValueError(f"not of origin {origin}: {wrong}")
    if wrong := [i for i in ids if found[i]["label"] != label]:
        raise ValueError(f"not of label {label}: {wrong}")
    one = rows.withColumn("__k", F.row_number().over(Window.partitionBy("image_id").orderBy(F.xxhash64(*rows.columns)))).where("__k = 1").drop("__k")
    return asked.join(one, "image_id").orderBy("place")


def repeated_in_views(views: DataFrame) -> DataFrame:
    """(view, n_repeated): ids that come more than once within a view; a view without any has 0."""
    counted = views.where(F.col("image_id").isNotNull()).groupBy("view", "image_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("view").agg(F.count_if(F.col("n") > 1).alias("n_repeated"))


def view_partition(images: DataFrame) -> DataFrame:
    """(origin, in_no_part, in_several_parts, not_in_whole): whether the three splits divide the real images, and those with synthetic ones the synthetic images."""
    views = six_views(images)
    each = []
    for origin, variant in (("real", "real_only"), ("synthetic", "real_plus_synthetic")):
        parts = views.where((F.col("origin") == origin) & F.endswith("view", F.lit(variant)))
        each.append(partition_faults(images.where(F.col("origin") == origin), parts, "image_id", "view").select(F.lit(origin).alias("origin"), "*"))
    return reduce(DataFrame.unionByName, each)


def several_splits(df: DataFrame, key: str, split: str = "split", first: int | None = None) -> DataFrame:
    """(key, n_splits): keys that lie in more than one split."""
    found = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.countDistinct(split).alias("n_splits")).where("n_splits > 1")
    return found if first is None else found.orderBy("key").limit(first)


def partition_faults(whole: DataFrame, parts: DataFrame, key: str, part: str) -> DataFrame:
    """One row: distinct keys in no part, in several parts, and in a part but not in the whole."""
    a = whole.select(id_text(F.col(key)).alias("k"), F.lit(True).alias("inside"), F.lit(None).cast("string").alias("part"))
    b = parts.select(id_text(F.col(key)).alias("k"), F.lit(None).cast("boolean").alias("inside"), F.col(part).alias("part"))
    per_key = a.unionAll(b).groupBy("k").agg(F.max("inside").alias("inside"), F.countDistinct("part").alias("parts"))
    return per_key.agg(
        F.count_if((F.col("parts") == 0)).alias("in_no_part"), F.count_if(F.col("parts") > 1).alias("in_several_parts"), F.count_if(F.col("inside").isNull()).alias("not_in_whole")
    )


def split_inheritance(children: DataFrame, parents: DataFrame) -> DataFrame:
    """(split, n_children, n_elsewhere): children by split, and those whose parent lies in another split; unknown and null parents are neither.

    A parent filed in several splits counts as inherited if one of them is the child's. Children are gathered by parent first.
    """
    by_parent = children.where(F.col("parent_image_id").isNotNull()).groupBy("split", F.col("parent_image_id").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    known = parents.where(F.col("image_id").isNotNull()).groupBy(F.col("image_id").alias("p")).agg(F.collect_set("split").alias("splits"))
    judged = by_parent.join(known, "p", "left")
    away = F.col("splits").isNotNull() & ~F.coalesce(F.array_contains("splits", F.col("split")), F.lit(False))
    return judged.groupBy("split").agg(F.sum("n").alias("n_children"), F.coalesce(F.sum(F.when(away, F.col("n"))), F.lit(0)).alias("n_elsewhere"))


def asset_numbering(assets: DataFrame, n: int) -> DataFrame:
    """(asset_id, fault): ids of a_0001 .. a_n that are missing, and ids beyond them; compared as keys."""
    wanted = assets.sparkSession.range(1, n + 1).select(F.format_string("a_%04d", F.col("id")).alias("k"), F.lit(1).alias("s"))
    there = assets.where(F.col("asset_id").isNotNull()).select(F.col("asset_id").alias("k"), F.lit(2).alias("s"))
    masks = wanted.unionAll(there).groupBy("k").agg(F.bit_or("s").alias("m")).where("m < 3")
    return masks.select(F.col("k").alias("asset_id"), F.when(F.col("m") == 1, "missing").otherwise("beyond").alias("fault"))


def missing_files(images: DataFrame, inventory: DataFrame, path: str = "relative_path") -> DataFrame:
    """The rows whose file isn't in the inventory; a row without path lacks its file."""
    return images.join(inventory.select(F.col("relative_path").alias("__p")).distinct(), F.col(path) == F.col("__p"), "left_anti")


def orphan_files(inventory: DataFrame, images: DataFrame, path: str = "relative_path") -> DataFrame:
    """The files that no row names: the reverse, which catches what an aborted build left behind."""
    return inventory.join(images.select(F.col(path).alias("__p")).distinct(), F.col("relative_path") == F.col("__p"), "left_anti")


def inventory_difference(listed: DataFrame, actual: DataFrame, key: str, first: int = 5) -> DataFrame:
    """(side, n, examples): keys listed but not there, and there but not listed, with the first few, sorted."""
    a = listed.select(F.col(key).alias("k"), F.lit(1).alias("s")).where("k is not null")
    b = actual.select(F.col(key).alias("k"), F.lit(2).alias("s")).where("k is not null")
    masks = a.unionAll(b).groupBy("k").agg(F.bit_or("s").alias("m")).where("m < 3")
    side = F.when(F.col("m") == 1, "listed_only").otherwise("actual_only").alias("side")
    placed = masks.select("k", side).withColumn("place", F.row_number().over(Window.partitionBy("side").orderBy("k")))
    some = placed.where(F.col("place") <= first).groupBy("side").agg(F.concat_ws("|", F.transform(F.array_sort(F.collect_list("k")), lambda x: x)).alias("examples"))
    return masks.groupBy(side).agg(F.count(F.lit(1)).alias("n")).join(some, "side")


def mismatches(listed: DataFrame, actual: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field): rows of equal key whose field differs; null equals null."""
    b = actual.select(F.col(key), *[F.col(f).alias(f"__{f}") for f in fields])
    bad = F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return listed.join(b, key).select(key, F.explode(bad).alias("field"))


def check(name: str, violations: DataFrame, column: str, why: str) -> DataFrame:
    """One row (check, passed, violations, details) from a one-number aggregate; no row counts as 0."""
    n = violations.agg(F.coalesce(F.sum(F.col(column)), F.lit(0)).cast("bigint").alias("violations"))
    return n.select(F.lit(name).alias("check"), (F.col("violations") == 0).alias("passed"), "violations", F.concat(F.lit(f"{why}="), F.col("violations").cast("string")).alias("details"))


def _named(rows: DataFrame, name: Column, column: str, why: str) -> DataFrame:
    return rows.select(name.alias("check"), (F.col(column) == 0).alias("passed"), F.col(column).cast("bigint").alias("violations"), F.concat(F.lit(f"{why}="), F.col(column).cast("string")).alias("details"))


def audit(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """All split checks as (check, passed, violations, details): overlaps, parent leaks, asset pools, parent captures. All are reported, failed or not."""
    overlaps = split_overlaps(real)
    name = F.concat(F.lit("no_"), F.col("field"), F.lit("_overlap_"), F.col("left_split"), F.lit("_"), F.col("right_split"), F.lit("_real"))
    parts = [
        _named(overlaps, name, "overlap", "overlap"),
        _named(parent_leaks(synthetic, real), F.concat(F.lit("no_training_parent_leak_into_"), F.col("split"), F.lit("_real")), "n_leaks", "n_leaks"),
        _named(asset_mismatches(synthetic), F.concat(F.lit("asset_split_consistent_"), F.col("split")), "n_mismatched", "n_mismatched"),
        _named(parent_capture_faults(synthetic, real), F.concat(F.lit("parent_capture_consistent_"), F.col("split")), "n_bad", "n_bad"),
    ]
    return reduce(DataFrame.unionByName, parts)


def invariants(master: DataFrame, real: DataFrame, synthetic: DataFrame, assets: DataFrame, size: tuple[int, int] | None = None) -> DataFrame:
    """Table invariants as (check, passed, violations, details): unique ids and paths, disjoint and exact union, origins, one resolution, labels, parents and assets known.

    ``size``: the resolution all images must have; None asks only that it be the same for all. Expected counts are a matter of the caller. What can be seen in a row
    alone is counted in one pass over each table.
    """

    def repeats(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("v"))

    def row_checks(df: DataFrame, **counts: tuple[Column, str]) -> DataFrame:
        one = df.agg(*[c.alias(n) for n, (c, _) in counts.items()])
        named = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("violations"), F.lit(w).alias("why")) for n, (_, w) in counts.items()])))
        return named.select("check", (F.col("violations") == 0).alias("passed"), "violations", F.concat("why", F.lit("="), F.col("violations").cast("string")).alias("details"))

    bad = lambda c: F.count_if(~F.coalesce(c, F.lit(False)))
    resolution = (bad((F.col("width") == size[0]) & (F.col("height") == size[1])), "rows") if size else (F.countDistinct("width", "height") - 1, "more")
    union = set_difference(real.select("image_id").unionByName(synthetic.select("image_id")), master, "image_id")
    tables = {"master": master, "real": real, "synthetic": synthetic}
    checks = [check(f"unique_{key}_{n}", repeats(t, key), "v", "keys") for n, t in tables.items() for key in ("image_id", "relative_path")]
    checks += [
        row_checks(master, one_resolution=resolution, labels_in_domain=(bad(F.col("label").between(1, 5)), "rows")),
        row_checks(real, origin_of_real=(bad(F.col("origin") == "real"), "rows")),
        row_checks(synthetic, origin_of_synthetic=(bad(F.col("origin") == "synthetic"), "rows"), synthetic_split_equals_asset_split=(F.count_if(~F.col("synthetic_split").eqNullSafe(F.col("asset_split"))), "rows")),
        check("real_and_synthetic_disjoint", set_difference(real, synthetic, "image_id"), "in_both", "ids"),
        row_checks(union, master_lacks_no_row=(F.sum("only_left"), "ids"), master_adds_no_row=(F.sum("only_right"), "ids")),
        check("parents_exist", missing_from(synthetic.where("parent_image_id is not null").select(F.col("parent_image_id").alias("image_id")), real, "image_id"), "missing", "ids"),
        check("assets_exist", missing_from(synthetic.where("asset_id is not null").select("asset_id"), assets, "asset_id"), "missing", "ids"),
    ]
    return reduce(DataFrame.unionByName, checks)


class CheckFailed(Exception):
    pass


def raise_on_failure(checks: DataFrame) -> None:
    """Raise with the failed checks, sorted by name; the rows are a bounded list of checks."""
    failed = checks.where(~F.col("passed")).orderBy("check").collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: {r['details']}" for r in failed))
