"""Exact duplicates by content hash, near duplicates by Hamming distance."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import range_rank

#: So many hashes with one key meet in one piece at most.
FULL = 10_000


def exact_duplicates(df: DataFrame, id: str, digest: str) -> DataFrame:
    """(id, class_id, n): rows whose digest comes more than once, with the smallest id of the digest and the number of rows; null digests are no content.

    One row per member instead of a joined list, so a digest of any frequency is a count, not a cell that grows.
    """
    classes = df.where(F.col(digest).isNotNull()).groupBy(F.col(digest).alias("__d")).agg(F.min(id).alias("class_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return df.join(classes, F.col(digest) == F.col("__d")).select(id, "class_id", "n")


def duplicate_report(df: DataFrame, id: str, digest: str, pos: str, error: str | None = None, per_row: int = 1000) -> DataFrame:
    """(status, digest, n_images, part, image_ids, details): groups of equal digest with all their ids joined by ``|`` in order of the number ``pos``.

    A group of more than ``per_row`` ids comes in several rows, part 0, 1, ..., so that no cell grows with the data; together they hold every id. status: ``duplicate``; ``error`` for
    rows whose ``error`` says why they have no digest, with their id; one row ``ok`` if no digest comes twice. Rows with neither digest nor error don't come out.
    """
    none = F.lit(None).cast("string")
    rows = df.where(F.col(digest).isNotNull()).select(F.col(digest).alias("digest"), F.col(id).alias("id"), F.col(pos).alias("pos"))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n_images")).where("n_images > 1")
    placed = range_rank(rows.join(sizes, "digest"), ["digest"], "pos", ["id"])
    lists = placed.groupBy("digest", "n_images", F.floor((F.col("rank") - 1) / per_row).cast("int").alias("part")).agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("l"))
    found = lists.select(F.lit("duplicate").alias("status"), "digest", "n_images", "part", F.array_join(F.transform("l", lambda x: x["id"].cast("string")), "|").alias("image_ids"), none.alias("details"))
    n = sizes.agg(F.count(F.lit(1)).alias("n"))
    fine = n.where("n = 0").select(F.lit("ok").alias("status"), none.alias("digest"), F.lit(0).cast("bigint").alias("n_images"), F.lit(0).alias("part"), none.alias("image_ids"), F.lit("no equal contents").alias("details"))
    out = found.unionAll(fine)
    if error is None:
        return out
    bad = df.where(F.col(error).isNotNull())
    return out.unionAll(bad.select(F.lit("error").alias("status"), none.alias("digest"), F.lit(1).cast("bigint").alias("n_images"), F.lit(0).alias("part"), F.col(id).cast("string").alias("image_ids"), F.col(error).alias("details")))


def near_duplicates(hashes: DataFrame, bits: str = "hash", distance: int = 4, width: int = 64, blocks: int | None = None) -> DataFrame:
    """Pairs of different hashes at most ``distance`` bits apart: (hash_a, hash_b, distance), hash_a < hash_b, between distinct hash values.

    Exact: the hash is cut into ``blocks``; two hashes within the distance agree in blocks - distance of them at least, so pairs meet in an equi-join on
    (choice of blocks, their bits) and the distance is computed for those only. More blocks mean longer, more selective keys and more of them: distance + 1 gives
    distance + 1 keys of width / (distance + 1) bits, distance + 2 (the default) keys twice as long. Equal hashes are one value here, whatever their
    number; :func:`near_duplicate_rows` has their members. Null hashes are left out.
    """
    n = blocks or distance + 2
    edges = [width * k // n for k in range(n + 1)]
    block = [F.shiftrightunsigned("h", edges[k]).bitwiseAND(F.lit((1 << (edges[k + 1] - edges[k])) - 1)) for k in range(n)]
    keys = [F.array(*[block[k] for k in choice]) for choice in combinations(range(n), n - distance)]
    values = hashes.where(F.col(bits).isNotNull()).select(F.col(bits).alias("h")).distinct()
    banded = values.select("h", F.posexplode(F.array(*keys)).alias("band", "part"))
    # a key that very many hashes share is cut: one side into pieces, the other copied to each of them
    full = banded.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FULL).select("band", "part", F.ceil(F.col("n") / FULL).cast("int").alias("pieces"))
    banded = banded.join(full, ["band", "part"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    a = banded.select("band", "part", F.col("h").alias("hash_a"), F.pmod(F.xxhash64("h"), "pieces").cast("int").alias("piece"))
    b = banded.select("band", "part", F.col("h").alias("hash_b"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    apart = F.bit_count(F.col("hash_a").bitwiseXOR(F.col("hash_b")))
    return a.join(b, ["band", "part", "piece"]).where((F.col("hash_a") < F.col("hash_b")) & (apart <= distance)).select("hash_a", "hash_b", apart.alias("distance")).distinct()


def near_duplicate_rows(hashes: DataFrame, id: str = "id", bits: str = "hash", distance: int = 4, width: int = 64) -> DataFrame:
    """(id, class_id, n_same, n_links): every row with its class of equal hashes, the class's size, and how many other classes lie within the distance.

    No pair of copies is expanded; null hashes don't come out.
    """
    pairs = near_duplicates(hashes, bits, distance, width)
    links = pairs.select(F.col("hash_a").alias("h")).unionAll(pairs.select(F.col("hash_b").alias("h"))).groupBy("h").agg(F.count(F.lit(1)).alias("n_links"))
    classes = hashes.where(F.col(bits).isNotNull()).groupBy(F.col(bits).alias("h")).agg(F.min(id).alias("class_id"), F.count(F.lit(1)).alias("n_same"))
    both = classes.join(links, "h", "left")
    return hashes.join(both, F.col(bits) == F.col("h")).select(id, "class_id", "n_same", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def between_splits(hashes: DataFrame, split: str = "split", bits: str = "hash", distance: int = 4, width: int = 64) -> DataFrame:
    """(left_split, right_split, n_links): near-duplicate class pairs (equal hashes included) with members in different splits."""
    pairs = near_duplicates(hashes, bits, distance, width).select("hash_a", "hash_b")
    where = hashes.where(F.col(bits).isNotNull()).select(F.col(bits).alias("h"), F.col(split).alias("s")).distinct()
    same = where.select(F.col("h").alias("hash_a"), F.col("h").alias("hash_b")).distinct()
    both = pairs.unionAll(same).join(where.select(F.col("h").alias("hash_a"), F.col("s").alias("x")), "hash_a").join(where.select(F.col("h").alias("hash_b"), F.col("s").alias("y")), "hash_b")
    kept = both.where((F.col("x") != F.col("y")) & ((F.col("hash_a") != F.col("hash_b")) | (F.col("x") < F.col("y"))))
    return kept.select("hash_a", "hash_b", F.least("x", "y").alias("left_split"), F.greatest("x", "y").alias("right_split")).distinct().groupBy("left_split", "right_split").agg(F.count(F.lit(1)).alias("n_links"))


def split_pairs(hashes: DataFrame, id: str = "id", split: str = "split", bits: str = "hash", distance: int = 4, order: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """(left_split, right_split, left_image, right_image, n_left, n_right, distance): near duplicates between two splits, the earlier of ``order`` on the left.

    One row per pair of classes of equal hashes: the smallest image of each in its split, and how many images it stands for there; classes of equal hash are at distance 0.
    """
    classes = hashes.where(F.col(bits).isNotNull() & F.col(split).isin(*order)).groupBy(F.col(bits).alias("h"), F.col(split).alias("s")).agg(F.min(id).alias("image"), F.count(F.lit(1)).alias("n"))
    pairs = near_duplicates(hashes, bits, distance)
    same = hashes.where(F.col(bits).isNotNull()).select(F.col(bits).alias("hash_a"), F.col(bits).alias("hash_b"), F.lit(0).alias("distance")).distinct()
    both = pairs.unionAll(pairs.select(F.col("hash_b").alias("hash_a"), F.col("hash_a").alias("hash_b"), "distance")).unionAll(same)
    left = classes.select(F.col("h").alias("hash_a"), F.col("s").alias("left_split"), F.col("image").alias("left_image"), F.col("n").alias("n_left"))
    right = classes.select(F.col("h").alias("hash_b"), F.col("s").alias("right_split"), F.col("image").alias("right_image"), F.col("n").alias("n_right"))
    place = lambda c: F.array_position(F.array(*[F.lit(x) for x in order]), F.col(c))
    return both.join(left, "hash_a").join(right, "hash_b").where(place("left_split") < place("right_split")).select("left_split", "right_split", "left_image", "right_image", "n_left", "n_right", "distance")
