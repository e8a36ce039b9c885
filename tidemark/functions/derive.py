"""Column functions that derive keys, names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABELS = (1, 2, 3, 4, 5)
BLOCK_SECONDS = 600
#: Fixed value: the shape of an original file name.
FILE_NAME_SQL = r"^(\d{8})_(cambot\d+)_(\d{8})_(090001|160001)_(cambot\d+)_(\d{8})_(090001|160001)_sec(\d+)\.(jpg|jpeg|png)$"
FILE_NAME = "(?i)" + FILE_NAME_SQL
#: Upper bounds (exclusive) of the mean blockage for a boost of 0, 1, 2, 3; 4 beyond.
BOOST_BELOW = (0.02, 0.08, 0.15, 0.25)


def parse_file_name(name: Column) -> Column:
    """struct(valid, reason, cam, day, state, sec) of an original file name; the folder part is ignored.

    The first reason that applies, in this order: regex_no_match (also for null), camera_mismatch, timecode_mismatch, date_mismatch_prefix_capture; else ok.
    cam, day and state are null unless ok; sec is null only where the name doesn't match or its number exceeds a bigint.
    """
    base = F.substring_index(name, "/", -1)
    part = lambda k: F.regexp_extract(base, FILE_NAME, k)
    reason = (
        F.when(~F.coalesce(F.rlike(base, F.lit(FILE_NAME)), F.lit(False)), "regex_no_match")
        .when(part(2) != part(5), "camera_mismatch")
        .when(part(4) != part(7), "timecode_mismatch")
        .when((part(1) != part(3)) | (part(3) != part(6)), "date_mismatch_prefix_capture")
        .otherwise("ok")
    )
    ok = reason == "ok"
    state = F.when(part(4) == "090001", "morning").otherwise("evening")
    return F.struct(
        ok.alias("valid"), reason.alias("reason"), F.when(ok, part(2)).alias("cam"), F.when(ok, part(3)).alias("day"),
        F.when(ok, state).alias("state"), part(8).try_cast("bigint").alias("sec"),
    )


def capture_id(cam: Column, state: Column, day: Column) -> Column:
    """cam__state__day; null if a part is null."""
    return F.concat(cam, F.lit("__"), state, F.lit("__"), day)


def block_index(sec: Column, seconds: int = BLOCK_SECONDS) -> Column:
    """The number of the block of ``seconds``; -1 before the start."""
    return F.when(sec < 0, -1).otherwise(F.floor(sec / seconds)).cast("int")


def group_id(capture: Column, block: Column) -> Column:
    """capture__blkNNN, with more digits where three don't do."""
    return F.when(capture.isNotNull() & block.isNotNull(), F.format_string("%s__blk%03d", capture, block))


def real_image_id(cam: Column, state: Column, day: Column, sec: Column) -> Column:
    """R_cam_state_day_SSSSSS; null if a part is null."""
    return F.when(cam.isNotNull() & state.isNotNull() & day.isNotNull() & sec.isNotNull(), F.format_string("R_%s_%s_%s_%06d", cam, state, day, sec))


def synthetic_image_id(uid: Column) -> Column:
    """S_NNNNNNN."""
    return F.when(uid.isNotNull(), F.format_string("S_%07d", uid))


def asset_key(number: Column) -> Column:
    """A_NNNN."""
    return F.when(number.isNotNull(), F.format_string("A_%04d", number))


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root`` with forward slashes; a path outside stays as it is."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    top = root.rstrip("/") + "/"
    return F.when(F.startswith(slashed, F.lit(top)), F.substring(slashed, F.lit(len(top) + 1), F.length(slashed))).otherwise(slashed)


def absolute_path(columns: list[str], root: str) -> Column:
    """root/relative_path where that column exists, else release_path; neither: ``KeyError``."""
    if "relative_path" in columns:
        return F.concat(F.lit(root.rstrip("/") + "/"), F.col("relative_path"))
    if "release_path" in columns:
        return F.col("release_path")
    raise KeyError("relative_path or release_path")


def label_boost(blockage: Column) -> Column:
    """0..4 by the mean blockage; a bound belongs to the step above it; null and NaN give null."""
    out = F.when(blockage.isNull() | F.isnan(blockage), None)
    for step, below in enumerate(BOOST_BELOW):
        out = out.when(blockage < below, step)
    return out.otherwise(4).cast("int")


def boosted_label(label: Column, blockage: Column) -> Column:
    """The label raised by the boost, at most 5."""
    boost = label_boost(blockage)
    return F.when(label.isNotNull() & boost.isNotNull(), F.least(F.lit(5), label + boost)).cast("int")


def mean_blockage(alpha: Column, opacity: Column) -> Column:
    """The mean of alpha * opacity over an array of alphas; null for an empty array."""
    return F.try_divide(F.aggregate(alpha, F.lit(0.0), lambda s, a: s + a * opacity), F.size(alpha).cast("double"))


def attempt_seed(uid: Column, seed: int = 42) -> Column:
    """seed * 1,000,000 + uid."""
    return (F.lit(seed).cast("bigint") * 1_000_000 + uid).cast("bigint")


def day_text(day: Column) -> Column:
    """YYYYMMDD as e.g. ``Mar 01``; null where it isn't a date."""
    return F.date_format(F.try_to_timestamp(day, F.lit("yyyyMMdd")), "MMM dd")


def session_text(cam_state: Column) -> Column:
    """``cambot1__morning`` as ``cambot1 morning``."""
    return F.replace(cam_state, F.lit("__"), F.lit(" "))


def as_number(text: Column) -> Column:
    """The number in a column of any type; null where there is none."""
    return text.try_cast("double")


def id_text(col: Column) -> Column:
    """An id as the audits compare it: null counts as the id ``nan``."""
    return F.coalesce(col.cast("string"), F.lit("nan"))


def spelled_camera(cam: Column) -> Column:
    """A camera in one spelling: ``CAM-24``, ``cambot_24`` and ``cambot24`` are the same; null where there is no number."""
    number = F.regexp_extract(F.lower(cam), r"(\d+)", 1)
    return F.when(number != "", F.concat(F.lit("cambot"), number.try_cast("bigint").cast("string")))
