"""The queries of this subpackage by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import clusters, mixing, percentiles, sampling, splits, sql, tokens, visual
from tidemark.sources.tables import table
from tidemark.sources.workspace import Workspace


def _mix(make):
    def run(spark, folder):
        sizes = mixing.sized(table(spark, folder, "documents"), Workspace(spark))
        return make(sizes, mixing.rates(sizes, table(spark, folder, "mix_targets")))

    return run


METRICS = ["laplacian_var", "tenengrad", "rms_contrast", "entropy"]
STATS = "synthetic_real_severe_low_level_stats"


def _daily(spark, folder):
    return percentiles.by_day(table(spark, folder, STATS), ["group_name", "label"], METRICS, "measured_at")


def _comparable(df):
    """Estimates with nine digits: powers differ between engines in the last bit."""
    return df.withColumn("estimate", F.format_string("%.8e", "estimate").cast("double"))


def _percentiles(spark, folder):
    by = ["group_name", "label"]
    return _comparable(percentiles.percentiles(percentiles.combine(_daily(spark, folder), by), by))


def _sample(spark, folder):
    return sampling.QuotaSample(table(spark, folder, "metadata_synthetic"), table(spark, folder, "sampling_targets"))


def _grid(spark, folder):
    return clusters.Grid(table(spark, folder, STATS), Workspace(spark))


def _ties(spark, folder):
    return splits.Ties(table(spark, folder, "metadata"), Workspace(spark))


def _split(make):
    def run(spark, folder):
        ties = _ties(spark, folder)
        return make(ties, splits.assigned(ties))

    return run


QUERIES = {
    "p4_found": lambda spark, folder: clusters.linked_groups(_grid(spark, folder)),
    "p4_clusters": lambda spark, folder: clusters.described(_grid(spark, folder)),
    "p4_members": lambda spark, folder: clusters.members(_grid(spark, folder)),
    "p4_cover": lambda spark, folder: clusters.cover(_grid(spark, folder)),
    "p5_found": lambda spark, folder: _ties(spark, folder).capture_pairs(),
    "p5_captures": lambda spark, folder: _ties(spark, folder).capture_classes(),
    "p5_splits": _split(splits.splits),
    "p5_apart": _split(splits.apart),
    "p5_shares": _split(splits.shares_reached),
    "p1_percentiles": _percentiles,
    "p1_daily_percentiles": lambda spark, folder: _comparable(percentiles.percentiles(_daily(spark, folder), ["group_name", "label", "day"], (0.5, 0.9))),
    "p1_daily_sketch": _daily,
    "p2_found": lambda spark, folder: _sample(spark, folder).unfilled(),
    "p2_sample": lambda spark, folder: _sample(spark, folder).sample(),
    "p2_report": lambda spark, folder: _sample(spark, folder).report,
    "p6_ids": lambda spark, folder: tokens.encode(table(spark, folder, "documents")),
    "p6_decoded": lambda spark, folder: tokens.decoded(table(spark, folder, "documents")),
    "p6_round_trip": lambda spark, folder: tokens.round_trip(table(spark, folder, "documents")),
    "p7_found": _mix(lambda sizes, rated: mixing.short_sources(rated)),
    "p7_mix": _mix(mixing.mixed),
    "p7_bounds": lambda spark, folder: mixing.bounds(_mix(mixing.mixed)(spark, folder), table(spark, folder, "mix_targets")),
    "p7_report": _mix(mixing.mix_report),
    "p8_found": lambda spark, folder: visual.same_look_pairs(table(spark, folder, "documents")),
    "p8_classes": lambda spark, folder: visual.same_look_classes(table(spark, folder, "documents")),
}

SQL = sql.SQL
