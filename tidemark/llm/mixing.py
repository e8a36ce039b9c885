"""Combining sources so that each gives its share of a budget in tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.sources.workspace import Workspace

SEED = 20_240_301


def _unit(*cols: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash: the same on every machine and at every partitioning."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11).cast("double") / F.lit(float(2**53))


def sized(docs: DataFrame, work: Workspace, id: str = "doc_id", text: str = "text", source: str = "source", path: str = tokens.TOKENIZERS) -> DataFrame:
    """(id, source, n_tokens) of every document, in tokens of byte_bpe_50k; null and empty texts have 0. Written to the shared folder."""
    rows = tokens.sized(docs, source, id, text, path)
    return work.cut(rows.select(F.col(id).alias("id"), F.col(source).alias("source"), "n_tokens"), "sized")


def rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per row of ``targets``: source_tokens, total_tokens, wanted tokens, the repetition rate (capped at max_repeats) and whether it falls short.

    A source that isn't there, or a null one, has 0 tokens and rate 0; documents without source count in the total. A null share or budget wants nothing;
    null or negative max_repeats allow no use.
    """
    by_source = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total_tokens"))
    rows = targets.select("mix_id", "source", "target_share", "max_repeats", "budget_share").join(by_source, "source", "left").withColumn("total_tokens", total.scalar())
    tokens_ = F.coalesce("source_tokens", F.lit(0))
    most = F.greatest(F.coalesce(F.col("max_repeats"), F.lit(0)), F.lit(0))
    wanted = F.coalesce(F.col("target_share") * F.col("budget_share") * F.col("total_tokens"), F.lit(0.0))
    return rows.select(
        "mix_id", "source", "target_share", "max_repeats", "budget_share", tokens_.alias("source_tokens"), "total_tokens", wanted.alias("wanted_tokens"),
        F.least(F.coalesce(F.try_divide(wanted, tokens_.cast("double")), F.lit(0.0)), most.cast("double")).alias("rate"),
        (most * tokens_ < wanted).alias("short"),
    )


def mixed(sizes: DataFrame, rated: DataFrame) -> DataFrame:
    """(mix_id, source, id, copy, n_tokens): each document floor(rate) times, and once more with probability of the rate's fraction.

    The draw is a hash of mix and document, so the same documents come out at every partitioning; at a rate of max_repeats there is no draw,
    and no document comes more often than max_repeats.
    """
    draw = F.when(_unit(F.col("mix_id"), F.col("id")) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    copies = (F.floor("rate") + draw).cast("int")
    used = sizes.join(rated.where("rate > 0").select("mix_id", "source", "rate"), "source").withColumn("copies", copies).where("copies > 0")
    return used.select("mix_id", "source", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "n_tokens")


def bounds(copies: DataFrame, targets: DataFrame) -> DataFrame:
    """Per row of the targets: documents that the mix uses more often than max_repeats."""
    times = copies.groupBy("mix_id", "source", "id").agg(F.count(F.lit(1)).alias("times"))
    allowed = targets.select("mix_id", "source", F.coalesce("max_repeats", F.lit(0)).alias("most"))
    over = times.join(allowed, ["mix_id", "source"]).where("times > most").groupBy("mix_id", "source").agg(F.count(F.lit(1)).alias("n_over"))
    return targets.select("mix_id", "source").join(over, ["mix_id", "source"], "left").select("mix_id", "source", F.coalesce("n_over", F.lit(0)).alias("n_over"))


def mix_report(sizes: DataFrame, rated: DataFrame) -> DataFrame:
    """Per row of the targets: wanted and actual tokens, documents used, target and actual share of the mix, and whether the source falls short."""
    draw = F.when(_unit(F.col("mix_id"), F.col("id")) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    used = sizes.join(rated.where("rate > 0").select("mix_id", "source", "rate"), "source").withColumn("copies", (F.floor("rate") + draw).cast("bigint"))
    got = used.where("copies > 0").groupBy("mix_id", "source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("actual_tokens"), F.count(F.lit(1)).alias("n_docs"), F.sum("copies").alias("n_records"))
    whole = got.groupBy("mix_id").agg(F.sum("actual_tokens").alias("mix_tokens"))
    none = F.lit(0).cast("bigint")
    return rated.join(got, ["mix_id", "source"], "left").join(whole, "mix_id", "left").select(
        "mix_id", "source", "target_share", "wanted_tokens", F.coalesce("actual_tokens", none).alias("actual_tokens"), F.coalesce("n_docs", none).alias("n_docs"),
        F.coalesce("n_records", none).alias("n_records"), F.coalesce(F.try_divide("actual_tokens", "mix_tokens"), F.lit(0.0)).alias("actual_share"), "short",
    )


def short_sources(rated: DataFrame) -> DataFrame:
    """(mix_id, source) of the rows whose source can't give its share within max_repeats."""
    return rated.where("short").select("mix_id", "source")
