"""The views that the queries and their SQL share, and what makes their results comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import finite, key_sql
from tidemark.operators.summary import rounded
from tidemark.sources.release import Release
from tidemark.sources.tables import table


def over_release(make: Callable[[Release], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: comparable(make(Release.load(spark, folder)))


def over_values(make: Callable[[Release], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """For statistics of any size: nine digits of each number, as engines differ in the last bits of a sum."""
    return lambda spark, folder: nine_digits(make(Release.load(spark, folder)))


def nine_digits(df: DataFrame) -> DataFrame:
    """Doubles with nine significant digits, both zeros as one; null, NaN and infinities stay."""
    def one(c: str) -> Column:
        x = F.col(c)
        return (F.when(finite(x), F.format_string("%.8e", x).cast("double")).otherwise(x) + F.lit(0.0)).alias(c)

    return df.select(*[one(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 digits, counts as bigint."""
    return rounded(df)


def annotations(spark: SparkSession, folder: str) -> DataFrame:
    """Votes made of the events: the user is the image, the event type the annotator, in order of the event id."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("image_id"), F.col("event_type").alias("annotator"), (1 + F.pmod(F.floor("value"), F.lit(5))).cast("int").alias("label"), F.col("event_id").alias("pos")
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions made of the synthetic images: the truth is the label, the prediction the source label raised by its boost, the score the mean blockage."""
    m = table(spark, folder, "metadata_synthetic")
    return m.where("label between 1 and 5 and source_label between 1 and 5").select(
        "generator_version", F.col("label").alias("target_label"), F.least(F.lit(5), F.col("source_label") + F.coalesce("label_boost", F.lit(0))).alias("pred_label"),
        (F.col("label") >= 4).cast("int").alias("severe"), F.col("avg_blockage").alias("score"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Run results made of the orders: three models, four settings, three seeds, with the five metrics."""
    o = table(spark, folder, "orders")
    from tidemark.operators.rollup import PAIRS

    names = [PAIRS[0][0], PAIRS[0][1], PAIRS[1][0], PAIRS[1][1]]
    setting = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    frac = lambda c, k: (F.col(c) % k) / float(k)
    return o.select(
        F.concat(F.lit("m"), (F.col("o_custkey") % 3).cast("string")).alias("model"), setting.alias("setting"), (F.col("o_custkey") % 7 % 3).cast("int").alias("seed"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"), frac("o_orderkey", 97).alias("a"), frac("o_custkey", 89).alias("b"), frac("o_orderkey", 83).alias("c"), frac("o_custkey", 79).alias("d"),
    )


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    metrics = {"accuracy": "a", "macro_f1": "b", "weighted_kappa": "c", "mae": "d", "within1": "a"}
    return runs(spark, folder).groupBy("model", "setting", "seed").agg(*[F.avg(c).alias(m) for m, c in metrics.items()])


def run_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The same runs with an array of per-class structs."""
    each = runs(spark, folder).groupBy("model", "setting", "seed", "label").agg(F.avg("a").alias("precision"), F.avg("b").alias("recall"), F.avg("c").alias("f1"), F.count(F.lit(1)).alias("support"))
    return each.groupBy("model", "setting", "seed").agg(F.collect_list(F.struct("label", "precision", "recall", "f1", "support")).alias("per_class"))


_K = {k: f"{key_sql(k)} as {k}" for k in ("image_id", "capture_id", "group_id", "parent_image_id", "asset_id")}
_RULE = f"""case when substr(md5({key_sql("capture_id")}), 1, 1) in ('0', '1') then 'val'
  when substr(md5({key_sql("capture_id")}), 1, 1) in ('2', '3') then 'test' else 'train' end"""
_REST = "* exclude (image_id, capture_id, group_id, parent_image_id, asset_id)"

#: Common table expressions: real, syn, master, assets, stats, images, ann, pred, runs.
VIEWS = f"""
with real as (select {", ".join(_K.values())}, {_REST}, {_RULE} as split from metadata_real),
syn as (select {", ".join(_K.values())}, {_REST}, synthetic_split as split from metadata_synthetic),
master as (select {", ".join(_K.values())}, {_REST} from metadata),
assets as (select {_K["asset_id"]}, * exclude (asset_id) from dirt_assets_manifest),
stats as (select {_K["image_id"]}, * exclude (image_id) from synthetic_real_severe_low_level_stats),
images as (select * from real union all by name select * from syn),
ann as (select user_id as image_id, event_type as annotator, (1 + ((floor(value)::bigint % 5) + 5) % 5)::int as label, event_id as pos from events),
first_vote as (select image_id, annotator, arg_min(label, pos) as label from ann where label is not null and image_id is not null and annotator is not null group by all),
pred as (
  select generator_version, label as target_label, least(5, source_label + coalesce(label_boost, 0)) as pred_label, (label >= 4)::int as severe, avg_blockage as score
  from metadata_synthetic where label between 1 and 5 and source_label between 1 and 5),
runs as (
  select 'm' || (o_custkey % 3) as model,
         ['train_real_only__eval_real_only', 'train_real_plus_synthetic__eval_real_only', 'train_real_only__eval_real_plus_synthetic',
          'train_real_plus_synthetic__eval_real_plus_synthetic'][(o_orderkey % 4 + 1)::int] as setting,
         (o_custkey % 7 % 3)::int as seed, substr(o_orderpriority, 1, 1)::int as label,
         (o_orderkey % 97) / 97.0::double as a, (o_custkey % 89) / 89.0::double as b, (o_orderkey % 83) / 83.0::double as c, (o_custkey % 79) / 79.0::double as d
  from orders),
results as (
  select model, setting, seed, avg(a) as accuracy, avg(b) as macro_f1, avg(c) as weighted_kappa, avg(d) as mae, avg(a) as within1 from runs group by all)
"""
LABELS_SQL = ", ".join(f"count(*) filter (label = {k}) as label_{k}" for k in range(1, 6))


def r9(expr: str) -> str:
    """Nine significant digits."""
    return f"case when isfinite({expr}) then printf('%.8e', {expr})::double else {expr} end + 0.0"


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"
