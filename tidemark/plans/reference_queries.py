"""Queries of the reference audit (p3_...) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.keys import key_sql
from tidemark.operators.references import Child, Parent, orphan_references, orphans_by_month, orphans_found
from tidemark.sources.tables import table


def failing_references(spark: SparkSession, folder: str) -> DataFrame:
    """Every failing reference of the release's tables."""
    synthetic, stats = table(spark, folder, "metadata_synthetic"), table(spark, folder, "synthetic_real_severe_low_level_stats")
    real_stats = stats.where("group_name = 'real'")
    return orphan_references(
        [
            Child("metadata_synthetic", "parent_image_id", synthetic, "image_id", "parent_image_id", "ingest_ts", "image"),
            Child("metadata_synthetic", "asset_id", synthetic, "image_id", "asset_id", "ingest_ts", "asset"),
            Child("synthetic_real_severe_low_level_stats", "image_id", real_stats, "image_id", "image_id", "measured_at", "image"),
        ],
        [
            Parent("image", table(spark, folder, "metadata_real"), "image_id", "ingest_ts", "deleted_at"),
            Parent("asset", table(spark, folder, "dirt_assets_manifest"), "asset_id", "ingest_ts", "deleted_at"),
        ],
    )


QUERIES = {
    "p3_found": lambda spark, folder: orphans_found(failing_references(spark, folder)),
    "p3_by_month": lambda spark, folder: orphans_by_month(failing_references(spark, folder)),
}

_REFS = f"""
with syn as (
  select {key_sql("image_id")} as child, {key_sql("parent_image_id")} as p, {key_sql("asset_id")} as a,
         min(ingest_ts) over (partition by {key_sql("image_id")}) as t
  from metadata_synthetic),
st as (
  select {key_sql("image_id")} as child, min(measured_at) as t
  from synthetic_real_severe_low_level_stats where group_name = 'real' group by 1),
parents as (
  select 'image' as space, {key_sql("image_id")} as k, ingest_ts as s, deleted_at as e from metadata_real
  union all
  select 'asset', {key_sql("asset_id")}, ingest_ts, deleted_at from dirt_assets_manifest),
refs as (
  select 'metadata_synthetic' as child_table, 'parent_image_id' as ref_field, 'image' as space, child, p as k, t from syn
  union select 'metadata_synthetic', 'asset_id', 'asset', child, a, t from syn
  union select 'synthetic_real_severe_low_level_stats', 'image_id', 'image', child, child, t from st),
failed as (
  select * from refs where child is not null and k is not null and not exists (
    select 1 from parents u where u.space = refs.space and u.k = refs.k and u.s <= refs.t and (u.e is null or u.e > refs.t)))
"""

SQL = {
    "p3_found": _REFS + "select distinct child_table, ref_field, child as image_id from failed",
    "p3_by_month": _REFS + """, told as (
  select failed.*, case
    when exists (select 1 from parents u where u.space = failed.space and u.k = failed.k and u.e <= failed.t and u.e > u.s) then 'withdrawn'
    when exists (select 1 from parents u where u.space = failed.space and u.k = failed.k and u.s > failed.t and (u.e is null or u.e > u.s)) then 'later'
    else 'missing' end as why
  from failed)
select child_table, ref_field, strftime(t, '%Y-%m') as month, why, count(*) as n_references, count(distinct child) as n_images
from told group by all""",
}
