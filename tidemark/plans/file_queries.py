"""Files end to end: written by tasks to the shared folder, read back, decoded, listed and verified. S08-S16, I06, I08, J15, J16, K01, K07, K08, K11, K14 of the survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import composition, integrity, kernels, lineage
from tidemark.plans.scoring_queries import _kernel_sql, pixels
from tidemark.plans.views import LABELS_SQL, VIEWS, comparable
from tidemark.sources import files, release, sinks
from tidemark.sources.tables import table
from tidemark.sources.workspace import Workspace


def _folder(spark, name: str) -> str:
    return f"{Workspace(spark).root}/{name}"


def _written(rows: DataFrame) -> None:
    rows.agg(F.sum("size")).collect()


def _images(spark, folder: str, side: int = 1) -> str:
    """The folder of an RGB file for every embedding, label/id.png: 8 x 8 grey levels, each ``side`` pixels wide and high."""
    root = _folder(spark, "images")
    px = pixels(spark, folder).join(table(spark, folder, "embeddings").select("vec_id", "label"), "vec_id")
    at = lambda k: F.floor(k / F.lit(3 * side * 8 * side)).cast("int") * 8 + (F.floor(k / F.lit(3 * side)) % 8).cast("int")
    wide = F.transform(F.sequence(F.lit(0), F.lit(64 * side * side * 3 - 1)), lambda k: F.get("px", at(k)))
    raw = F.unhex(F.array_join(F.transform(wide, lambda v: F.lpad(F.hex(v.cast("bigint")), 2, F.lit("0"))), ""))
    rows = px.select(F.concat_ws("/", F.col("label").cast("string"), F.concat(F.col("vec_id").cast("string"), F.lit(".png"))).alias("path"), raw.alias("pixels"), F.lit(8 * side).alias("width"), F.lit(8 * side).alias("height"))
    _written(sinks.write_images(rows, root, "png"))
    return root


def _id(path: str) -> F.Column:
    return F.regexp_extract(path, r"(\d+)\.png$", 1).cast("bigint")


def _labelled(spark, folder):
    return files.labelled_inventory(spark, _images(spark, folder)).select("label", "name", "relative_path", "pos")


def _headers(spark, folder):
    return files.headers(spark, _images(spark, folder)).select(_id("path").alias("vec_id"), "width", "height", "mode")


def _statistics(spark, folder):
    gray = files.gray_images(spark, _images(spark, folder))
    return comparable(gray.select(_id("path").alias("vec_id"), kernels.low_level_stats("pixels", "width", "height").alias("s")).select("vec_id", "s.*"))


def _hashes(spark, folder):
    gray = files.gray_images(spark, _images(spark, folder, 4))
    return gray.select(_id("path").alias("vec_id"), kernels.perceptual_hash("pixels", "width", "height").alias("hash"))


def _documents(spark, folder):
    """The folder of a file for every document with a text."""
    root = _folder(spark, "texts")
    docs = table(spark, folder, "documents")
    _written(sinks.write_files(docs.select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content")), root))
    return root, docs


def _manifest(spark, folder):
    return sinks.file_manifest(spark, _documents(spark, folder)[0])


def _listed_and_there(spark, folder):
    root, docs = _documents(spark, folder)
    listed = docs.select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("relative_path"))
    return integrity.inventory_difference(listed, files.inventory(spark, root), "relative_path")


def _verified(spark, folder):
    """A manifest against a copy of its files of which every fiftieth was changed since."""
    root, docs = _documents(spark, folder)
    listed = sinks.file_manifest(spark, root)
    copy = _folder(spark, "copy")
    _written(sinks.copy_files(spark, root, copy))
    changed = docs.where("doc_id % 50 = 0 and text is not null")
    _written(sinks.write_files(changed.select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.concat(F.substring("text", 2, 1), F.expr("substring(text, 2)")).cast("binary").alias("content")), copy))
    return integrity.mismatches(listed, files.digests(spark, copy), "relative_path", ["size_bytes", "sha256"]).where("field = 'sha256'")


def _release(spark, folder):
    """A release written and read back: composition by origin."""
    r, root = release.Release.load(spark, folder), _folder(spark, "release")
    sinks.write_metadata(r.real, r.synthetic, root)
    return composition.release_composition(spark.read.parquet(f"{root}/metadata.parquet"))


def _views(spark, folder):
    r, root = release.Release.load(spark, folder), _folder(spark, "splits")
    sinks.write_splits(r.images, root)
    return release.six_views(spark.read.parquet(f"{root}/splits.parquet")).groupBy("view").agg(F.count(F.lit(1)).alias("n_images"), F.countDistinct("image_id").alias("n_ids"))


def _csv(spark, folder):
    r, path = release.Release.load(spark, folder), _folder(spark, "metadata.csv")
    sinks.save_public_csv(r.synthetic.withColumn("_private", F.lit("x")).drop("split"), path)
    back = release.read_csv(spark, path)
    return back.groupBy("label", "asset_split").agg(F.count(F.lit(1)).alias("n"), F.count("image_id").alias("n_ids"), F.sum("rotation_deg").alias("turned"), F.count("sha256").alias("n_digests"))


def _assets(spark, folder):
    """The asset manifest with the pools of its assets, written and read back."""
    ratios = spark.createDataFrame([("train", 1, 2800.0), ("val", 2, 400.0), ("test", 3, 400.0)], "split string, pos int, ratio double")
    r, root = release.Release.load(spark, folder), _folder(spark, "assets")
    sinks.write_assets(r.assets, lineage.asset_pools(r.assets, ratios), root)
    return spark.read.parquet(f"{root}/dirt_assets_manifest.parquet").groupBy("asset_split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("asset_id").alias("n_assets"))


QUERIES = {
    "s08_labelled_inventory": _labelled,
    "s14_headers": _headers,
    "i06_file_statistics": _statistics,
    "i08_file_hash": _hashes,
    "k11_manifest": _manifest,
    "j15_file_inventory": _listed_and_there,
    "v25_manifest_verified": _verified,
    "k07_release_written": _release,
    "k07_assets_written": _assets,
    "k08_splits_written": _views,
    "k04_csv_written": _csv,
}

_FILE = "'texts/' || doc_id || '.txt'"
_PX = "[greatest(0, least(255, floor((x::double + 1.0) * 127)))::int for x in embedding]"

SQL = {
    "s08_labelled_inventory": """select label::int as label, vec_id || '.png' as name, label || '/' || vec_id || '.png' as relative_path,
       row_number() over (order by label, vec_id || '.png') as pos from embeddings""",
    "s14_headers": "select vec_id, 8 as width, 8 as height, 'RGB' as mode from embeddings",
    "i06_file_statistics": _kernel_sql("laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"),
    # 8 x 8 blocks of 4 x 4 equal pixels: the cosines of a block's rows add up
    "i08_file_hash": f"""with c as (select u, k, (select sum(cos(pi() * (2 * (4 * k + j) + 1) * u / 64)) from range(4) t(j)) * case when u = 0 then sqrt(1 / 32.0::double) else sqrt(2 / 32.0::double) end as w
  from range(8) a(u), range(8) b(k)),
p as (select vec_id, unnest({_PX}) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings),
r as (select vec_id, i // 8 as y, x.u as u, sum(v * x.w) as s from p join c x on x.k = i % 8 group by all),
d as (select vec_id, y.u as row, r.u as col, sum(s * y.w) as e from r join c y on y.k = r.y group by all),
m as (select vec_id, median(e) filter (row > 0 and col > 0) as med from d group by vec_id),
h as (select d.vec_id, sum(case when e > med then (1::hugeint << (row * 8 + col)::int) else 0 end) as u from d join m using (vec_id) group by d.vec_id)
select vec_id, case when u >= 9223372036854775808 then (u - 18446744073709551616)::bigint else u::bigint end as hash from h""",
    "k11_manifest": f"select {_FILE} as relative_path, strlen(text) as size_bytes, sha256(text) as sha256 from documents where text is not null",
    "j15_file_inventory": f"""with d as (select {_FILE} as k from documents where text is null)
select 'listed_only' as side, count(*) as n, array_to_string(list_sort(list(k))[1:5], '|') as examples from d having count(*) > 0""",
    "v25_manifest_verified": f"""select {_FILE} as relative_path, 'sha256' as field from documents
where doc_id % 50 = 0 and text is not null and sha256(text) <> sha256(substr(text, 2, 1) || substr(text, 2))""",
    "k07_release_written": VIEWS + f"""
select coalesce(origin, 'combined') as subset, count(*) as n_images, {LABELS_SQL} from images where origin in ('real', 'synthetic') group by rollup (origin)""",
    "k07_assets_written": VIEWS + """, a as (select asset_id, row_number() over (order by asset_id) as r, count(*) over () as n from (select distinct asset_id from assets where asset_id is not null)),
q as (select *, round(n * ratio / 3600.0, 9) as exact from (select max(n) as n from a), (values ('train', 1, 2800), ('val', 2, 400), ('test', 3, 400)) t(split, pos, ratio)),
s as (select *, floor(exact) + (row_number() over (order by exact - floor(exact) desc, split) <= n - sum(floor(exact)) over ())::int as quota from q),
t as (select split, sum(quota) over (order by pos) as last, quota from s),
p as (select asset_id, split from a join t on r > last - quota and r <= last)
select p.split as asset_split, count(*) as n, count(distinct assets.asset_id) as n_assets from assets left join p using (asset_id) group by 1""",
    "k08_splits_written": VIEWS + """, six as (
  select split || '_' || variant as view, image_id from images, (select unnest(['real_only', 'real_plus_synthetic']) as variant)
  where split in ('train', 'val', 'test') and (origin = 'real' or variant = 'real_plus_synthetic'))
select view, count(*) as n_images, count(distinct image_id) as n_ids from six group by view""",
    "k04_csv_written": VIEWS + "select label, asset_split, count(*) as n, count(image_id) as n_ids, sum(rotation_deg)::bigint as turned, count(sha256) as n_digests from syn group by all",
}
