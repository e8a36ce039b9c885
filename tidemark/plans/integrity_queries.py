"""Set algebra, duplicates and lineage: J.., A11, A13, A14, G.., checks of the survey."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import quotas
from tidemark.functions.keys import finite
from tidemark.operators import duplicates, integrity, kernels, lineage, summary
from tidemark.plans.views import VIEWS, over_release, over_values, r6, r9
from tidemark.sources import release
from tidemark.sources.tables import table
from tidemark.sources.workspace import Workspace

METRICS = ["laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"]


def _captures(r):
    """The capture dimension: the captures that the rule sends to val and test, as a configuration names them."""
    named = r.real.where("capture_id is not null").select("capture_id").distinct().withColumn("split", release.split_rule(F.col("capture_id")))
    return named.where("split <> 'train'")


def _deltas(r):
    """Each metric by its own finite values: an image that lacks one keeps the deltas of the other four."""
    return lineage.parent_child_deltas(r.synthetic, r.stats.select("image_id", *[F.when(finite(F.col(m)), F.col(m)).alias(m) for m in METRICS]), METRICS)


def _delta_summary(r):
    return summary.described(summary.long(_deltas(r), [f"delta_{m}" for m in METRICS], "image_id"), "field")


def _hashes(spark, folder):
    e = table(spark, folder, "embeddings")
    return e.select(F.col("vec_id").alias("id"), kernels.sign_hash(F.col("embedding")).alias("hash"), F.when(F.col("label") < 6, "train").when(F.col("label") < 8, "val").otherwise("test").alias("split"))


def _near_hashes(spark, folder):
    """The embeddings and a near copy of each, with one component turned round, filed elsewhere: two hashes that differ in a few bits of 64."""
    e = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    turned = F.transform("embedding", lambda x, i: F.when(i == F.col("vec_id") % 64, -x).otherwise(x))
    both = e.unionByName(e.select((F.col("vec_id") + 10_000_000).alias("vec_id"), ((F.col("label") + 3) % 10).alias("label"), turned.alias("embedding")))
    hashed = both.select(F.col("vec_id").alias("id"), kernels.sign_hash(F.col("embedding")).alias("hash"), F.when(F.col("label") < 6, "train").when(F.col("label") < 8, "val").otherwise("test").alias("split"))
    # read more than once: hashed once
    return Workspace(spark).cut(hashed, "hashes")


def _balanced(r):
    """As many turns as the split has synthetic images, and as many uses of a parent as it allows."""
    parents = r.real.where("label between 1 and 3").select("split", "image_id", "capture_id")
    each = [lineage.balanced_parents(parents.where(F.col("split") == s), quotas.MOST_PER_PARENT[s], n, "split") for s, n in quotas.SPLIT_QUOTAS.items()]
    return reduce(DataFrame.unionAll, each).select("split", "turn", "image_id", "use")


def _plan(spark, synthetic):
    """(split, target, priority, source, quota): the fixed quotas, the allowed sources in the order of their shares in the synthetic table."""
    seats = [(s, t, src, q) for s, total in quotas.SPLIT_QUOTAS.items() for t, q in quotas.quotas(quotas.LABEL_RATIOS, total).items() for src in quotas.SOURCES[t]]
    allowed = spark.createDataFrame(seats, "split string, target int, source int, quota int")
    made = synthetic.groupBy(F.col("synthetic_split").alias("split"), F.col("label").cast("int").alias("target"), F.col("source_label").cast("int").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    mix = allowed.join(made, ["split", "target", "source"], "left").withColumn("ratio", F.coalesce("n", F.lit(0)))
    return quotas.source_priority(mix).select("split", "target", "priority", "source", "quota")


def _outcomes(parents, synthetic):
    """(image_id, boost): that of a parent's first synthetic child; a parent without one takes a boost by hash, each as often as the synthetic table has it."""
    known = synthetic.where("label_boost is not null").select("parent_image_id", F.col("label_boost").cast("int").alias("boost"))
    own = known.where("parent_image_id is not null").groupBy(F.col("parent_image_id").alias("image_id")).agg(F.min("boost").alias("own"))
    # a label is raised by 0 to 4: five rows at most
    counts = known.where("boost between 0 and 4").groupBy("boost").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("boost"))
    steps = counts.select("boost", (upto - F.col("n")).alias("from"), upto.alias("upto"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    both = parents.select("image_id").join(own, "image_id", "left")
    place = F.pmod(F.xxhash64(F.lit("42"), "image_id"), F.col("total"))
    drawn = both.join(F.broadcast(steps), F.col("own").isNull() & (place >= F.col("from")) & (place < F.col("upto")), "left")
    return drawn.select("image_id", F.coalesce("own", "boost").alias("boost"))


def _sampled(spark, folder):
    """The accept/reject loop over parents of each split, by the quotas, ratios and caps of :mod:`tidemark.functions.quotas`."""
    r = release.Release.load(spark, folder)
    one = r.real.where("image_id is not null and capture_id is not null and label between 1 and 3").groupBy("image_id").agg(F.min(F.struct("split", "capture_id", "label")).alias("x"))
    parents = one.select("image_id", "x.split", "x.capture_id", F.col("x.label").alias("source"))
    caps = spark.createDataFrame([(s,) for s in quotas.SPLITS], "split string").select("split", quotas.most_per_parent(F.col("split")).alias("most"))
    return lineage.sampled(parents, _outcomes(parents, r.synthetic), _plan(spark, table(spark, folder, "metadata_synthetic")), caps)


def _pools(spark, folder):
    ratios = spark.createDataFrame([("train", 1, 2800.0), ("val", 2, 400.0), ("test", 3, 400.0)], "split string, pos int, ratio double")
    return lineage.asset_pools(release.Release.load(spark, folder).assets, ratios)


def _verified(r):
    """What children say of their parents against what the parents say of themselves: one field differs wherever a child is filed inconsistently."""
    said = r.synthetic.where("parent_image_id is not null").groupBy(F.col("parent_image_id").alias("image_id")).agg(F.max("parent_label").alias("label"), F.max("capture_id").alias("capture_id"), F.max("day").alias("day"))
    own = r.real.where("image_id is not null").groupBy("image_id").agg(F.min("label").alias("label"), F.min("capture_id").alias("capture_id"), F.min("day").alias("day"))
    return integrity.mismatches(said, own, "image_id", ["label", "capture_id", "day"]).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def _in_several(df, *fields):
    """(field, key, n_splits): what lies in more than one split, for several keys."""
    return reduce(DataFrame.unionAll, [integrity.several_splits(df, f).select(F.lit(f).alias("field"), "key", "n_splits") for f in fields])


def _descriptions(r):
    """The description table: the assets that have one, filed in their smallest pool."""
    return r.assets.where("asset_id is not null and description is not null").groupBy("asset_id").agg(F.min("description").alias("description"), F.min("asset_split").alias("asset_split"))


QUERIES = {
    "a11_delta_summary": over_values(_delta_summary),
    "a13_duplicate_keys": over_release(lambda r: integrity.duplicate_keys(r.real, "image_id")),
    "a13_duplicate_count": over_release(lambda r: r.master.where("image_id is not null").groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")),
    "a14_exact_duplicates": lambda spark, folder: duplicates.exact_duplicates(table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha")), "doc_id", "sha"),
    "j01_union": over_release(lambda r: r.images.groupBy("origin", "synthetic").agg(F.count(F.lit(1)).alias("n"), F.count("parent_image_id").alias("n_children"))),
    "j02_set_equality": over_release(lambda r: integrity.set_difference(r.images, r.master, "image_id")),
    "j03_disjoint": over_release(lambda r: integrity.split_overlaps(r.real)),
    "j04_containment": over_release(lambda r: integrity.missing_from(r.real, r.master.withColumn("split", release.split_rule(F.col("capture_id"))), "image_id", "split")),
    "j05_parent_leak": over_release(lambda r: integrity.parent_leaks(r.synthetic, r.real)),
    "j06_asset_pool": over_release(lambda r: integrity.asset_mismatches(r.synthetic)),
    "j07_parent_capture": over_release(lambda r: integrity.parent_capture_faults(r.synthetic, r.real)),
    "j08_asset_lookup": over_release(lambda r: integrity.asset_lookup(r.synthetic, r.assets)),
    "j11_parent_child_delta": over_values(lambda r: _deltas(r).select("image_id", "parent_image_id", *[f"delta_{m}" for m in METRICS])),
    "j12_near_duplicates": lambda spark, folder: duplicates.near_duplicates(_near_hashes(spark, folder)),
    "j12_near_duplicate_rows": lambda spark, folder: duplicates.near_duplicate_rows(_near_hashes(spark, folder)),
    "j12_between_splits": lambda spark, folder: duplicates.between_splits(_near_hashes(spark, folder)),
    "j12_split_pairs": lambda spark, folder: duplicates.split_pairs(_near_hashes(spark, folder)),
    "j15_inventory_diff": over_release(lambda r: integrity.inventory_difference(r.master, r.images, "relative_path")),
    "j17_partition": over_release(lambda r: integrity.partition_faults(r.images, r.master.withColumn("part", F.col("origin")), "image_id", "part")),
    "j18_capture_split": over_release(lambda r: release.capture_splits(r.real, _captures(r)).groupBy("split").agg(F.count(F.lit(1)).alias("n_images"), F.countDistinct("capture_id").alias("n_captures"), F.countDistinct("label").alias("n_labels"))),
    "j20_asset_partition": _pools,
    "i08_sign_hash": lambda spark, folder: _hashes(spark, folder).select("id", "hash"),
    "i09_hamming": lambda spark, folder: _hashes(spark, folder).select("id", F.bit_count(F.col("hash").bitwiseXOR(F.lit(0x0F0F0F0F0F0F0F0F))).alias("distance")),
    "g03_balanced_parents": over_release(_balanced),
    "j16_verify": over_release(_verified),
    "j21_multi_split": over_release(lambda r: _in_several(r.real, "image_id", "group_id", "source_filename")),
    "v13_synthetic_splits": over_release(lambda r: _in_several(r.synthetic, "image_id", "group_id", "parent_image_id", "asset_id")),
    "j22_orphan_files": over_release(lambda r: integrity.orphan_files(r.images.select("image_id", "relative_path"), r.master.select("relative_path"))),
    "a14_duplicate_report": lambda spark, folder: duplicates.duplicate_report(table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.when(F.col("text").isNull(), "no content").alias("error")), "doc_id", "sha", "doc_id", "error"),
    "j09_asset_map": over_release(lambda r: integrity.asset_map(r.synthetic.select("image_id", "asset_id", "split"), r.assets)),
    "j10_asset_enrich": over_release(lambda r: integrity.enriched_assets(r.assets, _descriptions(r))),
    "j10_strict": over_release(lambda r: integrity.enrichment_faults(r.assets, _descriptions(r))),
    "v10_unique_in_views": over_release(lambda r: integrity.repeated_in_views(release.six_views(r.images))),
    "v17_split_partition": over_release(lambda r: integrity.view_partition(r.images)),
    "g04_accept_reject": _sampled,
    "g05_running_uid": lambda spark, folder: lineage.numbered(_sampled(spark, folder)).select("uid", "split", "target", "attempt", "image_id"),
    "v09_asset_numbering": over_release(lambda r: integrity.asset_numbering(r.assets, 60)),
    "v14_split_inheritance": over_release(lambda r: integrity.split_inheritance(r.synthetic, r.real)),
    "j22_missing_files": over_release(lambda r: integrity.missing_files(r.real.select("image_id", "relative_path"), r.master.select("relative_path"))),
    "checks_audit": over_release(lambda r: integrity.audit(r.real, r.synthetic)),
    "checks_invariants": over_release(lambda r: integrity.invariants(r.master, r.real, r.synthetic, r.assets, (3072, 2048))),
}

_DELTA = VIEWS + f""", one as (select image_id, {", ".join(f"min({m}) filter (isfinite({m})) as {m}" for m in METRICS)} from stats where image_id is not null group by image_id),
edges as (select distinct image_id, parent_image_id from syn where image_id is not null and parent_image_id is not null),
deltas as (select e.image_id, e.parent_image_id, {", ".join(f"c.{m} - p.{m} as delta_{m}" for m in METRICS)}
  from edges e join one c on c.image_id = e.image_id join one p on p.image_id = e.parent_image_id)
"""
_FIELDS = ", ".join(f"'delta_{m}'" for m in METRICS)
_DUP = "with d as (select doc_id, sha256(text) as sha, min(doc_id) over (partition by text) as class_id, count(*) over (partition by text) as n, text from documents where text is not null)"
_OVERLAP = """, ids as (
  select field, coalesce(id, 'nan') as id, split from (select split, unnest(['image_id', 'group_id', 'capture_id']) as field, unnest([image_id, group_id, capture_id]) as id from real)),
pairs as (select * from (values ('train', 'val'), ('train', 'test'), ('val', 'test')) t(left_split, right_split)),
shared as (
  select f.field, left_split, right_split, (select count(*) from (select id from ids where field = f.field and split = left_split
    intersect select id from ids where field = f.field and split = right_split)) as overlap
  from pairs, (select unnest(['image_id', 'group_id', 'capture_id']) as field) f),
leaks as (
  select s.split, (select count(*) from syn where split = 'train' and coalesce(parent_image_id, 'nan') in (select coalesce(image_id, 'nan') from real where real.split = s.split)) as n_leaks
  from (values ('val'), ('test')) s(split)),
pools as (select split, count(*) filter (asset_split is distinct from split) as n_mismatched from syn group by split),
par as (select image_id, min(coalesce(capture_id, 'nan')) as capture from real group by image_id),
caps as (select distinct split, coalesce(capture_id, 'nan') as capture from real),
faults as (
  select split, count(*) filter (not exists (select 1 from par join caps using (capture) where par.image_id = s.parent_image_id and caps.split = s.split)) as n_bad
  from syn s where parent_image_id is not null group by split)
"""
_BITS = """
with src as (select vec_id, label, embedding from embeddings),
b as (select vec_id as id, label, unnest(embedding) as e, generate_subscripts(embedding, 1) - 1 as i from src),
m as (select id, median(e::double) filter (i // 8 > 0 and i % 8 > 0) as med from b group by id),
u as (select b.id, any_value(label) as label, sum(case when e::double > med then (1::hugeint << i::int) else 0 end) as u from b join m using (id) group by b.id),
h as (select id, case when label < 6 then 'train' when label < 8 then 'val' else 'test' end as split, case when u >= 9223372036854775808 then (u - 18446744073709551616)::bigint else u::bigint end as hash from u)
"""
_COPIES = """with src as (
  select vec_id, label, embedding from embeddings
  union all select vec_id + 10000000, (label + 3) % 10, list_transform(embedding, lambda x, i: case when i - 1 = vec_id % 64 then -x else x end) from embeddings),
"""
_NEAR = _BITS.replace("with src as (select vec_id, label, embedding from embeddings),\n", _COPIES) + """, s as (select id, split, hash from h),
v as (select distinct hash from s),
near as (select a.hash as hash_a, b.hash as hash_b, bit_count(xor(a.hash, b.hash))::int as distance from v a join v b on a.hash < b.hash and bit_count(xor(a.hash, b.hash)) <= 4)
"""


def _unique(view: str, key: str) -> str:
    return f"(select count(*) from (select {key} from {view} where {key} is not null group by {key} having count(*) > 1))"


_INVARIANTS = {
    **{f"unique_{k}_{n}": (_unique(v, k), "keys") for n, v in (("master", "master"), ("real", "real"), ("synthetic", "syn")) for k in ("image_id", "relative_path")},
    "real_and_synthetic_disjoint": ("(select count(*) from (select coalesce(image_id, 'nan') from real intersect select coalesce(image_id, 'nan') from syn))", "ids"),
    "master_lacks_no_row": ("(select count(*) from (select coalesce(image_id, 'nan') from images except select coalesce(image_id, 'nan') from master))", "ids"),
    "master_adds_no_row": ("(select count(*) from (select coalesce(image_id, 'nan') from master except select coalesce(image_id, 'nan') from images))", "ids"),
    "origin_of_real": ("(select count(*) from real where origin is distinct from 'real')", "rows"),
    "origin_of_synthetic": ("(select count(*) from syn where origin is distinct from 'synthetic')", "rows"),
    "one_resolution": ("(select count(*) from master where width is distinct from 3072 or height is distinct from 2048)", "rows"),
    "labels_in_domain": ("(select count(*) from master where label is null or label not between 1 and 5)", "rows"),
    "synthetic_split_equals_asset_split": ("(select count(*) from syn where synthetic_split is distinct from asset_split)", "rows"),
    "parents_exist": ("(select count(distinct parent_image_id) from syn where parent_image_id not in (select coalesce(image_id, 'nan') from real))", "ids"),
    "assets_exist": ("(select count(distinct asset_id) from syn where asset_id not in (select coalesce(asset_id, 'nan') from assets))", "ids"),
}

SQL = {
    "a11_delta_summary": _DELTA + f"""
select field, count(*) as n, {r9("avg(value)")} as mean, {r9("stddev_pop(value)")} as std, {r9("min(value)")} as min, {r9("quantile_cont(value, 0.5)")} as median, {r9("max(value)")} as max
from (select unnest([{_FIELDS}]) as field, unnest([{", ".join(f"delta_{m}" for m in METRICS)}]) as value from deltas) where value is not null group by field""",
    "a13_duplicate_keys": VIEWS + "select image_id as key, count(*) as n from real where image_id is not null group by 1 having count(*) > 1 order by 1 limit 5",
    "a13_duplicate_count": VIEWS + "select image_id, count(*) as n from master where image_id is not null group by 1 having count(*) > 1",
    "a14_exact_duplicates": _DUP + " select doc_id, class_id, n from d where n > 1",
    "j01_union": VIEWS + "select origin, synthetic, count(*) as n, count(parent_image_id) as n_children from images group by all",
    "j02_set_equality": VIEWS + """, k as (select coalesce(image_id, 'nan') as k, bit_or(s) as m from (select image_id, 1 as s from images union all select image_id, 2 from master) group by 1)
select count(*) filter (m = 1) as only_left, count(*) filter (m = 2) as only_right, count(*) filter (m = 3) as in_both from k""",
    "j03_disjoint": VIEWS + _OVERLAP + "select * from shared",
    "j04_containment": VIEWS + f""", ms as (select coalesce(image_id, 'nan') as k, case when substr(md5(capture_id), 1, 1) in ('0', '1') then 'val' when substr(md5(capture_id), 1, 1) in ('2', '3') then 'test' else 'train' end as split from master)
select split, count(*) filter (not exists (select 1 from ms where ms.k = r.k and ms.split = r.split)) as missing from (select distinct split, coalesce(image_id, 'nan') as k from real) r group by split""",
    "j05_parent_leak": VIEWS + _OVERLAP + "select * from leaks",
    "j06_asset_pool": VIEWS + _OVERLAP + "select * from pools",
    "j07_parent_capture": VIEWS + _OVERLAP + "select * from faults",
    "j08_asset_lookup": VIEWS + """, p as (select asset_id, min(asset_split) as pool from assets where asset_id is not null group by 1)
select case when s.asset_id is null then 'no_asset' when pool is null then 'unknown' when pool is not distinct from split then 'ok' else 'wrong_pool' end as verdict, count(*) as n
from syn s left join p using (asset_id) group by 1""",
    "j11_parent_child_delta": _DELTA + f"select image_id, parent_image_id, {', '.join(r9(f'delta_{m}') + f' as delta_{m}' for m in METRICS)} from deltas",
    "j12_near_duplicates": _NEAR + "select * from near",
    "j12_near_duplicate_rows": _NEAR + """, l as (select hash, count(*) as n_links from (select hash_a as hash from near union all select hash_b from near) group by 1)
select id, min(id) over (partition by hash) as class_id, count(*) over (partition by hash) as n_same, coalesce(n_links, 0) as n_links from s left join l using (hash)""",
    "j12_between_splits": _NEAR + """, p as (select hash_a, hash_b from near union all select hash, hash from v),
q as (select distinct hash_a, hash_b, least(x.split, y.split) as left_split, greatest(x.split, y.split) as right_split from p join s x on x.hash = hash_a join s y on y.hash = hash_b where x.split <> y.split)
select left_split, right_split, count(*) as n_links from q group by all""",
    "j15_inventory_diff": VIEWS + """, a as (select distinct relative_path as k from master where relative_path is not null), b as (select distinct relative_path as k from images where relative_path is not null),
d as (select 'listed_only' as side, k from (select k from a except select k from b) union all select 'actual_only', k from (select k from b except select k from a))
select side, count(*) as n, array_to_string(list_sort(list(k))[1:5], '|') as examples from d group by side""",
    "j17_partition": VIEWS + """, k as (select coalesce(image_id, 'nan') as k, bool_or(w) as inside, count(distinct part) as parts from
  (select image_id, true as w, null as part from images union all select image_id, null, origin from master) group by 1)
select count(*) filter (parts = 0) as in_no_part, count(*) filter (parts > 1) as in_several_parts, count(*) filter (inside is null) as not_in_whole from k""",
    "j18_capture_split": VIEWS + "select split, count(*) as n_images, count(distinct capture_id) as n_captures, count(distinct label) as n_labels from real group by split",
    "j20_asset_partition": VIEWS + """, a as (select asset_id, row_number() over (order by asset_id) as r, count(*) over () as n from (select distinct asset_id from assets where asset_id is not null)),
q as (select *, round(n * ratio / 3600.0, 9) as exact from (select max(n) as n from a), (values ('train', 1, 2800), ('val', 2, 400), ('test', 3, 400)) t(split, pos, ratio)),
s as (select *, floor(exact) + (row_number() over (order by exact - floor(exact) desc, split) <= n - sum(floor(exact)) over ())::int as quota from q),
t as (select split, sum(quota) over (order by pos) as last, quota from s)
select asset_id, split from a join t on r > last - quota and r <= last""",
    "i08_sign_hash": _BITS + "select id, hash from h",
    "i09_hamming": _BITS + "select id, bit_count(xor(hash, 1085102592571150095))::int as distance from h",
    "g03_balanced_parents": VIEWS + """, u as (
  select split, image_id, capture_id, md5('42|' || image_id) as d, unnest(case when split = 'train' then [1, 2] else [1] end) as use
  from (select distinct split, image_id, capture_id from real where label between 1 and 3 and image_id is not null)),
r as (select *, row_number() over (partition by split, capture_id order by use, d, image_id) as round from u),
t as (select *, row_number() over (partition by split order by round, d, image_id, use)::int as turn from r)
select split, turn, image_id, use from t where turn <= case split when 'train' then 2800 else 400 end""",
    "v09_asset_numbering": VIEWS + """, w as (select 'a_' || printf('%04d', i) as k from range(1, 61) t(i)), h as (select distinct asset_id as k from assets where asset_id is not null)
select k as asset_id, 'missing' as fault from (select k from w except select k from h) union all select k, 'beyond' from (select k from h except select k from w)""",
    "v14_split_inheritance": VIEWS + """select split, count(*) as n_children, count(*) filter (exists (select 1 from real where real.image_id = syn.parent_image_id)
    and not exists (select 1 from real where real.image_id = syn.parent_image_id and real.split = syn.split)) as n_elsewhere
from syn where parent_image_id is not null group by split""",
    "j22_missing_files": VIEWS + "select image_id, relative_path from real where not exists (select 1 from master where master.relative_path = real.relative_path)",
    "checks_audit": VIEWS + _OVERLAP + """
, c as (
  select 'no_' || field || '_overlap_' || left_split || '_' || right_split || '_real' as "check", overlap as violations, 'overlap' as why from shared
  union all select 'no_training_parent_leak_into_' || split || '_real', n_leaks, 'n_leaks' from leaks
  union all select 'asset_split_consistent_' || split, n_mismatched, 'n_mismatched' from pools
  union all select 'parent_capture_consistent_' || split, n_bad, 'n_bad' from faults)
select "check", violations = 0 as passed, violations, why || '=' || violations as details from c""",
    "checks_invariants": VIEWS + ", c as (" + " union all ".join(f"""select '{n}' as "check", {q} as violations, '{w}' as why""" for n, (q, w) in _INVARIANTS.items()) + """)
select "check", violations = 0 as passed, violations, why || '=' || violations as details from c""",
}

_VIEWS6 = """, six as (
  select split || '_' || variant as view, origin, image_id from images, (select unnest(['real_only', 'real_plus_synthetic']) as variant)
  where split in ('train', 'val', 'test') and (origin = 'real' or variant = 'real_plus_synthetic'))
"""


def _several_sql(view: str, *fields: str) -> str:
    one = [f"select '{f}' as field, {f} as key, count(distinct split) as n_splits from {view} where {f} is not null group by {f} having count(distinct split) > 1" for f in fields]
    return VIEWS + " union all ".join(one)


SQL |= {
    "j16_verify": VIEWS + """, a as (select parent_image_id as image_id, max(parent_label) as label, max(capture_id) as capture_id, max(day) as day from syn where parent_image_id is not null group by 1),
b as (select image_id, min(label) as label, min(capture_id) as capture_id, min(day) as day from real where image_id is not null group by 1),
d as (select unnest(['label', 'capture_id', 'day']) as field, unnest([a.label is distinct from b.label, a.capture_id is distinct from b.capture_id, a.day is distinct from b.day]) as bad from a join b using (image_id))
select field, count(*) as n from d where bad group by field""",
    "j21_multi_split": _several_sql("real", "image_id", "group_id", "source_filename"),
    "v13_synthetic_splits": _several_sql("syn", "image_id", "group_id", "parent_image_id", "asset_id"),
    "j22_orphan_files": VIEWS + "select image_id, relative_path from images where not exists (select 1 from master where master.relative_path = images.relative_path)",
    "j12_split_pairs": _NEAR + """, p as (select hash_a, hash_b, distance from near union all select hash_b, hash_a, distance from near union all select hash, hash, 0 from v),
held as (select hash, split, min(id) as image, count(*) as n from s group by all)
select x.split as left_split, y.split as right_split, x.image as left_image, y.image as right_image, x.n as n_left, y.n as n_right, distance
from p join held x on x.hash = hash_a join held y on y.hash = hash_b where x.split || ' ' || y.split in ('train val', 'train test', 'val test')""",
    "a14_duplicate_report": """with d as (select doc_id, sha256(text) as sha, row_number() over (partition by text order by doc_id) - 1 as place, count(*) over (partition by text) as n from documents where text is not null)
select 'duplicate' as status, sha as digest, max(n) as n_images, (place // 1000)::int as part, string_agg(doc_id::varchar, '|' order by doc_id) as image_ids, null::varchar as details from d where n > 1 group by sha, place // 1000
union all select 'error', null, 1, 0, doc_id::varchar, 'no content' from documents where text is null
union all select 'ok', null, 0, 0, null, 'no equal contents' where not exists (select 1 from d where n > 1)""",
    "j09_asset_map": VIEWS + """, p as (select asset_id, min(asset_split) as pool from assets where asset_id is not null group by 1)
select image_id, asset_id, split, pool as asset_pool from (select image_id, asset_id, split from syn) s left join p using (asset_id)""",
    "j10_asset_enrich": VIEWS + """, t as (select asset_id, min(description) as description, min(asset_split) as asset_split from assets where asset_id is not null and description is not null group by 1)
select a.asset_id, a.asset_filename, a.release_relative_path, a.asset_split, t.description, a.preparation_category, a.width, a.height, a.mode, a.sha256 from assets a join t using (asset_id)""",
    "j10_strict": VIEWS + """, t as (select asset_id, min(description) as description, min(asset_split) as asset_split from assets where asset_id is not null and description is not null group by 1),
a as (select asset_id, min(asset_split) as lo, max(asset_split) as hi from assets where asset_id is not null group by 1)
select asset_id, case when t.asset_id is null then 'no_description' else 'other_split' end as fault from a left join t using (asset_id)
where t.asset_id is null or lo is distinct from t.asset_split or hi is distinct from t.asset_split""",
    "v10_unique_in_views": VIEWS + _VIEWS6 + "select view, count(*) filter (n > 1) as n_repeated from (select view, image_id, count(*) as n from six where image_id is not null group by all) group by view",
    "v17_split_partition": VIEWS + _VIEWS6 + """, k as (
  select origin, coalesce(image_id, 'nan') as k, count(distinct split) as parts from (
    select origin, image_id, null as split from images union all
    select origin, image_id, split from images where split in ('train', 'val', 'test')) group by all)
select origin, count(*) filter (parts = 0) as in_no_part, count(*) filter (parts > 1) as in_several_parts, 0::bigint as not_in_whole from k where origin in ('real', 'synthetic') group by origin""",
}
