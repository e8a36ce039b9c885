"""Composition and summaries: A.., F.., O.., P.., S.. of the survey."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import derive, quotas
from tidemark.functions.keys import finite
from tidemark.operators import composition as comp
from tidemark.operators import summary
from tidemark.operators.ranking import percentiles
from tidemark.plans.views import LABELS_SQL, VIEWS, over_release, over_values, r6, r9
from tidemark.sources import release
from tidemark.sources.release import SETTINGS
from tidemark.sources.tables import table

PARAMETERS = ["rotation_deg", "coverage_scale", "blur_scale_factor", "opacity", "avg_blockage", "label_boost"]
METRICS = ["laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"]
_FINITE = " and ".join(f"isnotnull({m}) and not isnan({m}) and abs({m}) < double('infinity')" for m in METRICS)


def _all_values(r):
    return summary.long(r.stats, METRICS, "group_name", "image_id")


def _standardized(r):
    """Each metric by its own finite values: an image that lacks one keeps the other four."""
    known = r.stats.select("image_id", "measured_at", *[F.when(finite(F.col(m)), F.col(m)).alias(m) for m in METRICS])
    return summary.standardized(known, METRICS).select("image_id", "measured_at", *[F.when(F.col(m).isNotNull(), F.col(f"z_{m}")).alias(f"z_{m}") for m in METRICS])


def _drawn(r):
    """As many draws as there are labelled images."""
    rows = r.master.where("image_id is not null and label is not null").select("image_id", "label").distinct()
    return summary.weighted_draw(rows, "image_id", "label", rows.count())


def _settings(spark):
    rows = [(s, part, part, both) for s, parts in SETTINGS.items() for part, both in parts.items()]
    return spark.createDataFrame(rows, "setting string, part string, split string, with_synthetic boolean")


def _parsed(r):
    p = derive.parse_file_name(F.col("source_filename"))
    return r.images.select(p.alias("p")).select("p.*").groupBy("reason", "cam", "state").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("sec").alias("last_sec"))


def _blocks(r):
    rows = r.real.withColumn("block", derive.block_index(F.col("sec"))).withColumn("made", derive.group_id(F.col("capture_id"), F.col("block")))
    return rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("made").alias("n_groups"), F.count_if(F.col("made") == F.col("group_id")).alias("n_as_filed"), F.min("made").alias("first_group"))


def _ids(r):
    made = F.lower(derive.real_image_id(F.col("cam"), F.col("state"), F.col("day"), F.col("sec")))
    return r.real.groupBy("state").agg(F.count_if(made == F.col("image_id")).alias("n_same"), F.count_if(made != F.col("image_id")).alias("n_other"), F.count_if(made.isNull()).alias("n_none"))


def _boosts(r):
    boost, label = derive.label_boost(F.col("avg_blockage")), derive.boosted_label(F.col("source_label"), F.col("avg_blockage"))
    return r.synthetic.groupBy(boost.alias("boost")).agg(F.count(F.lit(1)).alias("n"), F.count_if(boost == F.col("label_boost")).alias("n_as_filed"), F.count_if(label == F.col("label")).alias("n_label_as_filed"))


def _quota(spark, folder):
    """Largest-remainder seats: 3600 images over the splits, each split's over the labels, by the shares that the synthetic table has."""
    counts = table(spark, folder, "metadata_synthetic").where("label between 1 and 5 and synthetic_split in ('train', 'val', 'test')").groupBy("synthetic_split", "label").agg(F.count(F.lit(1)).alias("n"))
    totals = spark.createDataFrame(list(quotas.SPLIT_QUOTAS.items()), "synthetic_split string, total bigint")
    return quotas.largest_remainder(counts.join(F.broadcast(totals), "synthetic_split"), ["synthetic_split"], "label", "n", F.col("total")).select("synthetic_split", "label", "quota")


def _priority(spark, folder):
    m = table(spark, folder, "metadata_synthetic").where("label between 3 and 5 and source_label between 1 and 5 and synthetic_split in ('train', 'val', 'test')")
    mix = m.groupBy(F.col("synthetic_split").alias("split"), F.col("label").alias("target"), F.col("source_label").alias("source")).agg(F.count(F.lit(1)).alias("ratio"))
    return quotas.source_priority(mix).select("split", "target", "source", "priority", quotas.most_per_parent(F.col("split")).alias("most"))


def _paths(r):
    full = derive.absolute_path(r.real.columns, "/data/release")
    back = derive.relative_path(full, "/data/release/images")
    return r.real.groupBy(F.substring_index(back, "/", 2).alias("folder")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length(full)).alias("longest"))


def _fetched(r):
    """The first three images of each label in the order asked for, as a figure asks for them."""
    wanted = r.master.where("image_id is not null").groupBy("image_id").agg(F.min("label").alias("label"), F.min("origin").alias("origin"))
    asked = summary.seeded_sample(wanted.withColumn("l", F.col("label").cast("string")), "l", "image_id").select("image_id", "place")
    return asked.join(wanted, "image_id").select("label", "place", "image_id", "origin")


QUERIES = {
    "a01_label_counts": over_release(lambda r: r.master.agg(*comp.label_counts())),
    "a02_sparse_label_counts": over_release(lambda r: comp.sparse_counts(r.master, "label")),
    "a03_release_composition": over_release(lambda r: comp.release_composition(r.images)),
    "a04_split_composition": over_release(lambda r: comp.split_composition(r.images)),
    "a05_crosstab_cam": over_release(lambda r: comp.cross_tab(r.master, "cam")),
    "a05_crosstab_state": over_release(lambda r: comp.cross_tab(r.master, "state")),
    "a05_crosstab_day": over_release(lambda r: comp.cross_tab(r.master, "day")),
    "a05_crosstab_capture": over_release(lambda r: comp.cross_tab(r.master, "capture_id")),
    "a06_source_counts": over_release(lambda r: comp.sparse_counts(r.synthetic, "source_label")),
    "a06_source_target": over_release(lambda r: comp.sparse_counts(r.synthetic, "source_label", "label")),
    "a07_day_session": over_release(lambda r: comp.day_sessions(r.real, ["cambot24__morning", "cambot24__evening", "cambot25__morning", "cambot25__evening"])),
    "a09_parameter_summary": over_release(lambda r: summary.described(summary.long(r.synthetic, PARAMETERS), "field")),
    "a10_group_metric_summary": over_values(lambda r: summary.side_by_side(_all_values(r), "group_name", "real", "synthetic")),
    "a20_setting_manifest": lambda spark, folder: comp.setting_manifest(release.Release.load(spark, folder).images, _settings(spark)),
    "a22_standardize": over_release(_standardized),
    "a23_sampling_weights": over_release(lambda r: summary.sampling_weights(r.master, "label")),
    "a24_class_weights": over_release(lambda r: summary.class_weights(r.master, "label")),
    "a23_weighted_draw": over_release(_drawn),
    "a26_domains": over_release(lambda r: comp.domains(r.master, "cam", "state").select("n_images", F.array_join("cam_values", ",").alias("cams"), F.array_join("state_values", ",").alias("states"))),
    "f01_parse_filename": over_release(_parsed),
    "f02_group_id": over_release(_blocks),
    "f03_image_id": over_release(_ids),
    "f04_paths": over_release(_paths),
    "f05_label_boost": over_release(_boosts),
    "f07_quota": _quota,
    "f10_source_priority": _priority,
    "f12_attempt_seed": over_release(lambda r: r.synthetic.groupBy("generator_version").agg(F.min(derive.attempt_seed(F.col("synthetic_seed") % 1_000_000)).alias("least"), F.max(derive.attempt_seed(F.col("synthetic_seed") % 1_000_000)).alias("most"))),
    "o04_seeded_sample": over_release(lambda r: summary.seeded_sample(r.real.withColumn("l", F.col("label").cast("string")), "l", "image_id")),
    "o05_ecdf": over_values(lambda r: summary.ecdf(_all_values(r).where("field <> 'brightness_mean'").select("group_name", "field", "value"), "group_name", "field")),
    "o06_histogram": over_values(lambda r: summary.histogram(_all_values(r).where("group_name in ('real', 'synthetic')"), "group_name", "field")),
    "o03_head": over_release(lambda r: summary.head(r.real.where("image_id is not null").select("image_id", "ingest_ts", "label"), ["ingest_ts", "image_id", "label"], 2000)),
    "prj03_aligned": over_release(lambda r: release.aligned(r.synthetic.drop("width").withColumn("_note", F.lit("x")).withColumn("sec", F.concat(F.col("sec").cast("string"), F.lit(".0")))).groupBy("width", "sec").agg(F.count(F.lit(1)).alias("n"), F.count("asset_id").alias("n_assets"))),
    "prj05_severe": over_release(lambda r: r.images.where(F.col("label").isin(4, 5)).groupBy("origin", "label").agg(F.count(F.lit(1)).alias("n_images"))),
    "prj09_keyed_fetch": over_release(_fetched),
    "prj12_day_text": over_release(lambda r: r.real.groupBy(derive.day_text(F.col("day")).alias("day"), derive.session_text(F.col("cam_state")).alias("session")).agg(F.count(F.lit(1)).alias("n"))),
    "prj13_label_string": over_release(lambda r: comp.label_text(r.images, "split")),
    "w13_covariance": over_values(lambda r: summary.covariance(r.stats.where(_FINITE), METRICS)),
    "w18_median": over_values(lambda r: percentiles(_all_values(r), ["group_name", "field"], "value", {"median": 0.5, "p90": 0.9}).drop("n")),
}


def _cross(field: str) -> str:
    return VIEWS + f"""select *, label_1 + label_2 + label_3 + label_4 + label_5 as n_images from (
  select {field}, {LABELS_SQL} from master where {field} is not null and label is not null group by {field})"""


_LONG = """, long as (
  select * from (select group_name, image_id, unnest(['laplacian_var', 'tenengrad', 'rms_contrast', 'entropy', 'brightness_mean']) as field,
                 unnest([laplacian_var, tenengrad, rms_contrast, entropy, brightness_mean]) as value from stats) where isfinite(value))
"""
_Z = ", ".join(f"({m} - avg({m}) over ()) / greatest(stddev_pop({m}) over (), 1e-12) as z_{m}" for m in METRICS)
_NAME = derive.FILE_NAME_SQL
_FIELDS = ", ".join(f"'{p}'" for p in PARAMETERS)
_KNOWN = ", known as (select image_id, measured_at, " + ", ".join(f"case when isfinite({m}) then {m} end as {m}" for m in METRICS) + " from stats)"

SQL = {
    "a01_label_counts": VIEWS + f"select {LABELS_SQL} from master",
    "a02_sparse_label_counts": VIEWS + "select label, count(*) as n_images from master where label is not null group by label",
    "a03_release_composition": VIEWS + f"""
select coalesce(origin, 'combined') as subset, count(*) as n_images, {LABELS_SQL} from images where origin in ('real', 'synthetic') group by rollup (origin)""",
    "a04_split_composition": VIEWS + f"""
select split, count(*) as n_images, count(*) filter (origin = 'real') as n_real, count(*) filter (origin = 'synthetic') as n_synthetic,
       count(distinct capture_id) as n_captures, count(distinct group_id) as n_groups, {LABELS_SQL} from images group by split""",
    **{f"a05_crosstab_{n}": _cross(f) for n, f in (("cam", "cam"), ("state", "state"), ("day", "day"), ("capture", "capture_id"))},
    "a06_source_counts": VIEWS + "select source_label, count(*) as n_images from syn where source_label is not null group by 1",
    "a06_source_target": VIEWS + "select source_label, label, count(*) as n_images from syn where source_label is not null and label is not null group by all",
    "a07_day_session": VIEWS + "select day, " + ", ".join(f"count(*) filter (cam_state = '{c}') as {c}" for c in ("cambot24__morning", "cambot24__evening", "cambot25__morning", "cambot25__evening")) + " from real where day is not null and cam_state is not null group by day",
    "a09_parameter_summary": VIEWS + f"""
select field, count(*) as n, {r6("avg(value)")} as mean, {r6("stddev_pop(value)")} as std, {r6("min(value)")} as min, {r6("quantile_cont(value, 0.5)")} as median, {r6("max(value)")} as max
from (select unnest([{_FIELDS}]) as field, unnest([{", ".join(p + "::double" for p in PARAMETERS)}]) as value from syn) where isfinite(value) group by field""",
    "a10_group_metric_summary": VIEWS + _LONG + "select field, " + ", ".join(f"{r9(f'{f}(value) filter (group_name = {g!r})')} as {g}_{n}" for g in ("real", "synthetic") for n, f in (("mean", "avg"), ("std", "stddev_pop"))) + " from long where group_name in ('real', 'synthetic') group by field",
    "a20_setting_manifest": VIEWS + """, used as (
  select setting, split as part, origin from images, (values ('train_real_only__eval_real_only', []), ('train_real_plus_synthetic__eval_real_only', ['train']),
    ('train_real_only__eval_real_plus_synthetic', ['val', 'test']), ('train_real_plus_synthetic__eval_real_plus_synthetic', ['train', 'val', 'test'])) s(setting, mixed)
  where split in ('train', 'val', 'test') and (origin = 'real' or list_contains(mixed, split)))
select setting, part, count(*) as n_images, count(*) filter (origin = 'real') as n_real, count(*) filter (origin = 'synthetic') as n_synthetic from used group by all""",
    "a22_standardize": VIEWS + _KNOWN + f", z as (select image_id, measured_at, {_Z} from known) select image_id, measured_at, {', '.join(r6(f'z_{m}') + f' as z_{m}' for m in METRICS)} from z",
    "a23_sampling_weights": VIEWS + f"select label, count(*) as n, {r6('1.0 / count(*)')} as weight from master where label is not null group by label",
    "a23_weighted_draw": VIEWS + """, d as (select distinct image_id, label from master where image_id is not null and label is not null),
r as (select *, row_number() over (partition by label order by ('0x' || substr(md5('42|' || image_id), 1, 15))::bigint, image_id) as place from d),
s as (select label, count(*) as n, row_number() over (order by label) - 1 as k from d group by label),
w as (select draw, ('0x' || substr(md5('42|l|' || draw), 1, 15))::bigint % (select count(*) from s) as k, ('0x' || substr(md5('42|p|' || draw), 1, 15))::bigint as p
  from range((select count(*) from d)) t(draw))
select draw, image_id from w join s using (k) join r on r.label = s.label and r.place = p % n + 1""",
    "a24_class_weights": VIEWS + f"select label, count(*) as n, {r6('sum(count(*)) over () / (5.0 * count(*))')} as weight from master where label between 1 and 5 group by label",
    "a26_domains": VIEWS + "select count(*) as n_images, array_to_string(list_sort(list(distinct cam) filter (cam is not null)), ',') as cams, array_to_string(list_sort(list(distinct state) filter (state is not null)), ',') as states from master",
    "f01_parse_filename": VIEWS + f""", m as (
  select regexp_extract(source_filename, '{_NAME}', ['pre', 'c1', 'd1', 't1', 'c2', 'd2', 't2', 'sec', 'ext'], 'i') as g,
         regexp_matches(source_filename, '{_NAME}', 'i') as ok from images),
j as (select g, case when not coalesce(ok, false) then 'regex_no_match' when g.c1 <> g.c2 then 'camera_mismatch' when g.t1 <> g.t2 then 'timecode_mismatch'
  when g.pre <> g.d1 or g.d1 <> g.d2 then 'date_mismatch_prefix_capture' else 'ok' end as reason from m)
select reason, case when reason = 'ok' then g.c1 end as cam, case when reason = 'ok' then case when g.t1 = '090001' then 'morning' else 'evening' end end as state,
       count(*) as n, min(case when reason = 'ok' then g.d1 end) as first_day, max(case when reason <> 'regex_no_match' then try_cast(g.sec as bigint) end) as last_sec
from j group by 1, 2, 3""",
    "f02_group_id": VIEWS + """, b as (
  select *, case when sec < 0 then -1 else sec // 600 end as block, capture_id || '__blk' || printf('%03d', case when sec < 0 then -1 else sec // 600 end) as made from real)
select block::int as block, count(*) as n, count(distinct made) as n_groups, count(*) filter (made = group_id) as n_as_filed, min(made) as first_group from b group by block""",
    "f03_image_id": VIEWS + """, b as (select *, lower('R_' || cam || '_' || state || '_' || day || '_' || printf('%06d', sec)) as made from real)
select state, count(*) filter (made = image_id) as n_same, count(*) filter (made <> image_id) as n_other, count(*) filter (made is null) as n_none from b group by state""",
    "f04_paths": VIEWS + """, b as (select relative_path as p, case when relative_path like 'images/%' then substr(relative_path, 8) else '/data/release/' || relative_path end as back from real)
select array_to_string(string_split(back, '/')[1:2], '/') as folder, count(*) as n, max(length('/data/release/' || p))::int as longest from b group by 1""",
    "f05_label_boost": VIEWS + """, b as (
  select *, case when avg_blockage is null or isnan(avg_blockage) then null when avg_blockage < 0.02 then 0 when avg_blockage < 0.08 then 1
    when avg_blockage < 0.15 then 2 when avg_blockage < 0.25 then 3 else 4 end as boost from syn)
select boost, count(*) as n, count(*) filter (boost = label_boost) as n_as_filed, count(*) filter (source_label + boost is not null and least(5, source_label + boost) = label) as n_label_as_filed from b group by boost""",
    "f07_quota": VIEWS + """, c as (
  select synthetic_split, label, count(*) as n, case synthetic_split when 'train' then 2800 else 400 end as total
  from syn where label between 1 and 5 and synthetic_split in ('train', 'val', 'test') group by all),
x as (select *, round(total * (n / sum(n) over (partition by synthetic_split))::double, 9) as exact from c),
y as (select *, total - sum(floor(exact)) over (partition by synthetic_split) as left_over,
      row_number() over (partition by synthetic_split order by exact - floor(exact) desc, label::varchar) as place from x)
select synthetic_split, label, (floor(exact) + (place <= left_over)::int)::bigint as quota from y""",
    "f10_source_priority": VIEWS + """, c as (
  select synthetic_split as split, label as target, source_label as source, count(*) as ratio from syn
  where label between 3 and 5 and source_label between 1 and 5 and synthetic_split in ('train', 'val', 'test') group by all)
select split, target, source, row_number() over (partition by split, target order by ratio desc, source)::int as priority, case split when 'train' then 2 else 1 end as most
from c where split = 'train' or target <> 5 or source = 3""",
    "f12_attempt_seed": VIEWS + "select generator_version, min(42000000 + synthetic_seed % 1000000) as least, max(42000000 + synthetic_seed % 1000000) as most from syn group by 1",
    "o04_seeded_sample": VIEWS + """, d as (select distinct label::varchar as l, image_id from real where label is not null and image_id is not null),
p as (select *, row_number() over (partition by l order by md5('42' || image_id), image_id)::int as place from d) select * from p where place <= 3""",
    "o05_ecdf": VIEWS + _LONG + f""", e as (
  select group_name, field, value, row_number() over (partition by group_name, field order by value) / count(*) over (partition by group_name, field) as y from long where field <> 'brightness_mean')
select group_name, field, {r9('value')} as value, {r9('y')} as y from e""",
    "o06_histogram": VIEWS + _LONG + f""", s as (
  select group_name, field, value, min(value) over w as lo, max(value) over w as hi, count(*) over w as n from long where group_name in ('real', 'synthetic') window w as (partition by group_name, field))
select group_name, field, least(floor((value - lo) / (hi - lo) * 40), 39)::int as bin, count(*) as n, {r9("(count(*) / (max(s.n) * max(hi - lo) / 40))")} as density from s group by 1, 2, 3""",
    "o03_head": VIEWS + "select image_id, ingest_ts, label from real where image_id is not null order by ingest_ts, image_id, label nulls first limit 2000",
    "prj03_aligned": VIEWS + "select null::int as width, sec, count(*) as n, count(asset_id) as n_assets from syn group by sec",
    "prj05_severe": VIEWS + "select origin, label, count(*) as n_images from images where label in (4, 5) group by all",
    "prj09_keyed_fetch": VIEWS + """, w as (select image_id, min(label) as label, min(origin) as origin from master where image_id is not null group by 1),
p as (select *, row_number() over (partition by label order by md5('42' || image_id), image_id)::int as place from w where label is not null)
select label, place, image_id, origin from p where place <= 3""",
    "prj12_day_text": VIEWS + "select strftime(try_strptime(day, '%Y%m%d'), '%b %d') as day, replace(cam_state, '__', ' ') as session, count(*) as n from real group by 1, 2",
    "prj13_label_string": VIEWS + "select split, concat_ws(' | ', " + ", ".join(f"'L{k}:' || count(*) filter (label = {k})" for k in range(1, 6)) + ") as labels from images group by split",
    "w13_covariance": VIEWS + f", z as (select {_Z} from stats where {' and '.join(f'isfinite({m})' for m in METRICS)})" + " union all ".join(f" select '{a}' as row, '{b}' as col, {r9(f'covar_samp(z_{a}, z_{b})')} as cov from z" for i, a in enumerate(METRICS) for b in METRICS[i:]),
    "w18_median": VIEWS + _LONG + f"select group_name, field, {r9('quantile_cont(value, 0.5)')} as median, {r9('quantile_cont(value, 0.9)')} as p90 from long group by all",
}
