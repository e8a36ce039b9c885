"""SQL that must give the rows of the queries."""

from __future__ import annotations

import math

from tidemark.functions.keys import key_sql
from tidemark.llm.percentiles import ERROR, QUANTILES, _log_gamma
from tidemark.llm.sampling import SEED
from tidemark.llm.visual import form_sql

_FORMS = f"with f as (select doc_id, text, {form_sql('text')} as form from documents where text is not null)"

_LG = repr(_log_gamma(ERROR))
_VALUES = """
with v as (
  select group_name, label, cast(measured_at as date) as day, unnest(['laplacian_var', 'tenengrad', 'rms_contrast', 'entropy']) as metric,
         unnest([laplacian_var, tenengrad, rms_contrast, entropy]) as x
  from synthetic_real_severe_low_level_stats),
b as (
  select group_name, label, day, metric, sign(x)::int as sign, case when x = 0 then 0 else ceil(ln(abs(x)) / LG)::int end as bucket
  from v where isfinite(x))
""".replace("LG", _LG)


def _percentiles(by: str, quantiles: tuple[float, ...]) -> str:
    size = f"exp(bucket * {_LG}) * {2 / (math.exp(_log_gamma(ERROR)) + 1)!r}"
    return f"""{_VALUES}, s as (select {by}, metric, sign, bucket, count(*) as n from b group by all),
c as (
  select *, sum(n) over (partition by {by}, metric order by sign, sign * bucket rows unbounded preceding) as upto,
         sum(n) over (partition by {by}, metric) as total
  from s)
select {by}, metric, q, total::bigint as n, printf('%.8e', case when sign = 0 then 0.0::double else sign * {size} end)::double as estimate
from c, (select unnest([{", ".join(f"{q!r}::double" for q in quantiles)}]) as q) where floor(q * (total - 1)) < upto and floor(q * (total - 1)) >= upto - n"""


_ELIGIBLE = f"""
with e as (
  select distinct {key_sql("image_id")} as id, label, source_label from metadata_synthetic
  where {key_sql("image_id")} is not null and label between 1 and 5 and source_label between 1 and 5),
a as (select label, source_label, count(*) as available from e group by all),
n as (select count(distinct id) as n from e)
"""

_STATS = f"""
with recursive r as (
  select distinct {key_sql("image_id")} as i, laplacian_var as a, tenengrad as b, rms_contrast as c, brightness_mean as d
  from synthetic_real_severe_low_level_stats
  where {key_sql("image_id")} is not null and isfinite(laplacian_var) and isfinite(tenengrad) and isfinite(rms_contrast) and isfinite(brightness_mean)),
e as (
  select distinct x.i as x, y.i as y from r x join r y on x.i <> y.i
  and {" and ".join(f"abs(x.{m} - y.{m}) <= 0.01::double * greatest(abs(x.{m}), abs(y.{m}))" for m in "abcd")}),
reach(i, j) as (select distinct i, i from r union select reach.i, e.y from reach join e on reach.j = e.x)
"""

_TIES = f"""
with recursive r as (
  select row_number() over () as n, {key_sql("image_id")} as i, {key_sql("capture_id")} as c, {key_sql("group_id")} as g, {key_sql("parent_image_id")} as p
  from metadata),
t as (
  select n, 'i:' || i as k from r where i is not null union select n, 'i:' || p from r where p is not null
  union select n, 'c:' || c from r where c is not null union select n, 'g:' || g from r where g is not null),
e as (select distinct x.k as x, y.k as y from t x join t y using (n) where x.k <> y.k),
reach(a, b) as (select distinct k, k from t where k like 'c:%' union select reach.a, e.y from reach join e on reach.b = e.x)
"""

_DRAWN = _ELIGIBLE + f""",
t as (
  select request_id, label, source_label, sum(target_share) as target_share, max(min_rows) as min_rows, max(sample_share) as sample_share from sampling_targets group by all),
w as (
  select t.*, coalesce(available, 0) as available, n.n as n_eligible,
         greatest(coalesce(min_rows, 0)::double, coalesce(target_share, 0) * coalesce(sample_share, 0) * n.n) as needed
  from t left join a using (label, source_label), n),
m as (
  select request_id, id, label, source_label, target_share, min_rows, sample_share, n_eligible,
         row_number() over (partition by request_id, id order by needed / available desc, label, source_label) as pick
  from e join w using (label, source_label)),
ranked as (
  select *, row_number() over (partition by request_id, label, source_label order by ('0x' || substr(md5('{SEED}|' || id), 1, 15))::bigint, id) as rank
  from m where pick = 1),
told as (
  select request_id, id, label, source_label, (rank - 0.5::double) / target_share as priority, rank <= coalesce(min_rows, 0) as floored, n_eligible,
         row_number() over (partition by request_id order by rank > coalesce(min_rows, 0), (rank - 0.5::double) / target_share, label, source_label) as place,
         max(sample_share) over (partition by request_id) as sample_share
  from ranked),
kept as (select request_id, id as image_id, label, source_label, priority from told where floored or place <= floor(sample_share * n_eligible))
"""

SQL = {
    "p4_found": _STATS + """
select i as image_id, min(j) as cluster_key from reach group by i having count(*) >= 8""",
    "p4_cover": _STATS + """
select count(*) as n_records, count(*) as n_placed, 0::bigint as n_beyond from r""",
    "p5_found": _TIES + """
select substr(a, 3) as capture_a, substr(b, 3) as capture_b from reach where a < b and b like 'c:%'""",
    "p5_captures": _TIES + """
select substr(a, 3) as capture_id, substr(min(b), 3) as class_id, count(*) as n_captures from reach where b like 'c:%' group by a having count(*) > 1""",
    "p5_apart": f"select count(distinct {key_sql('image_id')}) as n_images, 0::bigint as images_apart, 0::bigint as captures_apart, 0::bigint as groups_apart from metadata",
    "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p7_bounds": "select mix_id, source, 0::bigint as n_over from mix_targets",
    "p2_sample": _DRAWN + """
select request_id, image_id, label, source_label, priority from kept""",
    "p2_report": _DRAWN + """,
seated as (select request_id, label, source_label, count(*) as seats from kept group by all),
reach as (select request_id, label, source_label, count(*) as drawable from ranked group by all)
select request_id, label, source_label, target_share, min_rows, sample_share, available, coalesce(drawable, 0) as drawable, n_eligible, needed, coalesce(seats, 0) as seats,
       available >= needed as filled, coalesce(seats, 0) >= greatest(coalesce(min_rows, 0), floor(coalesce(target_share, 0) * coalesce(sample_share, 0) * n_eligible)) as reached,
       greatest(greatest(coalesce(min_rows, 0), floor(coalesce(target_share, 0) * coalesce(sample_share, 0) * n_eligible)) - coalesce(seats, 0), 0)::bigint as shortfall
from w left join seated using (request_id, label, source_label) left join reach using (request_id, label, source_label)""",
    "p1_daily_sketch": _VALUES + "select group_name, label, day, metric, sign, bucket, count(*) as n from b group by all",
    "p1_percentiles": _percentiles("group_name, label", QUANTILES),
    "p1_daily_percentiles": _percentiles("group_name, label, day", (0.5, 0.9)),
    "p2_found": _ELIGIBLE + """
select request_id, label, source_label from sampling_targets left join a using (label, source_label), n
where coalesce(available, 0) < greatest(min_rows::double, target_share * sample_share * n)""",
    "p8_found": _FORMS + """
select distinct a.doc_id as doc_a, b.doc_id as doc_b
from f a join f b on a.form = b.form and a.text <> b.text and a.doc_id < b.doc_id where a.form <> ''""",
    "p8_classes": _FORMS + """
select doc_id, min(doc_id) over w as class_id, count(*) over w as n_docs, n_texts
from f join (select form, count(distinct text) as n_texts from f group by form) using (form) where form <> '' window w as (partition by form)""",
}
