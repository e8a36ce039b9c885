"""Agreement, classification, roll-ups, distributions and kernels: W.., A15-A19, J13, J14, O02, O09, I.., G06 of the survey."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import agreement, classification, compositing, distribution, kernels, losses, rollup, summary
from tidemark.plans.views import VIEWS, annotations, comparable, over_release, over_values, predictions, r6, r9, run_classes, run_results
from tidemark.sources.tables import table
from tidemark.sources.workspace import ship

METRICS = ["laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"]
_FINITE = " and ".join(f"isnotnull({m}) and not isnan({m}) and abs({m}) < double('infinity')" for m in METRICS)
ORDER = {s: i for i, s in enumerate((rollup.PAIRS[0][0], rollup.PAIRS[0][1], rollup.PAIRS[1][0], rollup.PAIRS[1][1]))}


def _votes(make):
    return lambda spark, folder: comparable(make(annotations(spark, folder)))


def _scored(make):
    def run(spark, folder):
        p = predictions(spark, folder)
        return comparable(make(p))

    return run


def _cells(make):
    return _scored(lambda p: make(classification.cells(p, "generator_version")))


def _rolled(make):
    return lambda spark, folder: comparable(make(rollup.by_setting(run_results(spark, folder))))


def _binary_runs(spark, folder):
    runs = run_results(spark, folder).select("model", "setting", F.col("accuracy").alias("precision"), F.col("macro_f1").alias("recall"), F.col("weighted_kappa").alias("f1"), F.col("mae").alias("auroc"), F.when(F.col("seed") != 1, F.col("within1")).otherwise(F.lit(float("nan"))).alias("auprc"))
    return comparable(rollup.by_binary(runs))


def _log(spark, folder):
    """A training log made of the events: a user is a run, the event id its epoch, the value the metric."""
    e = table(spark, folder, "events")
    return e.select(F.col("user_id").alias("run"), F.col("event_id").alias("epoch"), F.round("value", 3).alias("metric"))


def _logits(spark, folder):
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double") * 10).alias("logits"))


def _judged(spark, folder, n):
    """Logits made of the embeddings, with a class from their label."""
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", F.transform(F.slice("embedding", 1, n), lambda x: x.cast("double") * 10).alias("logits"), (F.col("label") % 5).cast("int").alias("index"), (F.col("vec_id") % 3).alias("fold"))


def _weighed(spark, folder):
    """Cross-entropy with balanced class weights."""
    rows = _judged(spark, folder, 5)
    weights = summary.class_weights(rows.withColumn("class", F.col("index") + 1), "class").select((F.col("class") - 1).alias("index"), "weight")
    return comparable(losses.cross_entropy(rows.join(weights, "index"), "fold", weight="weight"))


def _decoded(label, probabilities):
    def run(spark, folder):
        rows = _logits(spark, folder)
        p = probabilities(F.col("logits"))
        return comparable(rows.select("vec_id", label(F.col("logits")).alias("label"), *[F.element_at(p, k).alias(f"p{k}") for k in range(1, 6)]))

    return run


def _softmax(spark, folder):
    rows = _logits(spark, folder)
    p = classification.softmax(F.col("logits"))
    return comparable(rows.select("vec_id", classification.argmax(F.col("logits")).alias("label"), *[F.element_at(p, k).alias(f"p{k}") for k in range(1, 5)]))


def pixels(spark, folder):
    """8 x 8 grey images made of the embeddings."""
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1.0) * 127)))).cast("array<int>").alias("px"))


def _kernel(*names):
    def run(spark, folder):
        ship(spark)
        s = pixels(spark, folder).select("vec_id", kernels.low_level_stats("px", F.lit(8), F.lit(8)).alias("s"))
        return comparable(s.select("vec_id", *[f"s.{n}" for n in names]))

    return run


def _mean_confusion(spark, folder):
    p = predictions(spark, folder)
    shares = classification.confusion(classification.cells(p, "generator_version", "severe"), "generator_version", "severe")
    return comparable(rollup.mean_confusion(shares.withColumnRenamed("generator_version", "model")))


def _pca(which):
    return over_release(lambda r: distribution.components(r.stats.where(_FINITE).select("image_id", "measured_at", *METRICS), METRICS)[which])


def _grid(spark, folder):
    r = run_results(spark, folder)
    one = lambda c: r.select(c).distinct()
    heads = spark.createDataFrame([("nominal",), ("coral",), ("corn",)], "head string")
    return rollup.run_grid(one("model"), heads, one("seed"), one("setting"))


def _normalized(spark, folder):
    px = pixels(spark, folder).select("vec_id", F.posexplode("px").alias("i", "v"))
    return comparable(px.groupBy("vec_id", (F.col("i") % 3).alias("channel")).agg(F.avg(kernels.normalized(F.col("v"), F.col("i") % 3)).alias("mean")))


def _blend(spark, folder):
    e = table(spark, folder, "embeddings")
    alpha = F.transform("embedding", lambda x: F.least(F.lit(1.0), F.abs(x.cast("double")) * 2))
    px = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1.0) * 127).cast("int"))
    out = compositing.blended(px, F.transform(px, lambda v: 255 - v), alpha, F.lit(0.5))
    return e.select("vec_id", F.aggregate(out, F.lit(0).cast("bigint"), lambda s, v: s + v).alias("total"), F.array_max(out).alias("most"), F.array_min(out).alias("least"))


QUERIES = {
    "o09_first_vote": _votes(lambda v: agreement.first_votes(v, "pos")),
    "j13_pairwise_annotators": _votes(lambda v: agreement.pair_counts(agreement.first_votes(v, "pos"))),
    "w01_kappa": _votes(lambda v: agreement.pairwise_agreement(v, "pos").select("annotator_a", "annotator_b", "n_images", "cohen_kappa")),
    "w02_quadratic_kappa": _votes(lambda v: agreement.pairwise_agreement(v, "pos").select("annotator_a", "annotator_b", "quadratic_weighted_kappa")),
    "w03_raw_agreement": _votes(lambda v: agreement.pairwise_agreement(v, "pos").select("annotator_a", "annotator_b", "raw_agreement")),
    "w04_confusion": _votes(lambda v: agreement.first_pair_confusion(v, "pos")),
    "a15_vote_rollup": _votes(agreement.vote_rollup),
    "a16_agreement_summary": _votes(lambda v: agreement.agreement_summary(v, "pos")),
    "w05_accuracy_mae": _cells(lambda c: classification.scalars(c, "generator_version")),
    "w07_prf": _cells(lambda c: classification.per_class(c, "generator_version")),
    "w08_macro_f1": _cells(lambda c: classification.macro_f1(c, "generator_version")),
    "w09_confusion_norm": _cells(lambda c: classification.confusion(c, "generator_version")),
    "w10_binary_prf": _cells(lambda c: classification.binary(c, "generator_version")),
    "w11_auroc": _scored(lambda p: classification.auroc(p, "generator_version", truth="severe", score="score")),
    "w12_average_precision": _scored(lambda p: classification.average_precision(p, "generator_version", truth="severe", score="score")),
    "evaluation": _scored(lambda p: classification.evaluation(p, "generator_version").select("generator_version", "accuracy", "mae", "within1", "macro_f1", "weighted_kappa")),
    "w06_wasserstein": over_values(lambda r: distribution.wasserstein(summary.long(r.stats, METRICS, "group_name"), "field", group="group_name", left="real", right="synthetic")),
    "w13_pca_loadings": _pca(0),
    "w13_pca_scores": _pca(1),
    "w14_coral_decode": _decoded(classification.coral_label, classification.coral_probabilities),
    "w15_corn_decode": _decoded(classification.corn_label, classification.corn_probabilities),
    "w16_softmax_argmax": _softmax,
    "w17_mean_confusion": _mean_confusion,
    "a17_run_rollup": _rolled(lambda r: r),
    "a18_per_class_rollup": lambda spark, folder: comparable(rollup.by_class(run_classes(spark, folder))),
    "a19_binary_rollup": _binary_runs,
    "j14_setting_delta": _rolled(rollup.setting_deltas),
    "o02_best_setting": _rolled(lambda r: rollup.best_settings(r, ORDER).select("model", "setting", "macro_f1_mean")),
    "j23_runs_of_best": lambda spark, folder: comparable(rollup.runs_of_best(run_results(spark, folder), rollup.best_settings(rollup.by_setting(run_results(spark, folder)), ORDER))),
    "g06_best_epoch": lambda spark, folder: comparable(rollup.best_epochs(_log(spark, folder))),
    "g06_early_stop": lambda spark, folder: rollup.stopped_epochs(_log(spark, folder), 7),
    "g06_learning_rate": lambda spark, folder: rollup.learning_rates(_log(spark, folder)).select("run", "n_cuts", (F.col("lr") * 1e4).alias("share")),
    "g08_coral_loss": lambda spark, folder: comparable(losses.coral_loss(_judged(spark, folder, 4), "fold")),
    "g08_corn_loss": lambda spark, folder: comparable(losses.corn_loss(_judged(spark, folder, 4), "fold")),
    "g08_cross_entropy": _weighed,
    "g07_run_grid": _grid,
    "i01_entropy": _kernel("entropy"),
    "i02_laplacian_var": _kernel("laplacian_var"),
    "i03_tenengrad": _kernel("tenengrad"),
    "i04_rms": _kernel("rms_contrast"),
    "i05_brightness": _kernel("brightness_mean"),
    "i06_stat_bundle": _kernel("laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"),
    "i07_stat_tasks": over_release(lambda r: r.images.where(F.col("label").isin(4, 5) & F.col("image_id").isNotNull()).select(F.col("origin").alias("group_name"), "image_id", "label").distinct()),
    "i12_blend": _blend,
    "i14_normalize": _normalized,
}

_PAIRS = VIEWS + """, p as (
  select a.annotator as annotator_a, b.annotator as annotator_b, a.label as x, b.label as y from first_vote a join first_vote b using (image_id) where a.annotator < b.annotator),
cls as (select annotator_a, annotator_b, c, dense_rank() over (partition by annotator_a, annotator_b order by c) as k from (select annotator_a, annotator_b, x as c from p union select annotator_a, annotator_b, y from p)),
q as (select p.*, i.k as i, j.k as j from p join cls i on i.annotator_a = p.annotator_a and i.annotator_b = p.annotator_b and i.c = p.x join cls j on j.annotator_a = p.annotator_a and j.annotator_b = p.annotator_b and j.c = p.y),
ex as (select a.annotator_a, a.annotator_b, sum((a.i <> b.j)::int)::double / count(*) as e1, sum((a.i - b.j) ** 2)::double / count(*) as e2 from q a join q b using (annotator_a, annotator_b) group by all),
k as (
  select annotator_a, annotator_b, count(*) as n_images, coalesce(1 - avg((i <> j)::int) / nullif(any_value(e1), 0), 'nan') as cohen_kappa,
         coalesce(1 - avg((i - j) ** 2) / nullif(any_value(e2), 0), 'nan') as quadratic_weighted_kappa, avg((i = j)::int) as raw_agreement
  from q join ex using (annotator_a, annotator_b) group by all)
"""
_ROLL = """, rolled as (
  select model, setting, count(*) as n_seeds, """ + ", ".join(f"{f}({m}) as {m}_{n}" for m in rollup.METRICS for n, f in (("mean", "avg"), ("std", "stddev_pop"))) + """,
         (setting like '%eval_real_only')::int as is_primary from results group by model, setting),
best as (select * from (select *, row_number() over (partition by model order by macro_f1_mean desc, case setting when 'train_real_only__eval_real_only' then 0 else 1 end) as rn from rolled where is_primary = 1) where rn = 1)
"""
_CONF = ", c as (select generator_version, target_label as x, pred_label as y, count(*) as n from pred group by all)"
_D = ", dom as (select unnest([1, 2, 3, 4, 5]) as label)"
_CLASSES = _CONF + _D + """, s as (
  select generator_version, label, sum(n) filter (x = label and y = label) as tp, sum(n) filter (x = label) as t, sum(n) filter (y = label) as p from c, dom group by all),
f as (select generator_version, label, coalesce(tp::double / nullif(p, 0), 0) as precision, coalesce(tp::double / nullif(t, 0), 0) as recall,
  coalesce(2.0::double * tp / nullif(coalesce(p, 0) + coalesce(t, 0), 0), 0) as f1, coalesce(t, 0)::bigint as support, coalesce(p, 0) + coalesce(t, 0) as present from s)
"""
_LOGITS = "with l as (select vec_id, [x::double * 10 for x in embedding[1:4]] as z from embeddings), s as (select vec_id, z, [1 / (1 + exp(-x)) for x in z] as v from l)"

def _near(dr: int, dc: int) -> str:
    row = {0: "a.r", -1: "abs(a.r - 1)", 1: "7 - abs(6 - a.r)"}[dr]
    col = {0: "a.c", -1: "abs(a.c - 1)", 1: "7 - abs(6 - a.c)"}[dc]
    return f"w[({row}) * 8 + ({col}) + 1]"


_W = """
with e as (select vec_id, [greatest(0, least(255, floor((x::double + 1.0) * 127)))::int for x in embedding] as w from embeddings),
a as (select vec_id, w, (k // 8)::int as r, (k % 8)::int as c, w[k + 1] as v from e, range(64) t(k)),
m as (select vec_id, v, """ + ", ".join([
    f"{_near(-1, 0)} + {_near(1, 0)} + {_near(0, -1)} + {_near(0, 1)} - 4 * v as lap",
    f"({_near(-1, 1)} + 2 * {_near(0, 1)} + {_near(1, 1)}) - ({_near(-1, -1)} + 2 * {_near(0, -1)} + {_near(1, -1)}) as gx",
    f"({_near(1, -1)} + 2 * {_near(1, 0)} + {_near(1, 1)}) - ({_near(-1, -1)} + 2 * {_near(-1, 0)} + {_near(-1, 1)}) as gy",
]) + """ from a),
h as (select vec_id, abs(-sum(n / 64.0 * log2(n / 64.0))) as entropy from (select vec_id, v, count(*)::double as n from m group by all) group by vec_id),
k as (select vec_id, var_pop(lap) as laplacian_var, avg(gx * gx + gy * gy) as tenengrad, stddev_pop(v) as rms_contrast, avg(v) as brightness_mean from m group by vec_id)
"""


def _kernel_sql(*names: str) -> str:
    return _W + f"select vec_id, {', '.join(f'{r6(n)} as {n}' for n in names)} from k join h using (vec_id)"


_LONG = """, long as (
  select * from (select group_name, unnest(['laplacian_var', 'tenengrad', 'rms_contrast', 'entropy', 'brightness_mean']) as field,
                 unnest([laplacian_var, tenengrad, rms_contrast, entropy, brightness_mean]) as value from stats) where isfinite(value))
"""

_JUDGED = """with j as (select vec_id, vec_id % 3 as fold, (label % 5)::int as index, embedding from embeddings),
q as (select vec_id, fold, index, unnest(embedding[1:5])::double * 10 as z, generate_subscripts(embedding[1:5], 1) - 1 as k from j)
"""

SQL = {
    "o09_first_vote": VIEWS + "select * from first_vote",
    "j13_pairwise_annotators": VIEWS + "select a.annotator as annotator_a, b.annotator as annotator_b, a.label as x, b.label as y, count(*) as n from first_vote a join first_vote b using (image_id) where a.annotator < b.annotator group by all",
    "w01_kappa": _PAIRS + f"select annotator_a, annotator_b, n_images, {r6('cohen_kappa')} as cohen_kappa from k",
    "w02_quadratic_kappa": _PAIRS + f"select annotator_a, annotator_b, {r6('quadratic_weighted_kappa')} as quadratic_weighted_kappa from k",
    "w03_raw_agreement": _PAIRS + f"select annotator_a, annotator_b, {r6('raw_agreement')} as raw_agreement from k",
    "w04_confusion": VIEWS + """, two as (select list_sort(list(distinct annotator))[1:2] as t from first_vote),
p as (select t[1] as annotator_a, t[2] as annotator_b, a.label as x, b.label as y from two, first_vote a join first_vote b using (image_id) where a.annotator = t[1] and b.annotator = t[2]),
dom as (select distinct annotator_a, annotator_b, i as x, j as y from p, range(1, 6) r(i), range(1, 6) s(j))
select annotator_a, annotator_b, d.x::int as x, d.y::int as y, count(p.x) as n from dom d left join p using (annotator_a, annotator_b, x, y) group by all""",
    "a15_vote_rollup": VIEWS + """
select image_id, count(label) as n_votes, count(distinct label) as n_unique_labels, min(label) as min_label, max(label) as max_label, max(label) - min(label) as disagreement_span,
       (count(distinct label) > 1)::int as needs_adjudication from ann where image_id is not null group by image_id""",
    "a16_agreement_summary": _PAIRS + f""", im as (select image_id, count(distinct label) as u, max(label) - min(label) as span from ann where image_id is not null group by 1)
select (select count(distinct annotator) from ann) as n_annotators, (select count(distinct image_id) from ann) as n_images,
       {r6("(select avg(cohen_kappa) from k)")} as mean_cohen_kappa, {r6("(select avg(quadratic_weighted_kappa) from k)")} as mean_quadratic_weighted_kappa,
       {r6("(select avg(raw_agreement) from k)")} as mean_raw_agreement, {r6("(select avg((u > 1)::int) from im)")} as adjudication_rate,
       (select count(*) from im where span > 1) as images_with_span_gt_1""",
    "w05_accuracy_mae": VIEWS + f"""select generator_version, count(*) as n, {r6("avg((target_label = pred_label)::int)")} as accuracy, {r6("avg(abs(target_label - pred_label))")} as mae,
       {r6("avg((abs(target_label - pred_label) <= 1)::int)")} as within1 from pred group by 1""",
    "w07_prf": VIEWS + _CLASSES + f"select generator_version, label, {r6('precision')} as precision, {r6('recall')} as recall, {r6('f1')} as f1, support from f",
    "w08_macro_f1": VIEWS + _CLASSES + f"select generator_version, {r6('avg(f1) filter (present > 0)')} as macro_f1 from f group by 1",
    "w09_confusion_norm": VIEWS + _CONF + _D + f""", g as (select v.generator_version, a.label as x, b.label as y from (select distinct generator_version from c) v, dom a, dom b)
select generator_version, x, y, coalesce(n, 0) as n, {r6("coalesce(n::double / nullif(sum(n) over (partition by generator_version, x), 0), 0)")} as share from g left join c using (generator_version, x, y)""",
    "w10_binary_prf": VIEWS + f""", b as (select generator_version, count(*) filter (target_label >= 4 and pred_label >= 4) as tp, count(*) filter (target_label >= 4) as t, count(*) filter (pred_label >= 4) as p from pred group by 1)
select generator_version, {r6("coalesce(tp::double / nullif(p, 0), 0)")} as precision, {r6("coalesce(tp::double / nullif(t, 0), 0)")} as recall, {r6("coalesce(2.0::double * tp / nullif(p + t, 0), 0)")} as f1 from b""",
    "w11_auroc": VIEWS + f""", k as (select generator_version, severe, rank() over w + (count(*) over (partition by generator_version, score) - 1) / 2.0::double as r
  from pred where score is not null and not isnan(score) window w as (partition by generator_version order by score)),
s as (select generator_version, sum(r) filter (severe = 1) as rs, count(*) filter (severe = 1) as p, count(*) filter (severe = 0) as n from k group by 1)
select generator_version, {r6("(rs - p * (p + 1) / 2.0::double) / nullif((p * n)::double, 0)")} as auroc from s""",
    "w12_average_precision": VIEWS + f""", t as (select generator_version, score, sum(severe) as pos, count(*) as n from pred where score is not null and not isnan(score) group by all),
u as (select *, sum(pos) over w as tp, sum(n) over w as seen, sum(pos) over (partition by generator_version) as p from t window w as (partition by generator_version order by score desc))
select generator_version, {r6("sum(pos::double / p * tp / seen)")} as average_precision from u group by 1""",
    "evaluation": VIEWS + _CLASSES + f""", cl as (select generator_version, c, dense_rank() over (partition by generator_version order by c) as k from (select generator_version, target_label as c from pred union select generator_version, pred_label from pred)),
q as (select pred.generator_version, i.k as i, j.k as j from pred join cl i on i.generator_version = pred.generator_version and i.c = target_label join cl j on j.generator_version = pred.generator_version and j.c = pred_label),
mi as (select generator_version, i, count(*)::double as n from q group by all), mj as (select generator_version, j, count(*)::double as n from q group by all),
ex as (select generator_version, sum(mi.n * mj.n * (i - j) ** 2) as e from mi join mj using (generator_version) group by 1),
ob as (select generator_version, sum((i - j) ** 2)::double as o, count(*) as t from q group by 1),
sc as (select generator_version, avg((target_label = pred_label)::int) as accuracy, avg(abs(target_label - pred_label)) as mae, avg((abs(target_label - pred_label) <= 1)::int) as within1 from pred group by 1),
mf as (select generator_version, avg(f1) filter (present > 0) as macro_f1 from f group by 1)
select generator_version, {r6("accuracy")} as accuracy, {r6("mae")} as mae, {r6("within1")} as within1, {r6("macro_f1")} as macro_f1, {r6("1 - o / (e / t)")} as weighted_kappa
from sc join mf using (generator_version) join ex using (generator_version) join ob using (generator_version)""",
    "w06_wasserstein": VIEWS + _LONG + f""", c as (select field, value, count(*) filter (group_name = 'real') as a, count(*) filter (group_name = 'synthetic') as b from long where group_name in ('real', 'synthetic') group by all),
d as (select field, lead(value) over w - value as dx, sum(a) over w as ca, sum(b) over w as cb, sum(a) over (partition by field) as ta, sum(b) over (partition by field) as tb from c window w as (partition by field order by value))
select field, {r9("sum(abs(ca::double / ta - cb::double / tb) * dx)")} as distance from d group by field""",
    "w14_coral_decode": _LOGITS + """, d as (select vec_id, len([x for x in v if x > 0.5])::int as label,
  [greatest(0.0::double, 1 - v[1]), greatest(0.0::double, v[1] - v[2]), greatest(0.0::double, v[2] - v[3]), greatest(0.0::double, v[3] - v[4]), v[4]] as p from s)
select vec_id, label, """ + ", ".join(f"{r6(f'p[{k}] / greatest(list_sum(p), 1e-12)')} as p{k}" for k in range(1, 6)) + " from d",
    "w15_corn_decode": _LOGITS + """, c as (select vec_id, [v[1], v[1] * v[2], v[1] * v[2] * v[3], v[1] * v[2] * v[3] * v[4]] as q from s)
select vec_id, len([x for x in q if x > 0.5])::int as label, """ + f"{r6('1 - q[1]')} as p1, {r6('q[1] - q[2]')} as p2, {r6('q[2] - q[3]')} as p3, {r6('q[3] - q[4]')} as p4, {r6('q[4]')} as p5 from c",
    "w16_softmax_argmax": _LOGITS + """, m as (select vec_id, z, list_position(z, list_max(z)) - 1 as label, list_sum([exp(x - list_max(z)) for x in z]) as t from l)
select vec_id, label::int as label, """ + ", ".join(f"{r6(f'exp(z[{k}] - list_max(z)) / t')} as p{k}" for k in range(1, 5)) + " from m",
    "w17_mean_confusion": VIEWS + f""", c as (select generator_version, severe, target_label as x, pred_label as y, count(*) as n from pred group by all),
g as (select generator_version, severe, i::int as x, j::int as y from (select distinct generator_version, severe from c), range(1, 6) a(i), range(1, 6) b(j)),
s as (select generator_version, x, y, coalesce(n::double / nullif(sum(n) over (partition by generator_version, severe, x), 0), 0) as share from g left join c using (generator_version, severe, x, y))
select generator_version as model, x, y, {r6("avg(share)")} as share from s group by all""",
    "a17_run_rollup": VIEWS + _ROLL + "select model, setting, n_seeds, is_primary, " + ", ".join(f"{r6(f'{m}_{n}')} as {m}_{n}" for m in rollup.METRICS for n in ("mean", "std")) + " from rolled",
    "a18_per_class_rollup": VIEWS + """, e as (select model, setting, seed, label, avg(a) as precision, avg(b) as recall, avg(c) as f1, count(*) as support from runs group by all)
select model, setting, label, count(*) as n_seeds, """ + ", ".join(f"{r6(f'{f}({m})')} as {m}_{n}" for m in ("precision", "recall", "f1", "support") for n, f in (("mean", "avg"), ("std", "stddev_pop"))) + " from e group by model, setting, label",
    "a19_binary_rollup": VIEWS + "select model, setting, count(*) as n_seeds, " + ", ".join(f"{r6(f'{f}({c})')} as {m}_{n}" for m, c in (("precision", "accuracy"), ("recall", "macro_f1"), ("f1", "weighted_kappa"), ("auroc", "mae")) for n, f in (("mean", "avg"), ("std", "stddev_pop"))) + ", case when bool_or(seed = 1) then 'nan'::double else " + r6("avg(within1)") + " end as auprc_mean, case when bool_or(seed = 1) then 'nan'::double else " + r6("stddev_pop(within1)") + " end as auprc_std from results group by all",
    "j14_setting_delta": VIEWS + _ROLL + f"""select l.model, right(l.setting, length(l.setting) - length('train_real_only__eval_')) as eval_domain, {", ".join(f"{r6(f'r.{m}_mean - l.{m}_mean')} as delta_{m}" for m in ("macro_f1", "weighted_kappa", "accuracy", "mae"))}
from rolled l join rolled r on l.model = r.model and l.setting like 'train_real_only__%' and r.setting = replace(l.setting, 'train_real_only__', 'train_real_plus_synthetic__')""",
    "o02_best_setting": VIEWS + _ROLL + f"select model, setting, {r6('macro_f1_mean')} as macro_f1_mean from best",
    "j23_runs_of_best": VIEWS + _ROLL + "select model, setting, seed, " + ", ".join(f"{r6(m)} as {m}" for m in rollup.METRICS) + " from results semi join best using (model, setting)",
    "g06_best_epoch": f"select user_id as run, arg_min(event_id, (-round(value, 3), event_id)) as epoch, {r6('max(round(value, 3))')} as metric from events where not isnan(value) group by 1",
    "g06_early_stop": """with l as (select user_id as run, event_id as epoch, coalesce(round(value, 3), '-inf') as v from events),
b as (select *, max(v) over (partition by run order by epoch rows between unbounded preceding and 1 preceding) as best from l),
c as (select *, epoch - max(case when best is null or v > best then epoch end) over (partition by run order by epoch) as since from b)
select run, min(epoch) filter (since >= 7) as last_epoch from c group by run""",
    "g06_learning_rate": """with recursive l as (
  select user_id as run, round(value, 3) as m, row_number() over (partition by user_id order by event_id) as k from events where value is not null),
r as (
  select run, k, m as best, 0 as bad, 0 as cuts from l where k = 1
  union all select l.run, l.k, case when m > best * 1.0001::double then m else best end, case when m > best * 1.0001::double or bad + 1 > 2 then 0 else bad + 1 end,
         case when not m > best * 1.0001::double and bad + 1 > 2 then cuts + 1 else cuts end
  from r join l on l.run = r.run and l.k = r.k + 1)
select run, arg_max(cuts, k) as n_cuts, 0.5::double ** arg_max(cuts, k) as share from r group by run""",
    "g08_coral_loss": _JUDGED + f"""select fold, count(distinct vec_id) as n, {r6("sum(ln(1 + exp(-z)) + case when index > k then 0 else z end) / count(distinct vec_id)")} as loss from q where k < 4 group by fold""",
    "g08_corn_loss": _JUDGED + f"""select fold, count(*) as n, {r6("avg(ln(1 + exp(-z)) + case when index > k then 0 else z end)")} as loss from q where k < 4 and index >= k group by fold""",
    "g08_cross_entropy": _JUDGED + f""", c as (select index, count(*) as n from j group by 1), w as (select index, (sum(n) over ()) / (5.0::double * n) as weight from c),
l as (select vec_id, fold, j.index as index, ln(sum(exp(z))) - any_value(z) filter (k = j.index) as nll from q j group by vec_id, fold, j.index)
select fold, count(*) as n, {r6("sum(weight * nll) / sum(weight)")} as loss from l join w using (index) group by fold""",
    "g07_run_grid": VIEWS + "select * from (select distinct model from results), (select unnest(['nominal', 'coral', 'corn']) as head), (select distinct seed from results), (select distinct setting from results)",
    "i01_entropy": _kernel_sql("entropy"),
    "i02_laplacian_var": _kernel_sql("laplacian_var"),
    "i03_tenengrad": _kernel_sql("tenengrad"),
    "i04_rms": _kernel_sql("rms_contrast"),
    "i05_brightness": _kernel_sql("brightness_mean"),
    "i06_stat_bundle": _kernel_sql("laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"),
    "i07_stat_tasks": VIEWS + "select distinct origin as group_name, image_id, label from images where label in (4, 5) and image_id is not null",
    "i14_normalize": f"""with e as (select vec_id, generate_subscripts(embedding, 1) - 1 as i, greatest(0, least(255, floor((unnest(embedding)::double + 1.0) * 127))) as v from embeddings)
select vec_id, (i % 3)::int as channel, {r6("avg((v / 255.0::double - [0.485::double, 0.456, 0.406][(i % 3 + 1)::int]) / [0.229::double, 0.224, 0.225][(i % 3 + 1)::int])")} as mean from e group by 1, 2""",
    "i12_blend": """with p as (select vec_id, floor((unnest(embedding)::double + 1.0) * 127)::int as bg, least(1.0::double, abs(unnest(embedding)::double) * 2) as alpha from embeddings),
b as (select vec_id, trunc(greatest(0, least(255, bg + ((255 - bg) - bg) * (alpha * 0.5::double))))::int as v from p)
select vec_id, sum(v)::bigint as total, max(v) as most, min(v) as least from b group by vec_id""",
}
