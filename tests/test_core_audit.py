"""Integrity, duplicates, agreement, classification, roll-ups, distributions, lineage."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import agreement, classification, distribution, duplicates, integrity, lineage, rollup


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_null_ids_overlap_as_one_id(spark):
    real = spark.createDataFrame([("a", "g", None, "train"), ("b", "g", None, "val"), ("a", "h", "c", "test"), ("z", "i", "d", None)], "image_id string, group_id string, capture_id string, split string")
    got = {(r["field"], r["left_split"], r["right_split"]): r["overlap"] for r in integrity.split_overlaps(real).collect()}
    assert got[("capture_id", "train", "val")] == 1 and got[("image_id", "train", "test")] == 1 and got[("group_id", "train", "val")] == 1 and got[("image_id", "val", "test")] == 0
    assert len(got) == 9


def test_leaks_count_rows_not_parents(spark):
    real = spark.createDataFrame([("p", "val", "c1"), ("q", "train", "c2"), ("r", "test", "c3")], "image_id string, split string, capture_id string")
    syn = spark.createDataFrame([("train", "p", "train"), ("train", "p", None), ("train", "q", "val"), ("val", "x", "val"), ("val", None, "val"), ("val", "p", "val")], "split string, parent_image_id string, asset_split string")
    assert rows(integrity.parent_leaks(syn, real)) == {("val", 2), ("test", 0)}
    assert rows(integrity.asset_mismatches(syn)) == {("train", 2), ("val", 0)}
    assert rows(integrity.parent_capture_faults(syn, real)) == {("train", 2), ("val", 1)}
    assert integrity.asset_mismatches(syn.where("false")).count() == 0


def test_audit_reports_and_raises(spark):
    real = spark.createDataFrame([("p", "g", "c", "val")], "image_id string, group_id string, capture_id string, split string")
    syn = spark.createDataFrame([("train", "p", "train")], "split string, parent_image_id string, asset_split string")
    out = integrity.audit(real, syn)
    assert out.columns == ["check", "passed", "violations", "details"]
    with pytest.raises(integrity.CheckFailed, match="no_training_parent_leak_into_val_real: n_leaks=1"):
        integrity.raise_on_failure(out)


def test_set_operations(spark):
    a, b = spark.createDataFrame([("x",), ("x",), (None,)], "k string"), spark.createDataFrame([("y",), (None,)], "k string")
    assert tuple(integrity.set_difference(a, b, "k").first()) == (1, 1, 1)
    assert rows(integrity.inventory_difference(a, b, "k")) == {("listed_only", 1, "x"), ("actual_only", 1, "y")}
    assert rows(integrity.duplicate_keys(a, "k")) == {("x", 2)}
    parts = spark.createDataFrame([("x", "p"), ("x", "q"), ("w", "p")], "k string, part string")
    assert tuple(integrity.partition_faults(a, parts, "k", "part").first()) == (1, 1, 1)
    c, d = spark.createDataFrame([("x", 1, None)], "k string, m int, n int"), spark.createDataFrame([("x", 2, None)], "k string, m int, n int")
    assert rows(integrity.mismatches(c, d, "k", ["m", "n"])) == {("x", "m")}


@pytest.mark.parametrize("blocks", [None, 5, 7])
def test_near_duplicates_equal_cross_join(spark, blocks):
    random.seed(5)
    values = [random.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in random.sample(range(64), random.randrange(0, 7))) for v in values for _ in range(2)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(signed)] + [(999, None)], "id int, hash bigint")
    want = {(a, b, bin((a ^ b) & (2**64 - 1)).count("1")) for a, b in itertools.combinations(sorted(set(signed)), 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert rows(duplicates.near_duplicates(df, blocks=blocks)) == want
    whole = duplicates.near_duplicate_rows(df)
    assert whole.count() == len(signed) and whole.where("n_same > 1").count() == sum(signed.count(v) > 1 for v in signed)


def test_full_bands_are_cut(spark, monkeypatch):
    """Hashes that share most of their bits, in pieces of three: the same pairs."""
    rng = random.Random(2)
    signed = list({sum(1 << b for b in rng.sample(range(20), rng.randrange(8))) for _ in range(120)})
    df = spark.createDataFrame(list(enumerate(signed)), "id int, hash bigint")
    want = {(a, b, bin(a ^ b).count("1")) for a, b in itertools.combinations(sorted(signed), 2) if bin(a ^ b).count("1") <= 4}
    monkeypatch.setattr(duplicates, "FULL", 3)
    assert rows(duplicates.near_duplicates(df)) == want and len(want) > 100


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "id int, d string")
    assert rows(duplicates.exact_duplicates(df, "id", "d")) == {(3, 1, 2), (1, 1, 2)}
    assert rows(duplicates.duplicate_report(df, "id", "d", "id")) == {("duplicate", "a", 2, 0, "1|3", None)}
    assert rows(duplicates.duplicate_report(df.where("id = 2"), "id", "d", "id")) == {("ok", None, 0, 0, None, "no equal contents")}


def test_duplicate_report_lists_every_id_and_every_error(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else f"u{i}", None) for i in range(3000)] + [(9000, None, "unreadable")], "id int, d string, e string")
    out = duplicates.duplicate_report(df, "id", "d", "id", "e", per_row=700).collect()
    parts = sorted((r["part"], r["image_ids"].split("|"), r["n_images"]) for r in out if r["status"] == "duplicate")
    assert [int(x) for _, ids, _ in parts for x in ids] == [i for i in range(3000) if i % 3] and [len(ids) for _, ids, _ in parts] == [700, 700, 600]
    assert {n for _, _, n in parts} == {2000} and [(r["image_ids"], r["details"]) for r in out if r["status"] == "error"] == [("9000", "unreadable")]


def test_assets_are_mapped_enriched_and_checked(spark):
    from tidemark.operators.integrity import CheckFailed, asset_map, enriched_assets, enrichment_faults, selected_rows

    names = "asset_id string, asset_filename string, release_relative_path string, asset_split string, description string, preparation_category string, width int, height int, mode string, sha256 string"
    made = lambda i, s: (i, f"{i}.png", None, s, "old", None, 1, 1, "RGBA", None)
    assets = spark.createDataFrame([made("a_1", "train"), made("a_2", "val"), made("a_3", "val")], names)
    told = spark.createDataFrame([("a_1", "mud", "train"), ("a_2", "film", "test")], "asset_id string, description string, asset_split string")
    assert rows(enrichment_faults(assets, told)) == {("a_2", "other_split"), ("a_3", "no_description")}
    with pytest.raises(CheckFailed, match="a_2: other_split; a_3: no_description"):
        enriched_assets(assets, told, strict=True)
    assert [(r["asset_id"], r["description"]) for r in enriched_assets(assets.where("asset_id = 'a_1'"), told, strict=True).collect()] == [("a_1", "mud")]
    seen = spark.createDataFrame([("s1", "a_1"), ("s2", "gone"), ("s3", None)], "image_id string, asset_id string")
    assert rows(asset_map(seen, assets).select("image_id", "asset_pool")) == {("s1", "train"), ("s2", None), ("s3", None)}
    images = spark.createDataFrame([("i1", "real", 3), ("i2", "real", 3), ("i3", "real", 4), ("i4", "synthetic", 3)], "image_id string, origin string, label int")
    assert [(r["place"], r["image_id"]) for r in selected_rows(images, ["i2", "i1"], "real", 3).collect()] == [(1, "i2"), (2, "i1")]
    for ids, error in ((["i1", "x"], KeyError), (["i1", "i4"], ValueError), (["i1", "i3"], ValueError)):
        with pytest.raises(error):
            selected_rows(images, ids, "real", 3)


def test_work_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.sources import workspace

    class Conf:
        def get(self, *_):
            return None

    for master, fine in (("local[4]", True), ("local", True), ("local-cluster[3,2,1024]", False), ("spark://host:7077", False), ("yarn", False)):
        spark = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master=master, applicationId=master, getConf=Conf))
        if fine:
            assert workspace.shared_folder(spark).startswith("file://")
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                workspace.shared_folder(spark)


def votes(spark, data):
    return spark.createDataFrame([(i, a, None if x is None else float(x), n) for n, (i, a, x) in enumerate(data)], "image_id string, annotator string, label double, pos bigint")


def test_kappa_of_two_classes_uses_their_places(spark):
    v = votes(spark, [("i", "a", 1), ("i", "b", 1), ("j", "a", 5), ("j", "b", 1), ("k", "a", 5), ("k", "b", 5), ("l", "a", 1), ("l", "b", 1)])
    r = agreement.pairwise_agreement(v, "pos").first()
    # two classes: both weights are the same, kappa = (0.75 - 0.5) / 0.5
    assert r["n_images"] == 4 and math.isclose(r["cohen_kappa"], 0.5) and math.isclose(r["quadratic_weighted_kappa"], 0.5) and r["raw_agreement"] == 0.75


def test_constant_votes_have_no_kappa(spark):
    r = agreement.pairwise_agreement(votes(spark, [("i", "a", 2), ("i", "b", 2.9)]), "pos").first()
    assert math.isnan(r["cohen_kappa"]) and r["raw_agreement"] == 1.0


def test_first_votes_and_rollup(spark):
    v = votes(spark, [("i", "a", None), ("i", "a", 3), ("i", "a", 4), ("i", "b", 1), ("n", "a", None)])
    assert rows(agreement.first_votes(v, "pos")) == {("i", "a", 3), ("i", "b", 1)}
    got = {r["image_id"]: r for r in agreement.vote_rollup(v).collect()}
    assert (got["i"]["n_votes"], got["i"]["disagreement_span"], got["i"]["needs_adjudication"]) == (3, 3, 1)
    assert got["n"]["n_votes"] == 0 and got["n"]["min_label"] is None
    assert sum(r["n"] for r in agreement.first_pair_confusion(v, "pos").collect()) == 1
    assert agreement.first_pair_confusion(v.where("annotator = 'a'"), "pos").count() == 0
    assert agreement.agreement_summary(v.where("false"), "pos").first()["n_images"] == 0


def test_macro_f1_counts_present_labels_only(spark):
    p = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (None, 1)], "target_label int, pred_label int")
    cells = classification.cells(p)
    assert math.isclose(classification.macro_f1(cells).first()[0], (2 / 3 + 2 / 3) / 2)
    table = {r["label"]: r for r in classification.per_class(cells).collect()}
    assert len(table) == 5 and table[5]["f1"] == 0.0 and table[1]["precision"] == 1.0 and table[1]["support"] == 2
    assert math.isclose(classification.scalars(cells).first()["accuracy"], 2 / 3)
    shares = {(r["x"], r["y"]): r["share"] for r in classification.confusion(cells).collect()}
    assert shares[(1, 2)] == 0.5 and shares[(3, 3)] == 0.0 and len(shares) == 25


def test_auroc_and_average_precision_with_ties(spark):
    random.seed(2)
    data = [(random.randrange(2), random.randrange(6) / 5) for _ in range(200)]
    df = spark.createDataFrame([*data, (1, None), (0, float("nan"))], "t int, s double")
    pos, neg = [s for t, s in data if t], [s for t, s in data if not t]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert math.isclose(classification.auroc(df, truth="t", score="s").first()[0], want)
    ap = 0.0
    for s in sorted(set(s for _, s in data), reverse=True):
        seen = [t for t, x in data if x >= s]
        ap += sum(1 for t, x in data if x == s and t) / len(pos) * sum(seen) / len(seen)
    assert math.isclose(classification.average_precision(df, truth="t", score="s").first()[0], ap)
    assert math.isnan(classification.auroc(df.where("t = 1"), truth="t", score="s").first()[0])


def test_ordinal_decoding(spark):
    z = [2.0, 0.5, -1.0, 0.0]
    df = spark.createDataFrame([(z,)], "z array<double>")
    s = 1 / (1 + np.exp(-np.array(z)))
    r = df.select(classification.coral_label(F.col("z")), classification.coral_probabilities(F.col("z")), classification.corn_label(F.col("z")), classification.corn_probabilities(F.col("z")), classification.softmax(F.col("z")), classification.argmax(F.col("z"))).first()
    adj = lambda q: np.append(1, q) - np.append(q, 0)
    clamped = np.maximum(adj(s), 0)
    assert r[0] == 2 and np.allclose(r[1], clamped / clamped.sum()) and r[2] == int((np.cumprod(s) > 0.5).sum()) and np.allclose(r[3], adj(np.cumprod(s)))
    assert np.allclose(r[4], np.exp(z) / np.exp(z).sum()) and r[5] == 0


def test_wasserstein(spark):
    data = [("a", x) for x in (0.0, 1.0, 3.0)] + [("b", x) for x in (5.0, 6.0, 8.0)]
    df = spark.createDataFrame(data, "g string, value double")
    one = distribution.wasserstein(df, group="g", left="a", right="b").first()[0]
    assert one == 5.0 == distribution.wasserstein(df, group="g", left="b", right="a").first()[0]
    assert distribution.wasserstein(df.where("g = 'a'"), group="g", left="a", right="b").count() == 0


def test_components_match_numpy(spark):
    random.seed(4)
    data = [(x := random.gauss(0, 1), 2 * x + random.gauss(0, 0.1), random.gauss(0, 1)) for _ in range(300)]
    loadings, scores = distribution.components(spark.createDataFrame([*data, (None, 1.0, 1.0)], "a double, b double, c double"), ["a", "b", "c"])
    z = (np.array(data) - np.mean(data, axis=0)) / np.std(data, axis=0)
    want = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    got = {r["component"]: r["variance"] for r in loadings.collect()}
    assert np.allclose([got[1], got[2]], want[:2]) and scores.count() == 300
    assert math.isclose(np.var([r["pc1"] for r in scores.collect()], ddof=1), want[0], rel_tol=1e-9)


def test_rollup(spark):
    data = [("m", s, k, float(k), 0.5, 0.1, 0.2, 0.3) for s in (*rollup.PRIMARY, "other") for k in range(3)]
    runs = spark.createDataFrame(data, "model string, setting string, seed int, accuracy double, macro_f1 double, weighted_kappa double, mae double, within1 double")
    rolled = rollup.by_setting(runs)
    one = rolled.where(F.col("setting") == rollup.PRIMARY[0]).first()
    assert one["n_seeds"] == 3 and one["is_primary"] == 1 and math.isclose(one["accuracy_std"], (2 / 3) ** 0.5)
    assert rows(rollup.best_settings(rolled, {rollup.PRIMARY[1]: 0, rollup.PRIMARY[0]: 1}).select("model", "setting")) == {("m", rollup.PRIMARY[1])}
    assert [tuple(r) for r in rollup.setting_deltas(rolled).collect()] == [("m", "real_only", 0.0, 0.0, 0.0, 0.0)]


def test_best_epoch_needs_a_strictly_better_value(spark):
    log = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.7), ("r", 3, 0.7), ("r", 4, None), ("r", 5, float("nan"))], "run string, epoch int, metric double")
    assert rows(rollup.best_epochs(log)) == {("r", 2, 0.7)}
    assert rows(rollup.stopped_epochs(log, 3)) == {("r", 5)} and rows(rollup.stopped_epochs(log, 4)) == {("r", None)}


def test_near_duplicate_queries_take_all_bits(spark, tmp_path):
    """Close, equal and distant embeddings, against all pairs of their 64-bit hashes, which the lowest 24 bits get wrong."""
    from tests.compare import connect, same
    from tidemark.plans import integrity_queries, registry

    rng, data = random.Random(12), []
    for k in range(25):
        base = [rng.gauss(0, 1) for _ in range(64)]
        others = [[-x if i in flips else x for i, x in enumerate(base)] for flips in (set(rng.sample(range(64), 1)), set(rng.sample(range(64), 2)), set(range(24, 64)))]
        data += [(4 * k + n, e, rng.randrange(10)) for n, e in enumerate([base, *others])]
    data.append((900, data[0][1], (data[0][2] + 5) % 10))
    spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    q, sql, folder = registry.queries(), registry.oracle_sql(), str(tmp_path)
    hashes = sorted({r["hash"] for r in integrity_queries._near_hashes(spark, folder).collect()})
    apart = {(a, b): bin((a ^ b) & ((1 << 64) - 1)).count("1") for a, b in itertools.combinations(hashes, 2)}
    want = {(a, b, n) for (a, b), n in apart.items() if n <= 4}
    assert len(want) >= 20 and rows(q["j12_near_duplicates"](spark, folder)) == want
    assert len({(a & 0xFFFFFF, b & 0xFFFFFF) for a, b in apart if bin((a ^ b) & 0xFFFFFF).count("1") <= 4}) > len(want)
    base = connect(folder)
    for name in ("j12_near_duplicates", "j12_near_duplicate_rows", "j12_between_splits", "j12_split_pairs"):
        assert q[name](spark, folder).count() > 0
        same(spark, base, folder, q[name], sql[name])


def test_balanced_parents_take_turns(spark):
    data = [(f"i{c}{k}", f"c{c}") for c in range(3) for k in range(20 if c == 0 else 2)]
    out = lineage.balanced_parents(spark.createDataFrame(data, "image_id string, capture_id string"), 2, 12).collect()
    load = {c: sum(r["capture_id"] == c for r in out) for c in ("c0", "c1", "c2")}
    assert load == {"c0": 4, "c1": 4, "c2": 4} and max(sum(r["image_id"] == i for r in out) for i, _ in data) <= 2
    assert sorted(r["turn"] for r in out) == list(range(1, 13))


def test_accept_reject_keeps_quota_and_cap(spark):
    parents = spark.createDataFrame([("train", s, f"c{k % 3}", f"p{s}{k}") for s in (1, 2, 3) for k in range(10)], "split string, source int, capture_id string, image_id string")
    outcomes = spark.createDataFrame([(f"p{s}{k}", k % 4) for s in (1, 2, 3) for k in range(10)], "image_id string, boost int")
    plan = spark.createDataFrame([("train", t, p, s, 4) for t, ss in ((3, (1, 2)), (5, (3, 2))) for p, s in enumerate(ss, 1)], "split string, target int, priority int, source int, quota int")
    caps = spark.createDataFrame([("train", 2)], "split string, most int")
    out = lineage.sampled(parents, outcomes, plan, caps).collect()
    good = [r for r in out if r["accepted"]]
    assert {t: sum(r["target"] == t for r in good) for t in (3, 5)} == {3: 4, 5: 4}
    assert max(sum(r["image_id"] == i for r in good) for i in {r["image_id"] for r in good}) <= 2
    assert all(min(5, r["source"] + int(r["image_id"][2:]) % 4) == r["target"] for r in good)


def test_sampler_plan_is_the_whole_one(spark):
    from tidemark.plans import integrity_queries

    made = spark.createDataFrame([("train", 5, 3)] * 2 + [("train", 5, 2)] * 3 + [("val", 5, 2)], "synthetic_split string, label int, source_label int")
    plan = rows(integrity_queries._plan(spark, made))
    assert sum(q for s, t, q in {(s, t, q) for s, t, _, _, q in plan}) == 3600 and ("train", 5, 1, 2, 1680) in plan and ("train", 5, 2, 3, 1680) in plan
    assert {(p, src) for s, t, p, src, _ in plan if (s, t) == ("val", 5)} == {(1, 3)} and ("test", 3, 1, 1, 60) in plan
    parents = spark.createDataFrame([(f"p{k}",) for k in range(400)], "image_id string")
    children = spark.createDataFrame([("p0", 3), ("p0", 4), (None, 1), ("gone", 1), ("p1", None)], "parent_image_id string, label_boost int")
    boosts = dict(tuple(r) for r in integrity_queries._outcomes(parents, children).collect())
    assert len(boosts) == 400 and boosts["p0"] == 3 and set(boosts.values()) == {1, 3, 4}


def test_sampler_equals_a_search_of_all_parents(spark):
    """The heaps choose as a scan of all free parents does, and a parent without outcome is tried and fails."""
    rng = random.Random(8)
    data = [("train", rng.choice([1, 2, 3]), f"c{rng.randrange(6)}", f"p{k:03d}") for k in range(120)]
    boost = {d[3]: rng.randrange(4) for d in data if rng.random() < 0.8}
    steps = {3: (1, 2), 4: (3, 2), 5: (3, 2)}
    used, load, want = {}, {}, []
    for t in steps:
        got, tries, failed = 0, 0, set()
        while got < 40 and tries < 800:
            for src in steps[t]:
                free = [d for d in data if d[1] == src and used.get(d[3], 0) < 2 and d[3] not in failed]
                if free:
                    break
            else:
                break
            _, src, c, i = min(free, key=lambda d: (load.get(d[2], 0), d[2], used.get(d[3], 0), d[3]))
            tries, good = tries + 1, i in boost and min(5, src + boost[i]) == t
            if good:
                used[i], load[c], got = used.get(i, 0) + 1, load.get(c, 0) + 1, got + 1
            else:
                failed.add(i)
            want.append(("train", t, tries, i, src, good))
    plan = spark.createDataFrame([("train", t, p, s, 40) for t, ss in steps.items() for p, s in enumerate(ss, 1)], "split string, target int, priority int, source int, quota int")
    out = lineage.sampled(spark.createDataFrame(data, "split string, source int, capture_id string, image_id string"), spark.createDataFrame(list(boost.items()), "image_id string, boost int"), plan, spark.createDataFrame([("train", 2)], "split string, most int"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want) and any(w[3] not in boost for w in want)


def test_asset_pools_give_each_split_one(spark):
    ratios = spark.createDataFrame([("train", 1, 2800.0), ("val", 2, 400.0), ("test", 3, 400.0)], "split string, pos int, ratio double")
    pools = lambda n: [r["split"] for r in lineage.asset_pools(spark.createDataFrame([(f"A_{i:04d}",) for i in range(n)], "asset_id string"), ratios).orderBy("asset_id").collect()]
    assert pools(11) == ["train"] * 9 + ["val"] + ["test"] and pools(3) == ["train", "val", "test"] and pools(0) == []


def test_parent_child_deltas(spark):
    stats = spark.createDataFrame([("p", 1.0), ("p", 5.0), ("c", 4.0)], "image_id string, m double")
    edges = spark.createDataFrame([("c", "p"), ("c", "p"), ("x", "p"), ("c", None)], "image_id string, parent_image_id string")
    assert rows(lineage.parent_child_deltas(edges, stats, ["m"])) == {("c", "p", 1.0, 4.0, 3.0)}


def test_large_and_lone_statistics_stay(spark):
    """An image that lacks a metric keeps the other four, and finite values of any size count."""
    from types import SimpleNamespace

    from tidemark.plans import composition_queries, integrity_queries

    nan, inf = float("nan"), float("inf")
    data = [("p", 1.0, 5e4, 1.0, 1.0, 1.0), ("c", 3e9, None, 2.0, nan, 1.5), ("d", inf, 7e4, 4.0, 2.0, 0.5)]
    stats = spark.createDataFrame([(*d[:1], 1, "real", *d[1:]) for d in data], "image_id string, measured_at int, group_name string, " + ", ".join(f"{m} double" for m in integrity_queries.METRICS))
    edges = spark.createDataFrame([("c", "p"), ("d", "p")], "image_id string, parent_image_id string")
    r = SimpleNamespace(stats=stats, synthetic=edges)
    deltas = {x["image_id"]: [x[f"delta_{m}"] for m in integrity_queries.METRICS] for x in integrity_queries._deltas(r).collect()}
    assert deltas == {"c": [3e9 - 1, None, 1.0, None, 0.5], "d": [None, 2e4, 3.0, 1.0, -0.5]}
    z = {x["image_id"]: list(x)[2:] for x in composition_queries._standardized(r).collect()}
    assert [[v is None for v in z[i]] for i in "pcd"] == [[False] * 5, [False, True, False, True, False], [True] + [False] * 4]
    assert composition_queries._all_values(r).where("abs(value) > 1e4").count() == 3
    assert spark.sql("select 5e4D as laplacian_var, 1D as tenengrad, 1D as rms_contrast, 1D as entropy, 1D as brightness_mean").where(composition_queries._FINITE).count() == 1


def test_ecdf_query_draws_the_four_metrics(spark):
    from tidemark.plans import registry

    got = {r["field"] for r in registry.queries()["o05_ecdf"](spark, "/root/testdata/sf0.001").select("field").distinct().collect()}
    assert got == {"laplacian_var", "tenengrad", "rms_contrast", "entropy"}


def test_weighted_draw_query_draws_as_many_as_there_are_rows(spark):
    from types import SimpleNamespace

    from tidemark.plans import composition_queries

    master = spark.createDataFrame([(f"i{k}", k % 3) for k in range(1203)] + [("i0", 0), (None, 1), ("x", None)], "image_id string, label int")
    out = composition_queries._drawn(SimpleNamespace(master=master)).collect()
    assert len(out) == 1203 and {r["draw"] for r in out} == set(range(1203)) and "x" not in {r["image_id"] for r in out}


def test_sampler_reaches_past_failures(spark):
    """Fifteen parents fail before one fits: all of them must be in reach though the group is bounded by the quota."""
    data = [("train", 3, "c", f"p{k:02d}") for k in range(60)]
    outcomes = spark.createDataFrame([(f"p{k:02d}", 0 if k < 15 else 2) for k in range(60)], "image_id string, boost int")
    plan = spark.createDataFrame([("train", 5, 1, 3, 1)], "split string, target int, priority int, source int, quota int")
    out = lineage.sampled(spark.createDataFrame(data, "split string, source int, capture_id string, image_id string"), outcomes, plan, spark.createDataFrame([("train", 2)], "split string, most int"))
    assert [(r["attempt"], r["image_id"], r["accepted"]) for r in out.orderBy("attempt").collect()] == [(k + 1, f"p{k:02d}", k == 15) for k in range(16)]
    assert [tuple(r) for r in lineage.numbered(out).select("uid", "image_id").collect()] == [(1, "p15")]


def test_command_line(spark, tmp_path, capsys):
    from tidemark.__main__ import main

    assert main(["--list"]) == 0 and "a04_split_composition" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["--data", "x", "--out", "y", "no_such_query"])


def test_first_source_with_a_free_parent(spark):
    used = spark.createDataFrame([("train", 1, 0), ("train", 2, 3), ("val", 1, 0)], "split string, source int, n_free int")
    order = spark.createDataFrame([("train", 3, 1, 1), ("train", 3, 2, 2), ("val", 3, 1, 1)], "split string, target int, source int, priority int")
    assert rows(lineage.eligible_sources(used, order)) == {("train", 3, 2)}
