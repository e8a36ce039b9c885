"""Derivations, quotas, composition and summaries by hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import derive, quotas
from tidemark.operators import composition as comp
from tidemark.operators import summary
from tidemark.sources import release

GOOD = "20250916_cambot1_20250916_090001_cambot1_20250916_090001_sec2690.jpg"


@pytest.mark.parametrize(
    "name, reason",
    [
        (GOOD, "ok"), ("a/b/" + GOOD.upper().replace("CAMBOT", "cambot"), "ok"), (GOOD.replace("090001", "090002"), "regex_no_match"), (None, "regex_no_match"), ("", "regex_no_match"),
        ("20250916_cambot1_20250916_090001_cambot2_20250916_090001_sec1.jpg", "camera_mismatch"), ("20250916_cambot1_20250916_090001_cambot1_20250916_160001_sec1.jpg", "timecode_mismatch"),
        ("20250917_cambot1_20250916_090001_cambot1_20250916_090001_sec1.jpg", "date_mismatch_prefix_capture"),
    ],
)
def test_parse_file_name(spark, name, reason):
    r = spark.createDataFrame([(name,)], "n string").select(derive.parse_file_name(F.col("n")).alias("p")).select("p.*").first()
    assert (r["reason"], r["valid"]) == (reason, reason == "ok")
    if name == GOOD:
        assert (r["cam"], r["state"], r["day"], r["sec"]) == ("cambot1", "morning", "20250916", 2690)


def test_ids_and_blocks(spark):
    df = spark.createDataFrame([("cambot1", "morning", "20250916", 2690), ("c", "evening", "20250101", -1), ("c", "evening", "20250101", 700_000), (None, "x", "y", 1)], "cam string, state string, day string, sec int")
    cap = derive.capture_id(F.col("cam"), F.col("state"), F.col("day"))
    rows = df.select(derive.group_id(cap, derive.block_index(F.col("sec"))).alias("g"), derive.real_image_id(F.col("cam"), F.col("state"), F.col("day"), F.col("sec")).alias("i")).collect()
    assert rows[0]["g"] == "cambot1__morning__20250916__blk004" and rows[0]["i"] == "R_cambot1_morning_20250916_002690"
    assert rows[1]["g"].endswith("__blk-01") and rows[2]["g"].endswith("__blk1166") and rows[3]["g"] is None and rows[3]["i"] is None
    one = spark.range(7, 8).select(derive.synthetic_image_id(F.col("id")), derive.asset_key(F.col("id")), derive.attempt_seed(F.col("id"))).first()
    assert tuple(one) == ("S_0000007", "A_0007", 42_000_007)


def test_label_boost_bounds_belong_above(spark):
    values = [0.0199999, 0.02, 0.08, 0.15, 0.2499999, 0.25, None, float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "b double").select(derive.label_boost(F.col("b"))).collect()]
    assert got == [0, 1, 2, 3, 3, 4, None, None]
    assert spark.range(1).select(derive.boosted_label(F.lit(4), F.lit(0.3))).first()[0] == 5


def test_quota_values():
    assert quotas.quotas({"train": 2800, "val": 400, "test": 400}, 3600) == {"train": 2800, "val": 400, "test": 400}
    assert quotas.quotas(quotas.LABEL_RATIOS, 2800) == {3: 420, 4: 700, 5: 1680}
    assert quotas.quotas(quotas.LABEL_RATIOS, 400) == {3: 60, 4: 100, 5: 240}
    assert quotas.quotas({"a": 1, "b": 1}, 1) == {"a": 1, "b": 0}
    with pytest.raises(ValueError):
        quotas.quotas({"a": 0}, 1)


def test_quota_table_adds_up(spark):
    df = spark.createDataFrame([("g", f"n{i}", float(i % 4), 17) for i in range(9)] + [("h", "x", None, 5), ("h", "y", 0.0, 5)], "g string, n string, r double, total bigint")
    got = {(r["g"], r["n"]): r["quota"] for r in quotas.largest_remainder(df, ["g"], "n", "r", F.col("total")).collect()}
    want = quotas.quotas({f"n{i}": i % 4 for i in range(9)}, 17)
    assert {n: q for (g, n), q in got.items() if g == "g"} == want and sum(want.values()) == 17
    assert got[("h", "x")] is None


def test_ratio_texts():
    assert quotas.parse_ratios("3:0.15, 4:0.25,") == {3: 0.15, 4: 0.25}
    assert quotas.parse_source_mix("3=1:0.3|2:0.7,4=2:1") == {3: {1: 0.3, 2: 0.7}, 4: {2: 1.0}}
    for bad in ("", "3", "3:x"):
        with pytest.raises(ValueError):
            quotas.parse_ratios(bad)
    for bad in ("3=4:1", "6=1:1", "3"):
        with pytest.raises(ValueError):
            quotas.parse_source_mix(bad)


def test_counts_zero_filled_and_sparse(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (6, "a"), (None, "a"), (5, None)], "label int, cam string")
    assert tuple(df.agg(*comp.label_counts()).first()) == (2, 0, 0, 0, 1)
    assert {tuple(r) for r in comp.sparse_counts(df, "label").collect()} == {(1, 2), (6, 1), (5, 1)}
    row = comp.cross_tab(df, "cam").first()
    assert row["n_images"] == 2 and row["label_5"] == 0
    assert comp.label_text(df.where("cam = 'a'"), "cam").first()["labels"] == "L1:2 | L2:0 | L3:0 | L4:0 | L5:0"


def test_summary_uses_population_std_and_exact_median(spark):
    df = spark.createDataFrame([("1",), ("2",), ("4",), ("7",), ("x",), (None,), ("NaN",)], "v string")
    r = summary.described(summary.long(df, ["v", "missing"]), "field").first()
    assert (r["n"], r["median"], r["min"], r["max"]) == (4, 3.0, 1.0, 7.0)
    assert math.isclose(r["std"], (sum((x - 3.5) ** 2 for x in (1, 2, 4, 7)) / 4) ** 0.5)
    assert summary.described(summary.long(df.where("false"), ["v"]), "field").count() == 0


def test_ecdf_keeps_ties_and_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 2.0), ("h", 5.0)], "g string, value double")
    assert sorted(tuple(r) for r in summary.ecdf(df, "g").collect()) == [("g", 1.0, 1 / 3), ("g", 1.0, 2 / 3), ("g", 2.0, 1.0), ("h", 5.0, 1.0)]
    bins = {(r["g"], r["bin"]): (r["n"], r["density"]) for r in summary.histogram(df, "g", bins=4).collect()}
    assert bins[("g", 3)] == (1, 1 / (3 * 0.25)) and bins[("g", 0)][0] == 2 and bins[("h", 2)] == (1, 4.0)


def test_weighted_draw_is_balanced(spark):
    df = spark.createDataFrame([(f"a{i}", 1) for i in range(95)] + [(f"b{i}", 2) for i in range(5)] + [("c", None)], "id string, label int")
    rows = summary.weighted_draw(df, "id", "label", 2000).collect()
    assert len(rows) == 2000 and 800 < sum(r["id"][0] == "b" for r in rows) < 1200


def test_aligned_casts_or_fails(spark):
    df = spark.createDataFrame([("45.0", " ", "x", "y")], "sec string, width string, _secret string, absolute_path string")
    out = release.aligned(df)
    assert [n for n, _ in out.dtypes] == [n for n, _ in release.columns()] and len(out.columns) == 33
    assert out.first()["sec"] == 45 and out.first()["width"] is None
    with pytest.raises(Exception, match="CAST|cast"):
        release.aligned(spark.createDataFrame([("4.5",)], "sec string")).collect()


def test_release_lookups(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        release.read_csv(spark, str(tmp_path / "no.csv"))
    with pytest.raises(FileNotFoundError):
        release.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    (tmp_path / "b").write_text("image_id,label\nR_1,3\n")
    path = release.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert release.read_csv(spark, path).select("image_id", "label", "sec").first() == ("R_1", 3, None)


def test_capture_splits_default_to_train(spark):
    real = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "capture_id string")
    dim = spark.createDataFrame([("a", "val"), ("b", "test"), ("b", "val"), (None, "test")], "capture_id string, split string")
    assert {(r["capture_id"], r["split"]) for r in release.capture_splits(real, dim).collect()} == {("a", "val"), ("b", "test"), (None, "train"), ("c", "train")}


def test_blockage_spelling_and_paths(spark):
    df = spark.createDataFrame([([0.2, 0.4], "CAM-24"), ([], "cambot_07"), (None, "none")], "a array<double>, c string")
    rows = df.select(derive.mean_blockage(F.col("a"), F.lit(0.5)).alias("m"), derive.spelled_camera(F.col("c")).alias("c")).collect()
    assert math.isclose(rows[0]["m"], 0.15) and rows[1]["m"] is None and rows[2]["m"] is None
    assert [r["c"] for r in rows] == ["cambot24", "cambot7", None]
    p = spark.createDataFrame([("/r/images\\a.jpg",), ("/other/b.jpg",), (None,)], "p string")
    assert [r[0] for r in p.select(derive.relative_path(F.col("p"), "/r/")).collect()] == ["images/a.jpg", "/other/b.jpg", None]
    with pytest.raises(KeyError):
        derive.absolute_path(["x"], "/r")
