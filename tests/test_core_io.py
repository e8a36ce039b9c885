"""Kernels on arrays and files, compositing, sources, sinks, streams."""

import json
import struct
import zlib
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import compositing, kernels
from tidemark.sources import files, release, sinks
from tidemark.sources.workspace import ship
from tidemark.streaming import audit


def png(a: np.ndarray) -> bytes:
    """A minimal PNG of an 8-bit grey or RGB array."""
    h, w = a.shape[:2]
    raw = b"".join(b"\0" + a[r].tobytes() for r in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_constant_image():
    assert kernels.stats(np.full((8, 8), 17, np.uint8)) == (0.0, 0.0, 0.0, 0.0, 17.0)


def test_two_level_image():
    lap, ten, rms, ent, mean = kernels.stats(np.array([[0, 2], [0, 2]], np.uint8))
    assert (ent, mean, rms) == (1.0, 1.0, 1.0)
    assert kernels.stats(np.zeros((0, 0), np.uint8)) == (0.0,) * 5 and kernels.entropy(np.zeros(0)) == 0.0


def test_kernels_against_direct_sums():
    rng = np.random.default_rng(0)
    g = rng.integers(0, 256, (7, 9)).astype(np.uint8)
    m = lambda i, n: -i if i < 0 else 2 * (n - 1) - i if i >= n else i
    at = lambda r, c: float(g[m(r, 7), m(c, 9)])
    lap = [at(r - 1, c) + at(r + 1, c) + at(r, c - 1) + at(r, c + 1) - 4 * at(r, c) for r in range(7) for c in range(9)]
    k = {(-1, -1): -1, (0, -1): -2, (1, -1): -1, (-1, 1): 1, (0, 1): 2, (1, 1): 1}
    grad = [sum(v * at(r + a, c + b) for (a, b), v in k.items()) ** 2 + sum(v * at(r + b, c + a) for (a, b), v in k.items()) ** 2 for r in range(7) for c in range(9)]
    assert np.isclose(kernels.laplacian_variance(g), np.var(lap)) and np.isclose(kernels.tenengrad(g), np.mean(grad))


def test_udf_handles_nulls_and_misfits(spark):
    ship(spark)
    df = spark.createDataFrame([([17] * 64, 8, 8), (None, 8, 8), ([1, 2], 8, 8), ([1], None, 1)], "p array<int>, w int, h int")
    got = [r[0] for r in df.select(kernels.low_level_stats("p", "w", "h")["brightness_mean"]).collect()]
    assert got == [17.0, None, None, None]


def test_area_resize_and_phash():
    g = np.arange(64 * 64).reshape(64, 64) % 251
    assert np.allclose(kernels.area_resize(g, 32, 32), g.reshape(32, 2, 32, 2).mean(axis=(1, 3)))
    assert np.isclose(kernels.area_resize(g, 7, 5).mean(), g.mean())
    d = kernels.dct_matrix(32)
    assert np.allclose(d @ d.T, np.eye(32))
    assert kernels.phash(g) == kernels.phash(np.repeat(np.repeat(g, 2, 0), 2, 1)) != kernels.phash(255 - g)


def test_sign_hash_in_the_jvm(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=64)
    want = sum(1 << k for k, b in enumerate(e > np.median(e.reshape(8, 8)[1:, 1:])) if b)
    got = spark.createDataFrame([(e.tolist(),), ([1.0],), (None,)], "e array<double>").select(kernels.sign_hash(F.col("e"))).collect()
    assert got[0][0] % 2**64 == want and got[1][0] is None and got[2][0] is None


def test_overlay_and_blend(spark):
    image, asset = np.full((20, 30, 3), 100, np.uint8), np.dstack([np.full((10, 10, 3), 200), np.full((10, 10), 255)]).astype(np.uint8)
    out, blockage, scale = compositing.overlay(image, asset, 33, 15, 0.5)
    assert np.isclose(blockage, 0.5) and (out == 150).all() and np.isclose(scale, 1.1 * np.hypot(20, 30) / 10)
    assert compositing.boosted(3, 0.02) == 4 and compositing.boosted(4, 0.5) == 5
    assert compositing.with_alpha(np.zeros((2, 2, 3), np.uint8)).shape == (2, 2, 4)
    with pytest.raises(ValueError):
        compositing.with_alpha(np.zeros((2, 2)))
    row = spark.createDataFrame([([100, 0], [200, 255], [1.0, 0.0])], "b array<int>, d array<int>, a array<double>")
    assert row.select(compositing.blended(F.col("b"), F.col("d"), F.col("a"), F.lit(0.5))).first()[0] == [150, 0]


def test_synthesized_tasks(spark):
    image, asset = bytes([100]) * (20 * 30 * 3), bytes([200, 200, 200, 255]) * 100
    cols = "uid bigint, image_id string, label int, target int, seed bigint, pixels binary, width int, height int, asset binary, asset_width int, asset_height int, asset_channels int"
    tasks = [(k, "p", 1, t, k, p, 30, 20, asset, 10, 10, 4) for k, (t, p) in enumerate([(5, bytearray(image)), (1, bytearray(image)), (5, None), (5, bytearray(b"x"))])]
    got = {r["uid"]: r for r in compositing.synthesized(spark.createDataFrame([(*t[:8], bytearray(t[8]), *t[9:]) for t in tasks], cols)).collect()}
    assert got[1]["reason"] == "wrong_target" and got[1]["pixels"] is None and got[2]["reason"] == got[3]["reason"] == "unreadable"
    assert got[0]["label"] == compositing.boosted(1, got[0]["avg_blockage"]) and np.isclose(got[0]["avg_blockage"], got[0]["opacity"], atol=1e-6)
    assert (got[0]["accepted"] is True) == (got[0]["label"] == 5)


@pytest.fixture
def folder(tmp_path):
    for label in ("1", "2", "other"):
        (tmp_path / "images" / label).mkdir(parents=True)
    g = (np.arange(48).reshape(6, 8) * 5).astype(np.uint8)
    (tmp_path / "images/1/b.png").write_bytes(png(g))
    (tmp_path / "images/1/a.png").write_bytes(png(np.dstack([g, g, g])))
    (tmp_path / "images/2/c.PNG").write_bytes(b"not an image")
    (tmp_path / "images/2/d.txt").write_text("x")
    (tmp_path / "images/other/e.png").write_bytes(png(g))
    return tmp_path


def test_inventory_digests_headers(spark, folder):
    assert {r[0]: r[1] for r in files.inventory(spark, str(folder)).collect()}["images/2/d.txt"] == 1
    import hashlib

    sha = {r["relative_path"]: r["sha256"] for r in files.digests(spark, str(folder), ("images/2/d.txt",)).collect()}
    assert len(sha) == 4 and sha["images/2/c.PNG"] == hashlib.sha256(b"not an image").hexdigest()
    rows = files.labelled_inventory(spark, str(folder / "images")).orderBy("pos").collect()
    assert [(r["label"], r["name"]) for r in rows] == [(1, "a.png"), (1, "b.png"), (2, "c.PNG")]
    heads = {r["path"].rsplit("/", 1)[-1]: (r["width"], r["height"], r["mode"]) for r in files.headers(spark, str(folder / "images")).collect()}
    assert heads["b.png"] == (8, 6, "L") and heads["a.png"] == (8, 6, "RGB") and heads["c.PNG"] == (None, None, None)


def test_image_statistics_of_decoded_files(spark, folder):
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in files.gray_images(spark, str(folder / "images")).select("path", kernels.low_level_stats("pixels", "width", "height").alias("s"), kernels.perceptual_hash("pixels", "width", "height").alias("h")).collect()}
    want = kernels.stats((np.arange(48).reshape(6, 8) * 5).astype(np.uint8))
    assert np.allclose(tuple(rows["b.png"]["s"]), want) and np.allclose(tuple(rows["a.png"]["s"]), want) and rows["a.png"]["h"] == rows["b.png"]["h"]
    assert kernels.image_stats(files.images(spark, str(folder / "images"))).count() == 3


def test_assets_are_numbered_by_name(spark):
    inv = spark.createDataFrame([("x/b.png", 1), ("x/a.png", 1)], "relative_path string, size_bytes bigint")
    assert [tuple(r) for r in files.number_assets(inv, "assets").orderBy("asset_id").collect()] == [("A_0001", "a.png", "assets/a.png"), ("A_0002", "b.png", "assets/b.png")]
    assert files.number_assets(inv, None).where("release_relative_path is not null").count() == 0


def test_annotations_json_and_reuse(spark, tmp_path):
    (tmp_path / "a.csv").write_text("image_id,annotator,label\ni,x,2.9\ni,y,bad\n")
    assert [(r["annotator"], r["label"]) for r in files.annotations(spark, str(tmp_path / "a.csv")).orderBy("pos").collect()] == [("x", 2.9), ("y", None)]
    (tmp_path / "b.csv").write_text("image_id\ni\n")
    with pytest.raises(ValueError):
        files.annotations(spark, str(tmp_path / "b.csv"))
    (tmp_path / "c.json").write_text(json.dumps({"fig": {"3": ["ä"]}}))
    assert files.json_document(spark, str(tmp_path / "c.json")) == {"fig": {"3": ["ä"]}}
    made = []
    ids = spark.createDataFrame([("i",), ("j",)], "image_id string")
    compute = lambda d: lambda: (made.append(1), d.withColumn("x", F.lit(1)))[1]
    for d, n in ((ids, 1), (ids, 1), (ids.limit(1), 2)):
        assert files.reused(spark, str(tmp_path / "cache"), d, compute(d)).count() == d.count() and len(made) == n


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "s")], "x int, y string, _z string")
    sinks.save_public_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["x", "y"]
    sinks.save_table(df.select("x", "y"), str(tmp_path / "t"), str(tmp_path / "t.tex"))
    assert "1 & a \\\\" in (tmp_path / "t.tex").read_text()
    with pytest.raises(ValueError):
        sinks.latex(spark.range(5), most=4)
    sinks.save_json({"ü": 1}, str(tmp_path / "j/s.json"))
    assert json.loads((tmp_path / "j/s.json").read_text()) == {"ü": 1}
    (tmp_path / "src").mkdir()
    (tmp_path / "src/f").write_text("1")
    sinks.build_zip(str(tmp_path / "src"), str(tmp_path / "1.zip"))
    sinks.build_zip(str(tmp_path / "src"), str(tmp_path / "2.zip"))
    assert (tmp_path / "1.zip").read_bytes() == (tmp_path / "2.zip").read_bytes()
    assert sinks.file_manifest(spark, str(tmp_path / "src")).first()["size_bytes"] == 1 and sinks.contents(spark, str(tmp_path / "src")).count() == 1
    assert sinks.Layout("/o/").benchmark("m", "s", 1, "coral") == "/o/benchmark/m/coral/s/seed_1" and "spark" in sinks.environment(spark)
    with pytest.raises(ValueError):
        sinks.Layout("/o").at("elsewhere")


def test_release_round_trip(spark, tmp_path):
    schema = release.COLUMNS + ", split string"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    row = lambda **k: tuple(k.get(n) for n in names)
    real = spark.createDataFrame([row(image_id="R", origin="real", label=1, cam="c", capture_id="k", split="train")], schema)
    syn = spark.createDataFrame([row(image_id="S", origin="synthetic", label=5, capture_id="k", split="val")], schema)
    sinks.write_metadata(real, syn, str(tmp_path))
    sinks.write_splits(real.unionByName(syn), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/metadata.parquet").where("origin = 'real'").count() == 1
    assert spark.read.parquet(f"{tmp_path}/splits.parquet").where("split = 'val'").first()["image_id"] == "S"
    s = sinks.build_summary(real.unionByName(syn), tag="v")
    assert (s["n_images"], s["label_5"], s["cams"], s["tag"]) == (2, 1, ["c"], "v")
    sinks.expect(s, n_real=1)
    with pytest.raises(ValueError):
        sinks.expect(s, n_real=2)


def test_streams(spark, tmp_path):
    d = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", d), ("a", d), ("b", d.replace(hour=5)), ("a", d.replace(day=2))], "k string, ts timestamp")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = lambda: audit.files(spark, str(tmp_path / "in"), df.schema)
    got = audit.completed(audit.windowed_counts(stream(), "ts", "1 day", "k"), spark)
    assert sorted((r["window_start"].day, r["k"], r["n"]) for r in got.collect()) == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]
    q = audit.audited(stream(), lambda b: b.groupBy("k").count(), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("k").agg(F.sum("count")).count() == 2
    q = audit.first_deliveries(stream(), "k", "ts", "30 days").writeStream.format("parquet").option("path", str(tmp_path / "first")).option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "first")).groupBy("k").count().where("count > 1").count() == 0


def test_images_are_written_by_tasks(spark, tmp_path):
    df = spark.createDataFrame([("a/x.ppm", bytearray(b"\x01\x02\x03" * 2), 2, 1)], "path string, pixels binary, width int, height int")
    assert sinks.write_images(df, str(tmp_path)).first()["size"] == 17
    assert (tmp_path / "a/x.ppm").read_bytes() == b"P6\n2 1\n255\n" + b"\x01\x02\x03" * 2
    with pytest.raises(ValueError):
        sinks.write_images(df, str(tmp_path), "jpg")
