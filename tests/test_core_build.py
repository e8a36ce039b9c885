"""Sinks, tensors and the rows of a build."""

import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import compositing, losses, rollup, tensors
from tidemark.sources import build, files, pictures, release, sinks


def test_png_is_read_back(spark, tmp_path):
    rng = np.random.default_rng(3)
    images = {f"{c}/x.png": rng.integers(0, 256, (5, 7, c)).astype(np.uint8) for c in (1, 3, 4)}
    df = spark.createDataFrame([(p, bytearray(a.tobytes()), 7, 5) for p, a in images.items()] + [("none.png", None, 7, 5)], "path string, pixels binary, width int, height int")
    assert sinks.write_images(df, str(tmp_path), "png").count() == 3
    back = {r["path"].split("/")[-2]: r for r in spark.read.format("image").option("recursiveFileLookup", True).load(str(tmp_path)).select(F.col("image.origin").alias("path"), "image.*").collect()}
    for p, a in images.items():
        r = back[p[0]]
        got = np.frombuffer(bytes(r["data"]), np.uint8).reshape(5, 7, -1)
        want = a if a.shape[2] == 1 else a[..., [2, 1, 0, *range(3, a.shape[2])]]
        assert (got == want).all(), p
    with pytest.raises(ValueError):
        pictures.png(b"123", 2, 2)


def test_jpeg_is_read_back(spark, tmp_path):
    """Smooth and noisy images, sides that aren't multiples of 8, grey and RGB: the decoder sees what was written, but for quantisation."""
    rng = np.random.default_rng(4)
    y, x = np.mgrid[0:45, 0:61]
    smooth = np.dstack([x * 4, y * 5, 255 - x * 2 - y * 2]).clip(0, 255).astype(np.uint8)
    images = {"smooth.jpg": smooth, "noise.jpg": rng.integers(0, 256, (16, 24, 3)).astype(np.uint8), "flat.jpg": np.full((9, 7, 3), (200, 30, 90), np.uint8), "grey.jpg": smooth[..., :1], "one.jpg": np.full((1, 1, 3), 77, np.uint8)}
    df = spark.createDataFrame([(p, bytearray(a.tobytes()), a.shape[1], a.shape[0]) for p, a in images.items()], "path string, pixels binary, width int, height int")
    assert sinks.write_images(df, str(tmp_path), "jpeg").count() == len(images)
    back = {r["path"].rsplit("/", 1)[-1]: r for r in spark.read.format("image").load(str(tmp_path)).select(F.col("image.origin").alias("path"), "image.*").collect()}
    for p, a in images.items():
        r = back[p]
        got = np.frombuffer(bytes(r["data"]), np.uint8).reshape(r["height"], r["width"], -1).astype(int)
        want = a if a.shape[2] == 1 else a[..., ::-1]
        off = np.abs(got - want.astype(int))
        assert got.shape == want.shape and off.mean() < (6 if p == "noise.jpg" else 1.5) and off.max() < (40 if p == "noise.jpg" else 8), (p, off.mean(), off.max())
        assert pictures.header((tmp_path / p).read_bytes()) == (a.shape[1], a.shape[0], "L" if a.shape[2] == 1 else "RGB")


def test_headers_of_files(spark, tmp_path):
    rgb = bytes(range(12)) * 4
    made = {"a.png": pictures.png(rgb, 4, 4), "b.jpg": pictures.jpeg(rgb, 4, 4), "c.png": b"no image", "d.png": b"", "f.jpg": pictures.jpeg(rgb, 4, 4)[:40]}
    jpg = made["b.jpg"]
    made["late.jpg"] = jpg[:2] + (b"\xff\xfe\xff\xff" + b"n" * 65533) * 3 + jpg[2:]
    made["e.bmp"] = b"BM" + bytes(16) + (5).to_bytes(4, "little") + (-7).to_bytes(4, "little", signed=True) + b"\1\0\x18\0"
    made["x.txt"] = made["a.png"]
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[-1]: (r["width"], r["height"], r["mode"]) for r in files.headers(spark, str(tmp_path)).collect()}
    none = (None, None, None)
    assert got == {"a.png": (4, 4, "RGB"), "b.jpg": (4, 4, "RGB"), "c.png": none, "f.jpg": none, "late.jpg": (4, 4, "RGB"), "e.bmp": (5, 7, "RGB")}
    assert pictures.header(None) is None


def test_empty_files_are_listed_and_copied_bytes_are_equal(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    for name, data in (("sub/a b.bin", b"\x00\xff"), ("empty", b""), (".DS_Store", b"x"), ("sub/._a", b"y"), ("skip", b"z")):
        (tmp_path / "in" / name).write_bytes(data)
    sinks.copy_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), ("skip",)).count()
    assert (tmp_path / "out/sub/a b.bin").read_bytes() == b"\x00\xff" and sorted(os.listdir(tmp_path / "out")) == ["sub"]
    listed = {r["relative_path"]: (r["size_bytes"], r["sha256"]) for r in files.digests(spark, str(tmp_path / "in")).collect()}
    assert listed["empty"] == (0, hashlib.sha256(b"").hexdigest()) and listed["sub/a b.bin"][0] == 2
    assert {r["relative_path"] for r in files.inventory(spark, str(tmp_path / "in")).collect()} >= {"empty", "sub/a b.bin", "skip"}


def test_only_a_release_folder_is_reset(spark, tmp_path):
    sinks.reset(spark, str(tmp_path / "r"))
    (tmp_path / "r/x").write_text("1")
    sinks.reset(spark, str(tmp_path / "r"))
    assert not (tmp_path / "r/x").exists()
    (tmp_path / "other").mkdir()
    (tmp_path / "other/keep").write_text("1")
    with pytest.raises(ValueError):
        sinks.reset(spark, str(tmp_path / "other"))
    assert (tmp_path / "other/keep").exists()


def test_summary_and_manifest(spark, tmp_path):
    patched = sinks.patched_summary({"n": 3}, "v2", {"n": 3}, archive="a.zip")
    assert patched["release_tag"] == "v2" and patched["archive"] == "a.zip" and patched["finalized_utc"].endswith("+00:00")
    with pytest.raises(ValueError):
        sinks.patched_summary({"n": 3}, "v2", {"n": 4})
    (tmp_path / "o").mkdir()
    (tmp_path / "o/t.csv").write_text("1")
    one, two = (sinks.reproducibility_manifest(spark, str(tmp_path / "o"), c, ("numpy", "no-such-package"), workers=2) for c in ({"a": 1, "b": 2}, {"b": 2, "a": 1}))
    assert one["config_sha256"] == two["config_sha256"] and one["package_versions"] == {"numpy": np.__version__, "no-such-package": None} and one["workers"] == 2
    assert [o["relative_path"] for o in one["outputs"]] == ["t.csv"]


def test_run_outputs(spark, tmp_path):
    assets = spark.createDataFrame([("a", "old", "x"), ("b", "old", "x")], "asset_id string, asset_split string, _path string")
    sinks.write_assets(assets, spark.createDataFrame([("a", "val")], "asset_id string, split string"), str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/dirt_assets_manifest.parquet")
    assert got.columns == ["asset_id", "asset_split"] and {tuple(r) for r in got.collect()} == {("a", "val"), ("b", None)}
    pred = spark.createDataFrame([("i", 1, 2, *[0.2] * 5, "x")], "image_id string, target_label int, pred_label int, " + ", ".join(f"prob_L{k} double" for k in range(1, 6)) + ", other string")
    assert spark.read.parquet(sinks.write_predictions(pred, str(tmp_path), "m", "s", 1)).columns[-1] == "prob_L5"
    log = spark.createDataFrame([(e, *[0.5] * 8, 1) for e in (2, 1)], ", ".join(f"{c} {'int' if c in ('epoch', 'improved') else 'double'}" for c in sinks.LOG))
    path = sinks.write_train_log(log, str(tmp_path), "m", "s", 1)
    assert [r["epoch"] for r in spark.read.option("header", True).csv(path).collect()] == ["1", "2"]


def test_learning_rate_is_cut_on_a_plateau(spark):
    values = [0.5, 0.5, 0.5, 0.5, 0.6, 0.6, float("nan"), 0.59, 0.1, 0.1, 0.1]
    df = spark.createDataFrame([("r", k, v) for k, v in enumerate(values)] + [("r", 99, None), ("one", 1, 0.1), ("up", 1, 0.1), ("up", 2, 0.2)], "run string, epoch int, metric double")
    got = {r["run"]: (r["lr"], r["n_cuts"]) for r in rollup.learning_rates(df, 1.0).collect()}
    # three flat epochs, a better one, three that aren't, three more
    assert got == {"r": (0.125, 3), "one": (1.0, 0), "up": (1.0, 0)}


def test_tensors(spark):
    flat = np.full((40, 60, 3), (255, 0, 128), np.uint8)
    out = tensors.prepared(flat, 8)
    assert out.shape == (3, 8, 8) and np.allclose(out[0], (1 - 0.485) / 0.229, atol=1e-5) and np.allclose(out[1], -0.456 / 0.224, atol=1e-5)
    ramp = np.arange(16 * 16 * 3).reshape(16, 16, 3).astype(float)
    assert np.allclose(tensors.resized(ramp, 4, 4).mean((0, 1)), ramp.mean((0, 1))) and np.allclose(tensors.resized(ramp, 16, 16), ramp)
    grid = np.zeros((100, 100, 3), np.uint8)
    grid[:, 50:] = 255
    a, b = tensors.prepared(grid, 16, 1), tensors.prepared(grid, 16, 1)
    assert (a == b).all() and len({tensors.prepared(grid, 16, s).tobytes() for s in range(40)}) > 10
    assert {bool(tensors.prepared(grid, 64, s)[0, 0, 0] > 0) for s in range(20)} == {True, False}
    df = spark.createDataFrame([("i", 3, bytearray(flat.tobytes()), 60, 40), ("j", 1, None, 60, 40), ("k", None, bytearray(b"x"), 60, 40)], "image_id string, label int, pixels binary, width int, height int")
    for seed in (None, 5):
        got = {r["image_id"]: r for r in tensors.dataset(df, 8, seed).collect()}
        assert got["i"]["index"] == 2 and len(got["i"]["tensor"]) == 192 and got["j"]["tensor"] is None and got["k"]["tensor"] is None and got["k"]["index"] is None


def test_accepted_images_become_files_and_rows(spark, tmp_path):
    image, asset = bytes([100]) * (20 * 30 * 3), bytes([200, 200, 200, 255]) * 100
    cols = "uid bigint, image_id string, label int, target int, seed bigint, pixels binary, width int, height int, asset binary, asset_width int, asset_height int, asset_channels int, split string, asset_id string, asset_filename string"
    tasks = spark.createDataFrame([(k, "P", 3, t, 42_000_000 + k, bytearray(image), 30, 20, bytearray(asset), 10, 10, 4, "val", "A_0001", "a.png") for k, t in enumerate([5, 3])], cols)
    names = [n for n, _ in release.columns()]
    parent = {"image_id": "P", "origin": "real", "label": 3, "cam": "c1", "state": "morning", "cam_state": "c1__morning", "day": "20240101", "sec": 7, "capture_id": "k", "block_index": 0, "group_id": "g", "source_filename": "f.jpg"}
    parents = spark.createDataFrame([tuple(parent.get(n) for n in names)], release.COLUMNS)
    rows = build.synthetic_rows(compositing.synthesized(tasks), tasks, parents, str(tmp_path), "made_here").collect()
    assert [(r["image_id"], r["label"], r["source_label"], r["cam"], r["synthetic_split"], r["synthetic_seed"], r["sha256"]) for r in rows] == [("S_0000000", 5, 3, "c1", "val", 42_000_000, None)]
    assert rows[0]["relative_path"] == "images/synthetic/val/label_5/S_0000000.jpg" and (tmp_path / rows[0]["relative_path"]).exists() and rows[0].asDict().keys() == set(names)
    assert rows[0]["label_boost"] == (3 if rows[0]["avg_blockage"] < 0.25 else 4) and json.dumps(rows[0]["generator_version"]) == '"made_here"'


def test_losses_against_plain_sums(spark):
    import math
    import random

    rng = random.Random(6)
    data = [("a", [rng.gauss(0, 3) for _ in range(4)], rng.randrange(5), rng.random()) for _ in range(60)] + [("a", [800.0, -800.0, 0.0, 1.0], 2, 1.0)]
    bad = [("a", None, 1, 1.0), ("a", [0.0] * 4, None, 1.0), ("a", [0.0] * 4, 7, 1.0), ("a", [0.0] * 4, -1, 1.0), ("a", [None, 0.0, 0.0, 0.0], 1, 1.0), ("none", None, 1, 1.0)]
    df = spark.createDataFrame([*data, *bad], "g string, logits array<double>, index int, w double")
    soft = lambda z: max(z, 0) + math.log1p(math.exp(-abs(z)))
    ask = lambda z, yes: soft(-z) if yes else soft(z)
    coral = sum(ask(z, i > k) for _, zs, i, _ in data for k, z in enumerate(zs)) / len(data)
    asked = [ask(z, i > k) for _, zs, i, _ in data for k, z in enumerate(zs) if i >= k]
    known = [(zs, i, w) for _, zs, i, w in data if i < 4]
    nll = [(w, max(zs) + math.log(sum(math.exp(z - max(zs)) for z in zs)) - zs[i]) for zs, i, w in known]
    got = {f.__name__: [tuple(r) for r in f(df, "g", **kw).collect()] for f, kw in ((losses.coral_loss, {}), (losses.corn_loss, {}), (losses.cross_entropy, {"weight": "w"}))}
    assert [x[:2] for x in got["coral_loss"]] == [("a", len(data))] and got["coral_loss"][0][2] == pytest.approx(coral)
    assert [x[:2] for x in got["corn_loss"]] == [("a", len(asked))] and got["corn_loss"][0][2] == pytest.approx(sum(asked) / len(asked))
    assert [x[:2] for x in got["cross_entropy"]] == [("a", len(known))] and got["cross_entropy"][0][2] == pytest.approx(sum(w * x for w, x in nll) / sum(w for w, _ in nll))
