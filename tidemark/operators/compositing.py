"""Laying a deposit over an image: fitting, blur, alpha blend, and the label that comes out. NumPy in Arrow batches; the blend also as a column expression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.derive import BOOST_BELOW
from tidemark.operators.kernels import area_resize
from tidemark.sources.workspace import ship

#: The bounds of rotation, blur and opacity, and how much larger than the image's diagonal the deposit is made.
ROTATION, BLUR, OPACITY, COVER = (0, 360), (15, 35), (0.10, 0.60), 1.1


def blended(below: Column, above: Column, alpha: Column, opacity: Column) -> Column:
    """Per pixel below + (above - below) * alpha * opacity, cut to 0..255 and truncated, over arrays of equal length."""
    pairs = F.zip_with(above, alpha, lambda d, a: F.struct(d.alias("d"), (a * opacity).alias("w")))
    return F.zip_with(below, pairs, lambda b, p: F.greatest(F.lit(0.0), F.least(F.lit(255.0), b + (p["d"] - b) * p["w"])).cast("int"))


def bilinear(image: np.ndarray, ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Samples at (ys, xs) with edges repeated."""
    h, w = image.shape[:2]
    y, x = np.clip(ys, 0, h - 1), np.clip(xs, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[..., None], (x - x0)[..., None]
    p = image.astype(np.float64).reshape(h, w, -1)
    return (p[y0, x0] * (1 - fy) * (1 - fx) + p[y0, x1] * (1 - fy) * fx + p[y1, x0] * fy * (1 - fx) + p[y1, x1] * fy * fx)


def fitted(asset: np.ndarray, height: int, width: int, angle: float) -> tuple[np.ndarray, float]:
    """The asset scaled to cover the image at any angle, turned about its middle and cut to the middle; with the scale asked for. Edges are repeated."""
    h, w = asset.shape[:2]
    scale = COVER * float(np.hypot(height, width)) / min(h, w)
    used = min(scale, 4000 / w)
    ys, xs = np.mgrid[0:height, 0:width]
    dy, dx = ys - (height - 1) / 2, xs - (width - 1) / 2
    a = np.deg2rad(angle)
    sy, sx = (np.cos(a) * dy + np.sin(a) * dx) / used, (np.cos(a) * dx - np.sin(a) * dy) / used
    return bilinear(asset, sy + (h - 1) / 2, sx + (w - 1) / 2), scale


def softened(image: np.ndarray, factor: int) -> np.ndarray:
    """Area-averaged down by ``factor``, then linearly up again: a blur."""
    h, w, c = image.shape
    small_h, small_w = max(1, h // factor), max(1, w // factor)
    small = np.stack([area_resize(image[:, :, k], small_h, small_w) for k in range(c)], axis=2)
    ys, xs = np.mgrid[0:h, 0:w]
    return bilinear(small, (ys + 0.5) * small_h / h - 0.5, (xs + 0.5) * small_w / w - 0.5)


def with_alpha(asset: np.ndarray) -> np.ndarray:
    """Four channels as they are; three get an alpha of 255 where the grey level is above 10; other counts are an error."""
    if asset.ndim == 3 and asset.shape[2] == 4:
        return asset
    if asset.ndim == 3 and asset.shape[2] == 3:
        gray = asset[:, :, 0] * 0.299 + asset[:, :, 1] * 0.587 + asset[:, :, 2] * 0.114
        return np.dstack([asset, np.where(gray > 10, 255, 0).astype(asset.dtype)])
    raise ValueError(f"an asset of shape {asset.shape}")


def overlay(image: np.ndarray, asset: np.ndarray, angle: int, blur: int, opacity: float) -> tuple[np.ndarray, float, float]:
    """(image with the deposit, mean blockage, scale) of an RGB image and an RGBA asset."""
    placed, scale = fitted(with_alpha(asset), image.shape[0], image.shape[1], angle)
    soft = softened(placed, blur)
    weight = np.clip(soft[:, :, 3:4] / 255.0, 0, 1) * opacity
    out = np.clip(image + (soft[:, :, :3] - image) * weight, 0, 255).astype(np.uint8)
    return out, float(weight.mean()), scale


def boosted(label: int, blockage: float) -> int:
    return min(5, label + sum(blockage >= b for b in BOOST_BELOW))


RESULT = (
    "uid bigint, image_id string, accepted boolean, reason string, label int, rotation_deg int, blur_scale_factor int, opacity double, avg_blockage double, "
    "coverage_scale double, pixels binary"
)


def synthesized(tasks: DataFrame) -> DataFrame:
    """One row per task(uid, image_id, label, target, seed, pixels, width, height, asset, asset_width, asset_height, asset_channels).

    Angle, blur and opacity are drawn from the task's own seed, in this order, so a result depends on its task only. A task is accepted if the label that the mean blockage gives is
    its target (else ``wrong_target``); null or ill-sized pixels are ``unreadable``. Pixels come back for accepted tasks only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b.itertuples(index=False):
                draw = np.random.Generator(np.random.PCG64(int(t.seed)))
                angle, blur, opacity = int(draw.integers(ROTATION[0], ROTATION[1] + 1)), int(draw.integers(BLUR[0], BLUR[1] + 1)), float(draw.uniform(*OPACITY))
                try:
                    image = np.frombuffer(t.pixels, np.uint8).reshape(int(t.height), int(t.width), 3)
                    asset = np.frombuffer(t.asset, np.uint8).reshape(int(t.asset_height), int(t.asset_width), int(t.asset_channels))
                    out, blockage, scale = overlay(image, asset, angle, blur, opacity)
                except (TypeError, ValueError):
                    rows.append((t.uid, t.image_id, False, "unreadable", None, angle, blur, round(opacity, 6), None, None, None))
                    continue
                label = boosted(int(t.label), blockage)
                good = label == int(t.target) and label != int(t.label)
                rows.append((t.uid, t.image_id, good, "ok" if good else "wrong_target", label, angle, blur, round(opacity, 6), round(blockage, 6), round(scale, 6), out.tobytes() if good else None))
            made = pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in RESULT.split(",")])
            made["label"] = made["label"].astype("Int32")
            yield made

    ship(tasks.sparkSession)
    return tasks.mapInPandas(run, RESULT)
