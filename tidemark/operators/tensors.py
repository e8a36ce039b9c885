"""What a training loop reads: images resized, cropped, mirrored and normalised, one row per image."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.kernels import CHANNEL_MEAN, CHANNEL_STD
from tidemark.sources.workspace import ship

#: Fixed value: a training image is first made larger by so many pixels than the part that is cut from it.
MARGIN = 32


def _weights(n: int, m: int) -> np.ndarray:
    """(m, n): each of m pixels as a mean of n, falling off linearly within a pixel of the coarser of the two grids."""
    step = n / m
    middle = (np.arange(m) + 0.5) * step
    w = np.maximum(0.0, 1 - np.abs(np.arange(n) + 0.5 - middle[:, None]) / max(step, 1.0))
    return w / w.sum(1, keepdims=True)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """(height, width, channels) of an image, linearly interpolated; averaged where it gets smaller."""
    return np.einsum("yi,ijc,xj->yxc", _weights(image.shape[0], height), image.astype(float), _weights(image.shape[1], width), optimize=True)


def prepared(image: np.ndarray, size: int, seed: int | None = None) -> np.ndarray:
    """(3, size, size) float32: resized to the size; with a seed resized to size + MARGIN, cut out at a random place and mirrored half the time. Then normalised by channel."""
    side = size + (0 if seed is None else MARGIN)
    out = np.clip(np.rint(resized(image, side, side)), 0, 255)
    if seed is not None:
        draw = np.random.Generator(np.random.PCG64(seed))
        y, x, turned = draw.integers(0, MARGIN + 1), draw.integers(0, MARGIN + 1), draw.random() < 0.5
        out = out[y : y + size, x : x + size]
        out = out[:, ::-1] if turned else out
    return ((out / 255 - np.array(CHANNEL_MEAN)) / np.array(CHANNEL_STD)).transpose(2, 0, 1).astype(np.float32)


def dataset(rows: DataFrame, size: int, seed: int | None = None, epoch: int = 0) -> DataFrame:
    """(image_id, index, tensor array<float>) of (image_id, label, pixels, width, height): the class index (label - 1) and the pixels of :func:`prepared`, channel by channel.

    ``seed``: for training; an image's cut depends on the seed, the epoch and its id only. Rows whose pixels aren't width x height RGB have a null tensor.
    """
    draw = F.lit(None).cast("bigint") if seed is None else F.xxhash64(F.lit(seed), F.lit(epoch), F.col("image_id")).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    schema = "image_id string, index int, tensor array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tensors = []
            for r in b.itertuples(index=False):
                try:
                    image = np.frombuffer(r.pixels, np.uint8).reshape(int(r.height), int(r.width), 3)
                    tensors.append(prepared(image, size, None if seed is None else int(r.draw)).ravel().tolist())
                except (TypeError, ValueError):
                    tensors.append(None)
            yield pd.DataFrame({"image_id": b["image_id"], "index": b["index"], "tensor": tensors})

    ship(rows.sparkSession)
    return rows.select("image_id", (F.col("label") - 1).cast("int").alias("index"), "pixels", "width", "height", draw.alias("draw")).mapInPandas(run, schema)
