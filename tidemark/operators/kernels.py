"""Image kernels: grey-level statistics, perceptual hash, decoding. Arrow-vectorised where pixels are touched; hashes of small blocks stay in the JVM.

Grey images are arrays of 0..255 in row-major order with their width and height. Borders are mirrored without repeating the edge.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidemark.sources.workspace import ship

#: The statistics of an image, in the order that :func:`stats` gives them.
STATS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean")])
#: The weights of red, green and blue in the grey level.
LUMA = (0.299, 0.587, 0.114)


#: Mean and deviation of the red, green and blue channel that networks expect.
CHANNEL_MEAN, CHANNEL_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


def normalized(value: Column, channel: Column) -> Column:
    """A channel value of 0..255 as networks expect it: (value / 255 - mean) / deviation of channel 0, 1 or 2; null for other channels."""
    pick = lambda x: F.try_element_at(F.array(*[F.lit(v) for v in x]), channel + 1)
    return (value / 255.0 - pick(CHANNEL_MEAN)) / pick(CHANNEL_STD)


def entropy(gray: np.ndarray) -> float:
    """Bits of the 256-bin histogram; 0 for no pixels."""
    if gray.size == 0:
        return 0.0
    share = np.bincount(gray.astype(np.uint8).ravel(), minlength=256) / gray.size
    share = share[share > 0]
    return float(abs(-(share * np.log2(share)).sum()))


def _mirrored(gray: np.ndarray) -> np.ndarray:
    mode = "reflect" if min(gray.shape) > 1 else "edge"
    return np.pad(gray.astype(np.float64), 1, mode=mode)


def laplacian_variance(gray: np.ndarray) -> float:
    """Population variance of the four-neighbour Laplacian."""
    p = _mirrored(gray)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def tenengrad(gray: np.ndarray) -> float:
    """Mean squared 3 x 3 Sobel gradient."""
    p = _mirrored(gray)
    down, right = p[2:, :] - p[:-2, :], p[:, 2:] - p[:, :-2]
    gy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    gx = right[:-2, :] + 2 * right[1:-1, :] + right[2:, :]
    return float((gx**2 + gy**2).mean())


def stats(gray: np.ndarray) -> tuple[float, float, float, float, float]:
    """laplacian_var, tenengrad, rms_contrast, entropy, brightness_mean; zeros for no pixels."""
    if gray.size == 0:
        return (0.0,) * 5
    return laplacian_variance(gray), tenengrad(gray), float(gray.astype(np.float64).std()), entropy(gray), float(gray.mean())


@pandas_udf(STATS)
def low_level_stats(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
    """The five statistics of grey images as arrays or binary; null where pixels, width or height are null or don't fit."""
    rows = []
    for p, w, h in zip(pixels, width, height):
        if p is None or pd.isna(w) or pd.isna(h):
            rows.append((None,) * 5)
            continue
        flat = np.frombuffer(p, np.uint8) if isinstance(p, (bytes, bytearray)) else np.asarray(p)
        rows.append(stats(flat.reshape(int(h), int(w))) if flat.size == int(w) * int(h) else (None,) * 5)
    return pd.DataFrame(rows, columns=["laplacian_var", "tenengrad", "rms_contrast", "entropy", "brightness_mean"])


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over the area of each target pixel, partly covered source pixels weighted by their cover."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * (n / m)
        left, right = np.maximum(edges[:-1, None], np.arange(n)), np.minimum(edges[1:, None], np.arange(n) + 1)
        return np.clip(right - left, 0, None) / (n / m)

    return weights(gray.shape[0], height) @ gray.astype(np.float64) @ weights(gray.shape[1], width).T


@lru_cache(maxsize=4)
def dct_matrix(n: int) -> np.ndarray:
    """The orthonormal DCT-II."""
    k = np.arange(n)
    m = np.sqrt(2 / n) * np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    m[0] /= np.sqrt(2)
    return m


def phash(gray: np.ndarray, side: int = 8, factor: int = 4) -> int:
    """64 bits: which of the 8 x 8 lowest frequencies of the 32 x 32 image exceed the median of those without row and column 0. As a signed bigint, bit k is coefficient k."""
    n = side * factor
    low = (dct_matrix(n) @ area_resize(gray, n, n) @ dct_matrix(n).T)[:side, :side]
    bits = (low > np.median(low[1:, 1:])).ravel()
    value = sum(1 << k for k, b in enumerate(bits) if b)
    return value - (1 << 64) if value >= 1 << 63 else value


@pandas_udf(T.LongType())
def perceptual_hash(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """:func:`phash` of grey images; null where there is none."""
    out = []
    for p, w, h in zip(pixels, width, height):
        flat = None if p is None else np.frombuffer(p, np.uint8) if isinstance(p, (bytes, bytearray)) else np.asarray(p)
        out.append(None if flat is None or flat.size == 0 or flat.size != int(w) * int(h) else phash(flat.reshape(int(h), int(w))))
    return pd.Series(out, dtype="Int64")


def sign_hash(block: Column, side: int = 8) -> Column:
    """The bits of an 8 x 8 block of coefficients against the median of those without row and column 0, as a bigint; all in the JVM."""
    inner = F.array(*[F.element_at(block, r * side + c + 1).cast("double") for r in range(1, side) for c in range(1, side)])
    middle = F.element_at(F.array_sort(inner), ((side - 1) ** 2 + 1) // 2)
    packed = F.transform(block, lambda x, i: F.when(x.cast("double") > middle, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    return F.when(F.size(block) == side * side, F.aggregate(F.reverse(packed), F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b)))


@pandas_udf(T.BinaryType())
def to_gray(data: pd.Series, channels: pd.Series) -> pd.Series:
    """The grey bytes of image data in the order blue, green, red (, alpha): rounded luma; one channel stays as it is."""
    out = []
    for d, n in zip(data, channels):
        if d is None or pd.isna(n):
            out.append(None)
            continue
        a = np.frombuffer(d, np.uint8)
        if int(n) > 1:
            a = a.reshape(-1, int(n)).astype(np.float64)
            a = np.floor(a[:, 2] * LUMA[0] + a[:, 1] * LUMA[1] + a[:, 0] * LUMA[2] + 0.5).astype(np.uint8)
        out.append(a.tobytes())
    return pd.Series(out)


def image_stats(images: DataFrame, key: str = "path") -> DataFrame:
    """(key, five statistics, phash) of a table from Spark's image source: decoded in the JVM, computed once per image in Arrow batches."""
    ship(images.sparkSession)
    gray = images.select(F.col("image.origin").alias(key), to_gray("image.data", "image.nChannels").alias("g"), F.col("image.width").alias("w"), F.col("image.height").alias("h"))
    return gray.select(key, low_level_stats("g", "w", "h").alias("s"), perceptual_hash("g", "w", "h").alias("phash")).select(key, "s.*", "phash")
