"""Hashed character and word n-grams of texts as numpy arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(1099511628211)


def held_out(id_: Column) -> Column:
    """The rows that no label is learned from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def buckets(keys: np.ndarray, bits: int, salt: int) -> np.ndarray:
    """Bucket numbers of 64-bit keys."""
    mixed = (keys + np.uint64(salt)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def char_ngrams(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Buckets of all n-grams of code points."""
    if len(points) < n:
        return np.empty(0, np.int64)
    keys = points[: len(points) - n + 1].copy()
    for i in range(1, n):
        keys *= _STEP
        keys ^= points[i : len(points) - n + 1 + i]
    return buckets(keys, bits, n)


def word_keys(points: np.ndarray) -> np.ndarray:
    """A 64-bit key for each word between white space: sums of code points times powers."""
    blank = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 160) | (points == 0x3000)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    inside = np.arange(len(points)) - np.repeat(starts, np.diff([*starts, len(points)])) if starts[0] == 0 else None
    if inside is None:
        lead = starts[0]
        inside = np.concatenate([np.zeros(lead, np.int64), np.arange(len(points) - lead) + lead - np.repeat(starts, np.diff([*starts, len(points)]))])
    power = np.full(int(max(sizes.max(), inside.max() + 1)), _STEP)
    power[0] = 1
    power = np.multiply.accumulate(power)
    terms = np.where(blank, np.uint64(0), (points + np.uint64(7)) * power[inside])
    return np.add.reduceat(terms, starts)
