"""Histograms of gradients over blocks of binned rows. Only numpy, so that a worker loads little.

A block is (bins by feature and row with 0 for NULL, label, weight, key hash, score so far). A path is a tuple of steps (feature, cut, NULL left, goes left).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BLOCK_ROWS = 50_000
_P1, _P2, _P3, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def hashed_int(value: int, seeds: np.ndarray) -> np.ndarray:
    """What xxhash64 in SQL makes of an int after columns whose hashes are `seeds`."""
    with np.errstate(over="ignore"):
        x = seeds.view(np.uint64) + _P5 + np.uint64(4)
        x ^= np.uint64(value & 0xFFFFFFFF) * _P1
        x = ((x << np.uint64(23)) | (x >> np.uint64(41))) * _P2 + _P3
        x = (x ^ (x >> np.uint64(33))) * _P2
        x = (x ^ (x >> np.uint64(29))) * _P3
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def bin_type(most_cuts: int) -> type:
    return np.int16 if most_cuts < 32_000 else np.int32


def packed(bins: np.ndarray, y: np.ndarray, w: np.ndarray, hashes: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x).tobytes() for x in (bins, y, w, hashes))


def unpacked(data: bytes, n_features: int, kind: type, base: float) -> tuple:
    """The block of `packed` bytes, with the score `base` for all rows."""
    size = np.dtype(kind).itemsize * n_features
    n = len(data) // (size + 24)
    bins = np.frombuffer(data, kind, n * n_features).reshape(n_features, n)
    y, w = (np.frombuffer(data, np.float64, n, n * (size + 8 * i)) for i in (0, 1))
    return bins, y, w, np.frombuffer(data, np.int64, n, n * (size + 16)), np.full(n, base)


def joined(blocks: Iterable[tuple], rows: int = BLOCK_ROWS) -> Iterator[tuple]:
    """Small blocks put together, up to about `rows` rows each."""
    held: list[tuple] = []
    for block in blocks:
        held.append(block)
        if sum(len(b[1]) for b in held) >= rows:
            yield tuple(np.concatenate(part, axis=-1) for part in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(part, axis=-1) for part in zip(*held))


def places(bins: np.ndarray, paths: Sequence[tuple]) -> np.ndarray:
    """Per row the number of the path that it follows, -1 for none. No row may follow two."""
    known: dict[tuple, np.ndarray] = {(): np.ones(bins.shape[1], bool)}

    def follows(path: tuple) -> np.ndarray:
        if path not in known:
            j, cut, null_left, left = path[-1]
            goes = bins[j] <= cut + 1
            if not null_left:
                goes &= bins[j] > 0
            known[path] = follows(path[:-1]) & (goes if left else ~goes)
        return known[path]

    out = np.full(bins.shape[1], -1, np.int32)
    for i, path in enumerate(paths):
        out[follows(path)] = i
    return out


def scored(block: tuple, paths: Sequence[tuple], values: Sequence[float]) -> tuple:
    """The block with the values of a tree's leaves added to its scores."""
    return *block[:-1], block[-1] + np.array(values)[places(block[0], paths)]


def sums(blocks: Iterable[tuple], paths: Sequence[tuple], width: int, n_features: int, draw: tuple[int, int] | None = None) -> np.ndarray:
    """Gradient, hessian and rows by path, feature and bin. `draw` (number, limit): only rows whose key hash with that number is below the limit."""
    n = len(paths)
    out = np.zeros((n, 3, n_features, width))
    for bins, y, w, hashes, score in blocks:
        at = places(bins, paths)
        if draw:
            at[(hashed_int(draw[0], hashes) & ((1 << 20) - 1)) >= draw[1]] = -1
        rows = np.flatnonzero(at >= 0)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-score[rows]))
        first, w = at[rows] * width, w[rows]
        g, h = w * (p - y[rows]), w * p * (1 - p)
        for j in range(n_features):
            cell = first + bins[j, rows]
            for k, weights in enumerate((g, h, None)):
                out[:, k, j] += np.bincount(cell, weights, n * width).reshape(n, width)
    return out
