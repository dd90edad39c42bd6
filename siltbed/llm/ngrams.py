"""Hashed character n-grams of batches of texts, as sparse rows, for the classifiers."""

from __future__ import annotations

import numpy as np

#: Code points worked on at once.
CHUNK = 1 << 20


def chunked(texts, chunk: int = CHUNK):
    """(first, texts) of runs of texts of about ``chunk`` characters; a longer text is a run of its own."""
    run, first, total = [], 0, 0
    for i, t in enumerate(texts):
        t = t or ""
        if run and total + len(t) > chunk:
            yield first, run
            run, first, total = [], i, 0
        run.append(t)
        total += len(t) + 2
    if run:
        yield first, run


def hashed(texts: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each n-gram position for each size, first position of each text plus the end).

    Texts get a blank on both sides. Positions whose n-gram would run into the next text have feature ``1 << bits``.
    """
    joined = "".join([f" {t} " for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 2 for t in texts], out=starts[1:])
    features = np.full((len(sizes), len(points)), 1 << bits, np.int32)
    for row, n in zip(features, sizes, strict=True):
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        row[: len(h)] = h >> np.uint32(32 - bits)
        for back in range(1, n):
            past = starts[1:] - back
            row[past[past >= 0]] = 1 << bits
    return features, starts
