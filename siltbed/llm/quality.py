"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Document frequencies of hashed character n-grams are counted over all documents. The labelled vectors come from a
bounded sample of labelled rows (``sample_rows``, taken in hash order): their log-scaled tf-idf rows give a truncated
singular value basis by subspace iteration. Basis and labelled vectors have fixed sizes, so the broadcast is bounded.
Every document is projected, its cosines with all labelled vectors are computed in blocks, and its ``neighbours``
nearest vote with a power of their similarity as weight. One more coordinate of a vector is the share of words that
repeat the word before, which counts of n-grams hardly show.

Defined results: a null or empty text, or one without any known n-gram, gets the sample's mean label; without labelled
rows every score is 0.5; labels that are null are ignored and several labels of one id are averaged; repeated rows get
equal scores; columns other than id and text never enter a score.
"""

from __future__ import annotations

import operator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm._common import bounded_batches, scanned, staged, trimmed
from siltbed.llm.ngrams import chunked, hashed

SIZES, BITS = (2, 3), 13
WIDTH = 1 << BITS
BLOCK = 256
#: Length of the coordinate of repetition where every word repeats the one before; a latent-semantic vector has 1.
AGAIN = 2.0
#: Power of a similarity that is a neighbour's weight.
SHARPNESS = 4


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def repeated_share(text: str) -> float:
    words = text.split()
    return sum(map(operator.eq, words, islice(words, 1, None))) / max(1, len(words))


def counts_of(texts):
    """(first, dense rows of n-gram counts, shares of repeated words) for blocks of texts; case is kept."""
    for first, run in chunked(texts, 1 << 19):
        features, starts = hashed(run, SIZES, BITS)
        for low in range(0, len(run), BLOCK):
            high = min(low + BLOCK, len(run))
            part = features[:, starts[low] : starts[high]].astype(np.int64)
            row = np.repeat(np.arange(high - low), np.diff(starts[low : high + 1])) * (WIDTH + 1)
            cells = np.bincount((part + row).ravel(), minlength=(high - low) * (WIDTH + 1))
            again = np.array([repeated_share(t) for t in run[low:high]], np.float32)
            yield first + low, cells.reshape(high - low, WIDTH + 1)[:, :WIDTH], again


class NeighbourModel:
    """idf and basis make vectors; refs are the labelled unit vectors, labels their 0/1 labels."""

    def __init__(self, idf, basis, refs, labels, neighbours: int, again: float):
        self.idf, self.basis, self.refs, self.labels, self.neighbours, self.again = idf, basis, refs, labels, neighbours, again

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        rows = np.log1p(counts.astype(np.float32)) * self.idf
        return unit(rows)

    def vectors(self, counts: np.ndarray, again: np.ndarray) -> np.ndarray:
        return unit(np.column_stack([unit(self.weighted(counts) @ self.basis), self.again * np.sqrt(again)]))

    def scores(self, texts) -> np.ndarray:
        out = np.full(len(texts), self.labels.mean() if len(self.labels) else 0.5)
        k = min(self.neighbours, len(self.labels))
        for first, counts, again in counts_of(texts) if k else ():
            cosines = self.vectors(counts, again) @ self.refs.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cosines, near, axis=1), 0, None).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            known = (counts.sum(axis=1) > 0) & (total > 0)
            known &= np.array([bool(t) for t in texts[first : first + len(counts)]])
            out[first : first + len(counts)] = np.where(known, vote, out[first : first + len(counts)])
        return np.round(np.clip(out, 0, 1), 6)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Over all rows: in how many texts each feature occurs, and the number of texts."""

    bounded_batches(docs.sparkSession)

    def count(batches):
        total, n = np.zeros(WIDTH, np.int64), 0
        for pdf in batches:
            n += len(pdf)
            for _, counts, _ in counts_of(list(pdf["text"])):
                total += (counts > 0).sum(axis=0)
        yield pd.DataFrame({"feature": np.arange(-1, WIDTH), "n": np.concatenate([[n], total])})

    cells = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "feature long, n long")
    found = cells.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # at most WIDTH + 1 rows
    out = np.zeros(WIDTH + 1, np.int64)
    out[found["feature"] + 1] = found["n"]
    return out[1:], int(out[0])


def basis_of(blocks, shape: tuple[int, int], rank: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start.

    blocks() gives the dense rows, some at a time, so that the whole matrix of ``shape`` is never held.
    """
    rank = min(rank, *shape)
    start = np.random.default_rng(7).standard_normal((shape[1], min(rank + 16, *shape)))
    basis = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(sum(rows.T @ (rows @ basis) for rows in blocks()))[0]
    small = np.concatenate([rows @ basis for rows in blocks()])
    _, turn = np.linalg.eigh(small.T @ small)
    return (basis @ turn[:, ::-1])[:, :rank].astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 4096,
    rank: int = 64,
    neighbours: int = 9,
    again: float = AGAIN,
) -> NeighbourModel:
    """Fit on at most ``sample_rows`` of ``labels`` (id, label); statistics cover all of ``docs``."""
    present, n_docs = document_frequencies(docs, text_col)
    idf = np.log((n_docs + 1) / (present + 1)).astype(np.float32) + 0.05
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.avg(label_col).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample_rows)
    )
    chosen = F.broadcast(staged(chosen, "quality-sample"))  # at most sample_rows rows
    texts = docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
    rows = texts.join(chosen, F.col("own_id") == F.col("label_id")).groupBy("label_id", "label").agg(F.min("text").alias("text"))

    def sparse(batches):
        for pdf in batches:
            texts = list(pdf["text"])
            for first, counts, again in counts_of(texts):
                at = [np.flatnonzero(c) for c in counts]
                part = pdf.iloc[first : first + len(counts)]
                yield pd.DataFrame(
                    {
                        "label_id": part["label_id"],
                        "label": part["label"],
                        "at": [a.astype(np.uint16).tobytes() for a in at],
                        "n": [c[a].astype(np.int32).tobytes() for a, c in zip(at, counts, strict=True)],
                        "again": again,
                    }
                )

    kind = rows.schema["label_id"].dataType.simpleString()
    sample = rows.mapInPandas(sparse, f"label_id {kind}, label double, at binary, n binary, again float")
    sample = sample.orderBy("label_id").toPandas()  # at most sample_rows sparse rows
    model = NeighbourModel(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 2), np.float32), np.zeros(0), neighbours, again)
    if len(sample):
        cells = list(zip(sample["at"], sample["n"], strict=True))

        def blocks():
            for low in range(0, len(cells), BLOCK):
                dense = np.zeros((min(BLOCK, len(cells) - low), WIDTH), np.float32)
                for i, (at, n) in enumerate(cells[low : low + BLOCK]):
                    dense[i, np.frombuffer(at, np.uint16)] = np.frombuffer(n, np.int32)
                yield model.weighted(dense)

        model.basis = basis_of(blocks, (len(cells), WIDTH), rank)
        repeats = sample["again"].to_numpy(np.float32)
        model.refs = unit(np.column_stack([unit(np.concatenate([rows @ model.basis for rows in blocks()])), again * np.sqrt(repeats)]))
        model.labels = sample["label"].to_numpy(float)
        del sample, cells
        trimmed()  # the driver too keeps what it held, beside all that the plans of later steps take
    return model


def classify(docs: DataFrame, model: NeighbourModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return scanned(docs, text_col, [id_col], {"score": "double"}, lambda texts: [shared.value.scores(texts)])


def kept(docs: DataFrame, model: NeighbourModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""
    bounded_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def choose(batches):
        for batch in batches:  # Arrow, so that the other columns pass untouched
            good = shared.value.scores(batch.column(at).to_pylist()) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(choose, docs.schema)
