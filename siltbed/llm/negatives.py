"""Hard-negative mining: exact windows of inner products through product quantisation with residual norms.

Vectors are whole numbers. Each is stored as codes, one for each piece of ``piece`` components, with the norm of what the
codes miss. For an anchor, lookup tables of its products with all codewords sum to a score; the true product differs from
it by no more than the anchor's norm times the residual norm. A row whose bounds cannot reach what is asked is left out
rigorously; the few nearest by score are multiplied out first, so that what is asked is sharp, then all others whose
bounds reach it. What a task answers for its rows is exact, and the best of all tasks' answers are the answer.

Codewords are fitted on a bounded sample (``sample_rows``, in hash order); they decide how much is left out, never the
result. Anchors come in rounds of ``round_anchors``, whose vectors are what a round broadcasts; a round is two scans of
the packed rows, one for positives, one for the windows below them, each of which writes a table.

Defined results: a row with a null id, label or vector, or with a null or non-finite component, takes no part; vectors of
other lengths than the longest count as filled up with zeros; repeated rows each count as a row of their own; an anchor
without positives, or a window without rows, gives no rows; an empty table gives an empty result; other columns are
ignored. Whole components must be below 2**24 in size and vectors below 2**14 long, so that products fit 64 bits: a row
beyond that is an error, not a wrong score.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm._common import bounded_batches, staged, trimmed
from siltbed.stages import stage_root

PIECE, WORDS = 2, 256
#: Rows of a packed block, and anchors that are scored against it at once.
BLOCK, ANCHORS_AT_ONCE = 2048, 256
PEAK = 1 << 24


class Codebook:
    """Codewords of each piece, whole numbers: (pieces, words, piece)."""

    def __init__(self, words: np.ndarray, width: int):
        self.words, self.width = words, width

    @classmethod
    def fitted(cls, sample: np.ndarray, rounds: int = 6) -> Codebook:
        """By k-means on each piece from evenly spaced rows of the sample."""
        sample = padded(sample, -(-max(1, sample.shape[1]) // PIECE) * PIECE)
        pieces = sample.reshape(len(sample), -1, PIECE).astype(np.float64)
        words = np.zeros((pieces.shape[1], WORDS, PIECE), np.int64)
        for j in range(pieces.shape[1] if len(sample) else 0):
            rows = pieces[:, j]
            at = rows[np.linspace(0, len(rows) - 1, WORDS).astype(int)]
            for _ in range(rounds):
                own = nearest(rows, at)
                n = np.bincount(own, minlength=WORDS)
                sums = np.stack([np.bincount(own, weights=rows[:, k], minlength=WORDS) for k in range(PIECE)], axis=1)
                at = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], at)
            words[j] = np.round(at)
        return cls(words, sample.shape[1])

    def encoded(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, residual norms rounded up) of whole vectors of the book's width."""
        pieces = vectors.reshape(len(vectors), -1, PIECE)
        codes = np.stack([nearest(pieces[:, j].astype(np.float64), w) for j, w in enumerate(self.words.astype(np.float64))], axis=1)
        missed = pieces - self.words[np.arange(len(self.words)), codes]
        return codes.astype(np.uint8), norms(missed.reshape(len(vectors), -1))

    def tables(self, anchors: np.ndarray, kind) -> np.ndarray:
        """Products of the anchors' pieces with all codewords: (pieces, words, anchors)."""
        pieces = anchors.reshape(len(anchors), -1, PIECE)
        return np.einsum("jwk,ajk->jwa", self.words, pieces).astype(kind)


def nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words**2).sum(axis=1) - 2.0 * (rows @ words.T), axis=1)


def norms(whole: np.ndarray) -> np.ndarray:
    """Norms of whole vectors, rounded up to whole numbers."""
    return np.ceil(np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)).astype(np.int64)


def padded(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))) if vectors.shape[1] < width else vectors


def matrix(vectors, width: int) -> np.ndarray:
    """Whole vectors of an Arrow list column, filled up with zeros."""
    flat, ends = np.asarray(vectors.flatten()), np.cumsum([0, *vectors.value_lengths().to_pylist()])
    size = np.diff(ends)
    if len(size) and (size == width).all():
        out = flat.reshape(len(size), width)
    else:
        out = np.zeros((len(size), width))
        row = np.repeat(np.arange(len(size)), size)
        out[row, np.arange(len(flat)) - np.repeat(ends[:-1], size)] = flat
    if out.size and np.abs(out).max() >= PEAK:
        raise ValueError("a component is 2**24 or more in size")
    return out.astype(np.int64)


PACKED = "ids binary, labels binary, codes binary, residuals binary, vectors binary"
PACKED_ARROW = pa.schema([(c, pa.binary()) for c in ("ids", "labels", "codes", "residuals", "vectors")])


def packed(rows: DataFrame, book: Codebook) -> DataFrame:
    """Rows (id, label, vector) as blocks, each sorted by label."""

    def pack(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(low, BLOCK)
                ids, labels = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 1))
                order = np.lexsort((ids, labels))
                vectors = matrix(batch.column(2), book.width)[order]
                codes, residuals = book.encoded(vectors)
                parts = [ids[order], labels[order], codes, residuals, vectors.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], schema=PACKED_ARROW)
        trimmed()

    return rows.mapInArrow(pack, PACKED)


class Rows:
    """A block again."""

    def __init__(self, row: dict, width: int):
        self.ids, self.labels, self.residuals = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "residuals"))
        self.codes = np.frombuffer(row["codes"], np.uint8).reshape(len(self.ids), -1)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(self.ids), width)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))


class Anchors:
    """Anchors of a round, sorted by label, with the norms and tables that bound their products."""

    def __init__(self, number: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.number, self.labels, self.vectors, self.norms = number, labels, vectors, norms(vectors)
        self.peak = int(np.abs(vectors).max()) if vectors.size else 0

    def kind(self, book: Codebook):
        """Floats that hold every sum of products exactly."""
        most = self.peak * int(np.abs(book.words).max()) * book.width
        return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def looked_up(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Scores (rows, anchors): the sum of each piece's table at the rows' codes."""
    total = np.take(tables[0], codes[:, 0], axis=0)
    buffer = np.empty_like(total)
    for j in range(1, len(tables)):
        np.take(tables[j], codes[:, j], axis=0, out=buffer, mode="clip")
        total += buffer
    return total


def exact(vectors: np.ndarray, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return vectors[rows].astype(np.int64) @ anchor


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]


def answered(rows: Rows, at: np.ndarray, score: np.ndarray, spread: np.ndarray, anchor: np.ndarray, low: int, high: int, k: int):
    """(scores, ids) of the first k of the rows ``at`` whose product is within [low, high], by bounds score +- spread."""
    reach = (score + spread >= low) & (score - spread <= high)
    at, score, spread = at[reach], score[reach], spread[reach]
    if len(at) > 4 * k:
        seeds = np.argpartition(np.abs(np.minimum(score, high) - high) + np.maximum(score - high, 0), 4 * k - 1)[: 4 * k]
        sure = exact(rows.vectors, at[seeds], anchor)
        sure = np.sort(sure[(sure >= low) & (sure <= high)])[::-1]
        if len(sure) >= k:
            reach = score + spread >= sure[k - 1]
            at = at[reach]
    products = exact(rows.vectors, at, anchor)
    inside = (products >= low) & (products <= high)
    products, ids = products[inside], rows.ids[at[inside]]
    best = first(products, ids, k)
    return products[best], ids[best]


class Kept:
    """The first k (score, id) so far of each of ``n`` questions."""

    def __init__(self, n: int, k: int):
        self.k, self.found = k, [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(n)]

    def least(self, i: int, low: int) -> int:
        """What a score must reach to matter."""
        scores = self.found[i][0]
        return max(low, int(scores[-1])) if len(scores) == self.k else low

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate([self.found[i][0], scores]), np.concatenate([self.found[i][1], ids])
            best = first(scores, ids, self.k)
            self.found[i] = scores[best], ids[best]


LOWEST, HIGHEST = -(1 << 62), 1 << 62
FOUND = "anchor long, question int, score long, id long"


def searched(blocks: DataFrame, anchors: Anchors, book: Codebook, same_label: bool, questions: list[np.ndarray], k: int) -> DataFrame:
    """FOUND rows of each task: the first k rows of each question of each anchor, of the anchor's label or of all others.

    questions: for each anchor an array (number, low, high).
    """
    bounded_batches(blocks.sparkSession)
    asked = np.array([i for i, q in enumerate(questions) if len(q)], np.int64)
    shared = blocks.sparkSession.sparkContext.broadcast((anchors, book, questions, asked))

    def search(batches):
        anchors, book, questions, asked = shared.value
        kept = [Kept(len(q), k) for q in questions]
        kind = anchors.kind(book)
        tables = {}
        for batch in batches:
            for row in batch.to_pylist():
                rows = Rows(row, book.width)
                for low in range(0, len(asked), ANCHORS_AT_ONCE):
                    some = asked[low : low + ANCHORS_AT_ONCE]
                    if low not in tables:
                        tables = {low: book.tables(anchors.vectors[some], kind)}
                    score_blocks(rows, some, tables[low], anchors, questions, kept)
        for i in asked.tolist():
            for q, (scores, ids) in zip(questions[i].tolist(), kept[i].found, strict=True):
                if len(scores):
                    n = len(scores)
                    made = [np.full(n, anchors.number[i]), np.full(n, q[0], np.int32), scores, ids]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["anchor", "question", "score", "id"])
        trimmed()

    def score_blocks(rows, some, tables, anchors, questions, kept):
        everything = np.arange(len(rows.ids))
        labels = anchors.labels[some]
        cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(some)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = rows.of_label(labels[a])
            at = everything[own] if same_label else np.concatenate([everything[: own.start], everything[own.stop :]])
            if not len(at):
                continue
            scores = looked_up(np.ascontiguousarray(tables[:, :, a:b]), rows.codes[at]).T
            for i, score in zip(some[a:b].tolist(), scores, strict=True):
                spread = rows.residuals[at] * anchors.norms[i]
                score, anchor = score.astype(np.int64), anchors.vectors[i]
                for n, (_, low, high) in enumerate(questions[i].tolist()):
                    kept[i].add(n, *answered(rows, at, score, spread, anchor, kept[i].least(n, low), high, k))

    return blocks.mapInArrow(search, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The first k of all tasks' answers to each question, with their rank."""
    order = Window.partitionBy("anchor", "question").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    rows: DataFrame,
    is_anchor,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    sample_rows: int = 2048,
    round_anchors: int = 1 << 15,
) -> DataFrame:
    """MINED rows: for each anchor and each of its first positives, the first rows of other labels whose score is within
    the given shares of the positive's. ``vector_col`` holds whole numbers as doubles; is_anchor: a condition on the id.
    """
    spark = rows.sparkSession
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    finite = F.forall(vector_col, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    rows = rows.where(usable & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    rows = rows.where(~F.exists("vector", lambda x: F.isnan(x)))
    bounded_batches(spark)
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    path = f"{stage_root(spark)}/tables/negatives-{uuid.uuid4().hex}"
    if width is None:
        return spark.createDataFrame([], MINED)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas()["vector"]  # at most sample_rows rows
    book = Codebook.fitted(matrix(pa.array(sample.tolist(), pa.list_(pa.float64())), int(width)))
    blocks = staged(packed(rows, book), "negatives-rows")
    chosen = rows.where(is_anchor(F.col("id"))).withColumn("anchor", F.monotonically_increasing_id())
    chosen = staged(chosen.withColumn("turn", F.pmod(F.xxhash64("anchor"), F.lit(chosen.count() // round_anchors + 1))), "negatives-anchors")
    turns = sorted(r[0] for r in chosen.select("turn").distinct().collect())
    for turn in turns:
        some = chosen.where(F.col("turn") == turn).orderBy("label", "id", "anchor").toPandas()  # some round_anchors rows
        vectors = matrix(pa.array(some["vector"].tolist(), pa.list_(pa.float64())), book.width)
        anchors = Anchors(some["anchor"].to_numpy(np.int64), some["label"].to_numpy(np.int64), vectors)
        numbers = spark.createDataFrame(some[["anchor", "id"]].astype("int64"), "anchor long, anchor_id long")
        every = [np.array([[0, LOWEST, HIGHEST]])] * len(some)
        # One more than asked for, as an anchor may be among them itself: of its row's copies, one is left out.
        own = spark.createDataFrame(
            [(int(a), int(i), int(s)) for a, i, s in zip(some["anchor"], some["id"], (vectors * vectors).sum(axis=1), strict=True)],
            "anchor long, own_id long, own_score long",
        )
        near = best_of(searched(blocks, anchors, book, True, every, positives + 1), positives + 1).join(own, "anchor")
        near = near.withColumn("copy", F.when((F.col("id") == F.col("own_id")) & (F.col("score") == F.col("own_score")), F.lit(1)).otherwise(0))
        near = near.withColumn("itself", (F.col("copy") == 1) & (F.sum("copy").over(Window.partitionBy("anchor").orderBy("rank")) == 1))
        near = near.where(~F.col("itself")).withColumn("question", F.row_number().over(Window.partitionBy("anchor").orderBy("rank")))
        near = staged(near.where(F.col("question") <= positives).select("anchor", "question", "score", "id"), "negatives-positives")
        asked: dict[int, list] = {int(a): [] for a in anchors.number}
        for r in near.select("anchor", "question", "score").collect():  # positives times round_anchors rows
            s = r["score"]
            asked[r["anchor"]].append((r["question"], -(-s * least_percent // 100), s * most_percent // 100))
        questions = [np.array(sorted(asked[int(a)]), np.int64).reshape(-1, 3) for a in anchors.number]
        below = best_of(searched(blocks, anchors, book, False, questions, negatives), negatives)
        positive = near.select("anchor", "question", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
        out = below.join(positive, ["anchor", "question"]).join(numbers, "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        out.write.mode("append").parquet(path)
    return spark.read.schema(MINED).parquet(path) if turns else spark.createDataFrame([], MINED)
