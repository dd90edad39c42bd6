"""Language-model scoring by cross-entropy difference.

Two bigram models with one vocabulary, the tokenizer's, and one way of smoothing are counted: the target model over the
rows of a flag column, the background model over all rows. A token's loss is its negative log probability after the
token before it, interpolated with its unigram probability; a document's score is the mean over its tokens, end
included, of target loss minus background loss: the lower, the more like the target.

Tokens are made once and written in *blocks* of documents. A block lists each of its distinct bigrams once, with its
counts in target and in all; these rows are summed into the model, joined with it, and come back to their block, where
the documents are scored with arrays. The model grows with the corpus and never leaves the cluster; only the unigram
counts, bounded by the vocabulary, are collected.

Defined results: null or empty text is the end token alone; a null flag is false; repeated rows count each time; rows of
the target are scored by models that counted them; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm._common import bounded_batches, runs, staged
from siltbed.llm.packing import word_ids

#: Tokens of a block, as long as one document does not have more.
BLOCK_TOKENS = 1_500_000
#: Pseudo-counts of the unigram distribution in each context.
CONTEXT = 16.0


def bigrams(tokens: np.ndarray, end: int) -> np.ndarray:
    """(token before, token) as one number for each token; every document ends with ``end``, which also opens it."""
    before = np.concatenate([[end], tokens[:-1]]).astype(np.int64)
    return (before << 32) | tokens.astype(np.int64)


class Blocks:
    """Tokenised documents in blocks: block, ids, target flags, document ends and tokens (16 bits if the vocabulary allows)."""

    def __init__(self, docs: DataFrame, flag: str, tokenizer: str, end: int, vocabulary: int, id_col: str, text_col: str):
        self.token = token = "<u2" if vocabulary <= 1 << 16 else "<u4"
        bounded_batches(docs.sparkSession)
        source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(flag), F.lit(False)), F.col(text_col).cast("binary"))
        self.id_type, self.end = source.schema["id"].dataType, end
        schema = T.StructType([T.StructField("ids", T.ArrayType(self.id_type))])
        schema = T.StructType(schema.fields + T.StructType.fromDDL("flags array<boolean>, ends binary, tokens binary").fields)

        def make(batches):
            held, size = [], 0
            for batch in batches:
                at, own = 0, batch.select([0, 1])  # the texts are let go
                for run in runs(batch.column(2).to_pylist()):
                    tokens = word_ids(tokenizer).of(run, end)
                    held.append((own.slice(at, len(run)), [t.astype(token) for t in tokens]))
                    size += sum(map(len, tokens))
                    at += len(run)
                    if size >= BLOCK_TOKENS:
                        yield block(held)
                        held, size = [], 0
            if held:
                yield block(held)

        def block(held):
            tokens = [t for _, ts in held for t in ts]
            ids = pa.concat_arrays([b.column(0) for b, _ in held])
            flags = pa.concat_arrays([b.column(1) for b, _ in held])
            one = pa.array([0, len(ids)], pa.int32())
            columns = [
                pa.ListArray.from_arrays(one, ids),
                pa.ListArray.from_arrays(one, flags),
                pa.array([np.cumsum([len(t) for t in tokens], dtype=np.int64).tobytes()], pa.binary()),
                pa.array([np.concatenate(tokens).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["ids", "flags", "ends", "tokens"])

        made = source.mapInArrow(make, schema).withColumn("block", F.monotonically_increasing_id())
        self.table = staged(made, "lm-blocks", compression="zstd")

    def counts(self) -> DataFrame:
        """block, gram, n_all, n_target: each distinct bigram of each block once."""
        end, token = self.end, self.token

        def count(batches):
            for batch in batches:
                for block, flags, ends, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    tokens, ends = np.frombuffer(raw, token), np.frombuffer(ends, np.int64)
                    grams = bigrams(tokens, end)
                    chosen = np.repeat(np.array(flags, bool), np.diff(ends, prepend=0))
                    every, n = np.unique(grams, return_counts=True)
                    some, m = np.unique(grams[chosen], return_counts=True)
                    target = np.zeros(len(every), np.int64)
                    target[np.searchsorted(every, some)] = m
                    columns = [np.full(len(every), block), every, n, target]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "gram", "n_all", "n_target"])

        rows = self.table.select("block", "flags", "ends", "tokens")
        return staged(rows.mapInArrow(count, "block long, gram long, n_all long, n_target long"), "lm-counts", compression="zstd")


def unigrams(model: DataFrame) -> np.ndarray:
    """(token, model) counts; one row for each token of the vocabulary comes to the driver."""
    token = F.col("gram").bitwiseAND(F.lit((1 << 32) - 1)).alias("token")
    rows = model.groupBy(token).agg(F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target")).toPandas()
    out = np.zeros((int(rows["token"].max()) + 1 if len(rows) else 1, 2))
    out[rows["token"]] = rows[["n_all", "n_target"]]
    return out


def score(
    docs: DataFrame,
    flag: str,
    tokenizer: str,
    end: int,
    vocabulary: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_tokens, target_loss, background_loss, score for each row (mean nats a token).

    tokenizer: path of a tokenizer file whose pre-tokens never reach over white space. end: id behind and in front of
    every document. vocabulary: number of ids.
    """
    blocks = Blocks(docs, flag, tokenizer, end, vocabulary, id_col, text_col)
    token = blocks.token
    grams = blocks.counts()
    sums = grams.groupBy("gram").agg(F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target"))
    model = staged(sums, "lm-model", compression="zstd")
    shared = docs.sparkSession.sparkContext.broadcast(unigrams(model))
    answers = grams.select("block", "gram").join(model, "gram")
    fields = [T.StructField("id", blocks.id_type)]
    schema = T.StructType(fields + T.StructType.fromDDL("n_tokens long, target_loss double, background_loss double").fields)

    def losses(tokens: np.ndarray, found: pa.Table) -> list[np.ndarray]:
        """Background and target loss of every token."""
        grams, order = bigrams(tokens, end), np.argsort(found["gram"].to_numpy())
        at = order[np.searchsorted(found["gram"].to_numpy()[order], grams)]
        out = []
        for k, name in enumerate(("n_all", "n_target")):
            single = shared.value[:, k]
            low = (single[tokens] + 1) / (single.sum() + vocabulary)
            # As every document opens and ends with the end token, a token is a context as often as it occurs.
            context = single[grams >> 32]
            out.append(-np.log((found[name].to_numpy()[at] + CONTEXT * low) / (context + CONTEXT)))
        return out

    def judge(key, block, found):
        if not block.num_rows:
            return schema_arrow.empty_table()
        tokens, ends = (np.frombuffer(block[c][0].as_py(), k) for c, k in (("tokens", token), ("ends", np.int64)))
        starts = np.concatenate([[0], ends[:-1]])
        size = ends - starts
        background, target = (np.add.reduceat(x, starts) / size for x in losses(tokens, found))
        ids = block["ids"].combine_chunks().flatten()
        return pa.table([ids, pa.array(size), pa.array(target), pa.array(background)], names=schema.names)

    schema_arrow = pa.schema([(n, pa.int64()) for n in schema.names])
    rows = blocks.table.select("block", "ids", "ends", "tokens")
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, schema)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss")).withColumnRenamed("id", id_col)
