"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is one pass: each task keeps a count vector for each language and emits its non-zero cells, which are summed
before and after one shuffle. The model is a matrix of (features, languages) log probabilities, of fixed feature count,
so the broadcast is of 256 KiB for each language that was learned. Scoring takes batches of texts as sparse rows of feature positions.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was
learned; rows with null language teach nothing; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm._common import bounded_batches, scanned, staged
from siltbed.llm.ngrams import chunked, hashed

SIZES, BITS = (1, 2, 3), 16
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; digits in superscript, fractions and numerals pass the pattern but are none."""
    found = LETTER.search(text)
    return bool(found) and (found[0].isalpha() or any(map(str.isalpha, text)))


class LanguageModel:
    """languages: sorted values; weights: (2**BITS + 1, languages) with a zero row for no n-gram; prior: log shares."""

    def __init__(self, languages: list[str], weights: np.ndarray, prior: np.ndarray):
        self.languages, self.weights, self.prior = languages, weights, prior

    def predict(self, texts) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        for first, run in chunked([(t or "").lower() for t in texts]):
            features, starts = hashed(run, SIZES, BITS)
            sums = np.zeros((len(run), len(self.languages))) + self.prior
            for row in features:
                sums += np.add.reduceat(self.weights[row], starts[:-1], axis=0, dtype=np.float64)
            best = sums.argmax(axis=1)
            share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for i, t in enumerate(run):
                if has_letter(t):
                    names[first + i], scores[first + i] = self.languages[best[i]], float(share[i])
        return names, scores


def learn(docs: DataFrame, text_col="text", lang_col="lang", smoothing: float = 0.5):
    """A LanguageModel of all rows of ``docs`` that have a language."""
    bounded_batches(docs.sparkSession)
    source = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                total = counts.setdefault(lang, np.zeros((1 << BITS) + 1, np.int64))
                rows[lang] = rows.get(lang, 0) + len(texts)
                for _, run in chunked([(t or "").lower() for t in texts]):
                    total += np.bincount(hashed(run, SIZES, BITS)[0].ravel(), minlength=len(total))
        for lang, total in counts.items():
            some = np.flatnonzero(total[:-1])
            yield pd.DataFrame({"lang": lang, "feature": some, "n": total[some]})
            yield pd.DataFrame({"lang": [lang], "feature": [-1], "n": [rows[lang]]})

    cells = source.mapInPandas(count, "lang string, feature long, n long")
    cells = staged(cells.groupBy("lang", "feature").agg(F.sum("n").alias("n")), "langid-counts")
    priors = {r["lang"]: r["n"] for r in cells.where("feature < 0").collect()}  # a row a language
    languages = sorted(priors)
    if not languages:
        return LanguageModel([], np.zeros(((1 << BITS) + 1, 0), np.float32), np.zeros(0))
    found = cells.where("feature >= 0").toPandas()  # at most 2**BITS rows a language
    counts = np.zeros((1 << BITS, len(languages)))
    counts[found["feature"], found["lang"].map({x: i for i, x in enumerate(languages)})] = found["n"]
    weights = np.zeros(((1 << BITS) + 1, len(languages)), np.float32)
    weights[:-1] = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts)))
    prior = np.log(np.array([priors[x] for x in languages], float) / sum(priors.values()))
    return LanguageModel(languages, weights, prior)


def identify(docs: DataFrame, model: LanguageModel, id_col="doc_id", text_col="text") -> DataFrame:
    """id, lang_pred, score (the posterior of the predicted language) for each row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = {"lang_pred": "string", "score": "double"}
    return scanned(docs, text_col, [id_col], added, lambda texts: shared.value.predict(texts))
