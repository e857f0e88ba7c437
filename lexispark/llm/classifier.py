"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

Words here are runs of letters and digits and runs of other signs (lower-cased), so that junk signs glued to words are words
too. The features of a document are its one- and two-word n-grams, hashed into DIMENSIONS buckets, and two buckets for n-grams
that say a word again, at once or one word later; each has its share of all n-grams times SCALE. A score is the logistic of the sparse dot product; it is computed over whole texts without grouping:
the weights of all n-grams are summed and divided by their number.

The follow-the-regularised-leader state (z, n per bucket) is updated one document at a time, in an order the seed
decides, over a bounded sample of labelled documents. L1 keeps rare n-grams at exactly 0. Weights (2 MB)
are broadcast; scoring keeps rows in place and shuffles nothing.

Defined results: a null or empty text has the bias alone; with no usable labels of both classes every score is 0.5; repeated rows get
equal scores; other columns pass through (one named like the output is replaced); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import Slice, mix, slices
from lexispark.llm.learning import fit_in_task, training_sample
from lexispark.session import table

DIMENSIONS = 1 << 18
SCALE = 10.0


@dataclass(frozen=True)
class Ftrl:
    positives: int = 8_000
    negatives: int = 4_000
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 0.1
    seed: int = 3


def ngrams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all one- and two-word n-grams of a slice and of words said again, and their texts."""
    starts, ends, doc = part.pieces()
    one = part.hashes(starts, ends)
    same = doc[1:] == doc[:-1]
    two = mix(one[:-1] * np.uint64(0xD6E8FEB86659FD93) + one[1:])[same]
    keys, owners = [one, two], [doc, doc[1:][same]]
    for gap in (1, 2):
        again = (one[gap:] == one[:-gap]) & (doc[gap:] == doc[:-gap])
        keys.append(np.full(int(again.sum()), gap, dtype=np.uint64))
        owners.append(doc[gap:][again])
    return (np.concatenate(keys) & np.uint64(DIMENSIONS - 1)).astype(np.int64), np.concatenate(owners)


def fit(texts: pa.Array, label: np.ndarray, how: Ftrl) -> np.ndarray:
    """Weights, the bias last."""
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for part in slices(texts, fold=True):
        keys, doc = ngrams(part)
        pair, count = np.unique((doc << 18) | keys, return_counts=True)
        cut = np.searchsorted(pair >> 18, np.arange(part.rows + 1))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            rows.append(((pair[a:b] & (DIMENSIONS - 1)).astype(np.int32), (SCALE * count[a:b] / max(1, count[a:b].sum())).astype(np.float32)))
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * how.l1 - z[at]
        return np.where(np.abs(z[at]) <= how.l1, 0.0, shrunk / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2))

    rng = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], DIMENSIONS), np.append(rows[i][1], 1.0)
            w = weights(at)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - label[i]) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(DIMENSIONS + 1))


def train(docs: DataFrame, labels: DataFrame, how: Ftrl = Ftrl()) -> np.ndarray:
    """Fit on labelled rows whose crc32(doc_id) is not 0 modulo 5."""
    sample = training_sample(docs, labels, "quality", 5, 0, how.positives, how.negatives)
    return fit_in_task(sample, lambda ids, texts, y: fit(texts, y, how))


def scorer(model: np.ndarray):
    def run(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), 0.5)
        for part in slices(texts, fold=True):
            if len(model):
                keys, doc = ngrams(part)
                total = np.bincount(doc, weights=model[keys], minlength=part.rows)
                count = np.bincount(doc, minlength=part.rows)
                out[part.first : part.first + part.rows] = 1.0 / (1.0 + np.exp(-np.clip(model[-1] + SCALE * total / np.maximum(count, 1), -30, 30)))
        return pa.array(out)

    return run


def annotate(docs: DataFrame, model: np.ndarray, out: str = "quality_score") -> DataFrame:
    """Add the score of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    udf = F.arrow_udf(lambda texts: scorer(shared.value)(texts), "double")
    return docs.withColumn(out, udf(F.coalesce(F.col("text"), F.lit(""))))


KEEP_FROM = 0.3


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = annotate(docs, train(docs, table(spark, sf_dir, "labels")))
    return s.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= KEEP_FROM).cast("int").alias("predicted"),
    )
