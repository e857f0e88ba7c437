"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence's score is the logistic of a bias and the weights of its hashed features: each word and its first 4 to 8
bytes. A document's score is the noisy-or of its sentences, 1 - prod(1 - p). Only documents have labels; the gradient of
the noisy-or's log-likelihood spreads a label over the sentences, so that the fitted sentence scores locate the
sentences that make a document toxic. Weights are fitted by AdaGrad over mini-batches, of the features whose presence in
a document tells more about its label than chance would for one of all features (`least_evidence`); they start at
`start` times the log ratio of their frequencies in toxic and in other documents.

The model is fitted on a bounded sample of labelled documents (`positives` and `negatives` at most), for `epochs` rounds, or more where those make fewer than
`least_updates` steps; every document is
scored whole. Scoring keeps rows in place and shuffles nothing; the weights (4 MB) are broadcast.

Sentences end at `.`, `!`, `?` or a line's end. Spans are in code points. Defined results: a null or empty text has one empty sentence,
whose score is the logistic of the bias; with no usable labels of both classes every score is 0; repeated rows get equal scores;
other columns pass through (one named like the output is replaced); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import Slice, release, slices
from lexispark.llm.learning import fit_in_task, training_sample
from lexispark.session import table

DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
STOP = np.zeros(256, dtype=bool)
STOP[[10, 33, 46, 63]] = True


@dataclass(frozen=True)
class Training:
    positives: int = 4_000
    negatives: int = 8_000
    epochs: int = 6
    least_updates: int = 600
    batch_bytes: int = 1 << 16
    rate: float = 0.3
    decay: float = 1e-5
    least_evidence: float = 16.0
    start: float = 0.8
    bias: float = -8.0


def features(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: (feature, sentence) pairs, and the text and first byte of each sentence.

    Every text has at least one sentence; sentence numbers rise through the slice.
    """
    n = len(part.data)
    opens = np.zeros(n + 1, dtype=bool)
    opens[1:] = STOP[part.data]
    opens[part.offsets] = True
    first = np.flatnonzero(opens[:n]) if n else np.zeros(0, dtype=np.int64)
    empty = part.offsets[:-1][np.diff(part.offsets) == 0]
    owner = np.concatenate([np.searchsorted(part.offsets, first, side="right") - 1, np.flatnonzero(np.diff(part.offsets) == 0)])
    first = np.concatenate([first, empty])
    order = np.lexsort((first, owner))
    first, owner = first[order], owner[order]
    starts, ends, _ = part.pieces()
    letters = ~STOP[part.data[starts]] if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[letters], ends[letters]
    filled = np.flatnonzero(np.diff(np.append(first, n)) > 0) if len(first) else np.zeros(0, dtype=np.int64)
    sentence = filled[np.searchsorted(first[filled], starts, side="right") - 1] if len(starts) else np.zeros(0, dtype=np.int64)
    ids, where = [part.hashes(starts, ends)], [sentence]
    for k in PREFIXES:
        longer = ends - starts > k
        ids.append(part.hashes(starts[longer], starts[longer] + k) + np.uint64(k))
        where.append(sentence[longer])
    return (np.concatenate(ids) & np.uint64(DIMENSIONS - 1)).astype(np.int64), np.concatenate(where), owner, first


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))


def evidence(with_: np.ndarray, toxic_with: np.ndarray, all_: int, toxic: float) -> np.ndarray:
    """Likelihood ratio statistic of each feature's presence in a document against the label."""
    total = np.zeros(len(with_))
    for a, row, column in (
        (toxic_with, with_, toxic), (with_ - toxic_with, with_, all_ - toxic),
        (toxic - toxic_with, all_ - with_, toxic), (all_ - with_ - toxic + toxic_with, all_ - with_, all_ - toxic),
    ):
        total += a * np.log(np.maximum(a, 1e-9) * all_ / np.maximum(row * column, 1e-9))
    return 2 * total


def fit(texts: pa.Array, label: np.ndarray, how: Training) -> np.ndarray:
    """Weights, the bias last."""
    documents, toxic = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for part in slices(texts, fold=True, limit=how.batch_bytes):
        ids, where, owner, _ = features(part)
        pair = np.unique((owner[where].astype(np.int64) << 20) | ids)
        document, pair = pair >> 20, pair & (DIMENSIONS - 1)
        np.add.at(documents, pair, 1.0)
        np.add.at(toxic, pair, label[part.first + document])
    telling = evidence(documents, toxic, len(label), label.sum()) >= how.least_evidence
    bags = []
    for part in slices(texts, fold=True, limit=how.batch_bytes):  # again: only telling features are held, few of all
        ids, where, owner, _ = features(part)
        told = telling[ids]
        bags.append((ids[told].astype(np.int32), where[told].astype(np.int32), (owner + part.first).astype(np.int32)))
    odds = np.log((toxic + 0.5) / (label.sum() + 1)) - np.log((documents - toxic + 0.5) / (len(label) - label.sum() + 1))
    w, squares, bias, bias_squares = np.where(telling, how.start * odds, 0.0), np.full(DIMENSIONS, 1e-4), how.bias, 1e-4
    rng = np.random.default_rng(7)
    for _ in range(max(how.epochs, how.least_updates // max(len(bags), 1))):
        for k in rng.permutation(len(bags)):
            ids, where, owner = bags[k]
            low = owner.min()
            n = owner.max() - low + 1
            p = _sigmoid(bias + np.bincount(where, weights=w[ids], minlength=len(owner)))
            bag = noisy_or(p, owner - low, n)
            y = label[low : low + n]
            slope = np.where(y > 0, -(1 - bag) / np.maximum(bag, 1e-6), 1.0)[owner - low] * p
            at, back = np.unique(ids, return_inverse=True)
            g = np.bincount(back, weights=slope[where], minlength=len(at)) + how.decay * w[at]
            squares[at] += g * g
            w[at] -= how.rate * g / np.sqrt(squares[at])
            g = slope.sum()
            bias_squares += g * g
            bias -= how.rate * g / np.sqrt(bias_squares)
    return np.append(w, bias)


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> np.ndarray:
    """Fit on labelled rows whose crc32(doc_id) is not 1 modulo 3."""
    sample = training_sample(docs, labels, "toxic", 3, 1, how.positives, how.negatives)
    return fit_in_task(sample, lambda ids, texts, y: fit(texts, y, how))


#: Texts are scored together up to so many bytes; while features are made, about fifty times as much is held.
SCORED_BYTES = 1 << 17
OUT = "score double, sentences int, worst_start long, worst_length long, worst_score double"


def scorer(model: np.ndarray):
    """A function from texts to structs: the noisy-or, the number of sentences and the span of the worst one."""
    kinds = {"score": pa.float64(), "sentences": pa.int32(), "worst_start": pa.int64(), "worst_length": pa.int64(), "worst_score": pa.float64()}

    def run(texts: pa.Array) -> pa.Array:
        got: list[list[np.ndarray]] = [[] for _ in kinds]
        for part in slices(texts, fold=True, limit=SCORED_BYTES):
            ids, where, owner, first = features(part)
            if len(model):
                p = _sigmoid(model[-1] + np.bincount(where, weights=model[ids], minlength=len(owner)))
            else:
                p = np.zeros(len(owner))
            n = part.rows
            worst = np.lexsort((first, -p, owner))[np.searchsorted(owner, np.arange(n))]
            last = np.append(first, len(part.data))[worst + 1]
            last = np.minimum(last, part.offsets[1:])
            chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
            values = (noisy_or(p, owner, n), np.bincount(owner, minlength=n), chars[first[worst]] - chars[part.offsets[:-1]], chars[last] - chars[first[worst]], p[worst])
            for column, v in zip(got, values, strict=True):
                column.append(v)
        arrays = [pa.array(np.concatenate(v) if v else [], t) for v, t in zip(got, kinds.values(), strict=True)]
        del got
        release()
        return pa.StructArray.from_arrays(arrays, names=list(kinds))

    return run


def annotate(docs: DataFrame, model: np.ndarray, out: str = "toxicity") -> DataFrame:
    """Add a struct with the document's score and the place and score of its worst sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    udf = F.arrow_udf(lambda texts: scorer(shared.value)(texts), OUT)
    return docs.withColumn(out, udf(F.coalesce(F.col("text"), F.lit(""))))


def offending(docs: DataFrame, model: np.ndarray, least: float = 0.5) -> DataFrame:
    """doc_id, start, length, score, sentence: every sentence that scores at least so much."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            rows: list[list] = [[] for _ in range(5)]
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for part in slices(texts, fold=True):
                f, where, owner, first = features(part)
                m = shared.value
                p = _sigmoid(m[-1] + np.bincount(where, weights=m[f], minlength=len(owner))) if len(m) else np.zeros(len(owner))
                ends = np.minimum(np.append(first[1:], len(part.data)), part.offsets[owner + 1])
                for s in np.flatnonzero(p >= least):
                    text = texts[part.first + int(owner[s])].as_py().encode()
                    at = part.offsets[owner[s]]
                    before, own = text[: first[s] - at].decode(), text[first[s] - at : ends[s] - at].decode()
                    for column, v in zip(rows, (ids[part.first + int(owner[s])], len(before), len(own), float(p[s]), own), strict=True):
                        column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], ["doc_id", "start", "length", "score", "sentence"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(run, "doc_id long, start long, length long, score double, sentence string")


REJECT_FROM = 0.7


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    s = annotate(docs, model)
    return s.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= REJECT_FROM).cast("int").alias("predicted"),
        "toxicity.sentences", "toxicity.worst_start", "toxicity.worst_length", "toxicity.worst_score",
    )
