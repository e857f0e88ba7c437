"""Alignment of source terms with target phrases by the cosine of their vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions.text import target_phrases
from lexispark.operators import nearest

#: n-grams whose hashes a worker keeps.
PLACES = 1 << 18
#: From the terms and the phrases of a row (arrays of text) and a threshold to what aligns: an array of (source_term, target_term, similarity).
Encoder = Callable[[Column, Column, float], Column]
FOUND = "array<struct<source_term:string,target_term:string,similarity:double>>"


def by_vectors(vectors: Callable[[list[str]], np.ndarray]) -> Encoder:
    """An encoder from a function that gives texts (a list) vectors of length 1 (rows). Each different text of a row is encoded once; a row is worked off at a time."""
    kind = pa.list_(pa.struct([("source_term", pa.string()), ("target_term", pa.string()), ("similarity", pa.float64())]))

    def near(terms: list[str] | None, phrases: list[str] | None, threshold: float) -> list[dict]:
        if not terms or not phrases:
            return []
        numbers = {t: i for i, t in enumerate(dict.fromkeys([*terms, *phrases]))}
        held = vectors(list(numbers)).astype(np.float32).astype(np.float64)
        a, b = (held[[numbers[t] for t in some]] for some in (terms, phrases))
        out = []
        for at in range(0, len(a), 256):
            similarity = a[at : at + 256] @ b.T
            out += [{"source_term": terms[at + i], "target_term": phrases[j], "similarity": float(similarity[i, j])} for i, j in zip(*np.nonzero(similarity >= threshold), strict=True)]
        return out

    def encoder(terms: Column, phrases: Column, threshold: float) -> Column:
        def run(a: pa.Array, b: pa.Array) -> pa.Array:
            parts = [pa.array([near(a[i].as_py(), b[i].as_py(), threshold)], kind) for i in range(len(a))]
            return pa.concat_arrays([pa.array([], kind), *parts])

        return F.arrow_udf(run, FOUND)(terms, phrases)

    return encoder


def hashing_encoder(dimensions: int = 64, longest: int = 4) -> Encoder:
    """Vectors of hashed character n-grams, of length 1. It needs no model; equal texts get equal vectors."""
    import xxhash

    places: dict[str, tuple[int, float]] = {}  # of n-grams that a worker met; it starts anew when it is full

    def place(gram: str) -> tuple[int, float]:
        if len(places) >= PLACES:
            places.clear()
        h = xxhash.xxh64_intdigest(gram)
        return places.setdefault(gram, (h % dimensions, 1.0 if h >> 63 else -1.0))

    def vectors(texts: list[str]) -> np.ndarray:
        at, sign, counts = [], [], []
        for text in texts:
            padded, before = f" {text.lower()} ", len(at)
            for n in range(2, longest + 1):
                for i in range(len(padded) - n + 1):
                    gram = padded[i : i + n]
                    where, s = places.get(gram) or place(gram)
                    at.append(where)
                    sign.append(s)
            counts.append(len(at) - before)
        rows = np.repeat(np.arange(len(texts)), counts)
        out = np.bincount(rows * dimensions + np.array(at, dtype=np.int64), np.array(sign), len(texts) * dimensions).reshape(len(texts), dimensions)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)

    return by_vectors(vectors)


def align(terms: DataFrame, targets: DataFrame, key: str, encoder: Encoder, threshold: float = fixed.ALIGN_SIMILARITY) -> DataFrame:
    """Term and phrase pairs of one text pair whose cosine reaches the threshold.

    terms: key, source_term; targets: key, target_text. Many phrases may align with a term.

    The terms of a pair meet its target in one row, and its phrases are made and encoded there. Vectors are neither shuffled nor joined: those of all phrases take over a hundred times the targets,
    and a join by phrase may be planned as a broadcast, as the size of an array column isn't known before it is made.
    """
    asked = terms.filter(F.col("source_term").isNotNull()).groupBy(key).agg(F.collect_list("source_term").alias("__terms"))
    rows = asked.hint("shuffle_hash").join(targets.select(key, "target_text"), key)
    # by number: the rows are few bytes but make many phrases each, so they must not be put together into few tasks
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    # explode_outer and a filter: see the README
    found = rows.select(key, F.explode_outer(encoder(F.col("__terms"), target_phrases(F.col("target_text")), threshold)).alias("__f")).filter("__f IS NOT NULL")
    return found.select(key, "__f.source_term", "__f.target_term", "__f.similarity")


def best(alignments: DataFrame, key: str) -> DataFrame:
    """The closest phrase of each term; the first in code-point order on ties."""
    first = F.min_by(F.struct("target_term", "similarity"), F.struct(-F.col("similarity"), F.col("target_term")))
    return alignments.groupBy(key, "source_term").agg(first.alias("b")).select(key, "source_term", "b.target_term", "b.similarity")


def near_pairs(vectors: DataFrame, key: str, group: str, threshold: float) -> DataFrame:
    """Pairs of vectors that share a group and whose cosine reaches the threshold."""
    return nearest.pairs_in_groups(vectors, key, group, threshold)


def all_pairs(vectors: DataFrame, key: str, threshold: float, block: int = nearest.BLOCK) -> DataFrame:
    """id_a, id_b, similarity of all pairs of vectors whose cosine, rounded to six places, reaches the threshold, with id_a < id_b; see `nearest.similar_pairs`."""
    return nearest.similar_pairs(vectors, key, threshold, block=block)
