"""Stupid-backoff scores of documents against n-gram counts of the whole corpus.

S(w | context) is count(context w) / count(context) where the n-gram was seen at least `least_count` times, and else
`alpha` times the score with a shorter context; for one word it is count(w) / all words. A document's score is the sum of
the natural logs over its words, the first words with the context they have.

Texts are packed into batches of some MB. A batch's distinct n-grams of all orders are keys of one key space (an n-gram's length is part of its hash);
the count table is partitioned by key range into buckets. Three steps, each a relation in a table or shuffle:
requests (bucket, batch, keys with their counts in the batch); the count table of a bucket, summed from its requests and joined back to
them (batch, bucket, totals); and answers joined to their batch, where n-grams are exploded again and scored, and
scores summed per document. A batch asks once for an n-gram however often it occurs, so a frequent n-gram is
no hot key: a bucket gets at most one request per batch for it. Sorted keys travel as differences
and answers in the order of the requests, about 4.5 bytes a key and less than one an answer, and a cell (batch, bucket) is one row with two blobs.

What travels follows the distinct n-grams of the batches, not the cells: a cell is sent only where a batch has keys in a bucket. A row for each
n-gram instead (key, batch, count) takes over twice the bytes; see the README.

Memory: a bucket holds about `bucket_keys` keys (the number of buckets follows from the size of the corpus), a batch about
`batch_bytes` of text. Batches are written to the shared folder, so no later loss repeats the packing.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Two n-grams that share a key of 56 bits count together; among 10^9 distinct
ones that holds for 1 in 70 million, among 10^12 for 1 in 70,000.

Defined results: a null text is empty; a text without words has score 0 and no mean; repeated rows are rows of
their own and all count; ids may be null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import Slice, mix, utf8
from lexispark.session import scratch_table, table


@dataclass(frozen=True)
class Backoff:
    """batch_bytes and bucket_keys bound the memory of a task; the requests have batches times buckets cells at most.

    For over some 10 TB of text, raise both (64 MB and 40 million keys, for tasks of some 3 GB), so that cells stay filled.
    """

    order: int = 3
    alpha: float = 0.4
    least_count: int = 2
    batch_bytes: int = 8 << 20
    bucket_keys: int = 4_000_000


_KEY_BITS = 56
#: One context per worker process: making one costs more than squeezing a cell.
_PACK, _PACK_TEXT, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()


def _squeeze(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as compressed byte planes; small numbers leave empty planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return _PACK.compress(planes.tobytes())


def _expand(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNPACK.decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


PACKED = "batch long, ids array<long>, lengths array<long>, texts binary, words long"


def pack(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) into batches of about `most` bytes."""
    ids, lengths, texts, size, serial = [], [], [], 0, 0

    def flush() -> pa.RecordBatch:
        data = b"".join(texts)
        part = Slice(0, np.frombuffer(data, dtype=np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), True)
        number = (TaskContext.get().partitionId() << 32) + serial
        row = [[number], [ids], [lengths], [_PACK_TEXT.compress(data)], [len(part.words()[0])]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["batch", "ids", "lengths", "texts", "words"])

    for b in batches:
        column = utf8(b.column(1))
        for doc, text in zip(b.column(0).to_pylist(), column.to_pylist(), strict=True):
            raw = (text or "").encode()
            ids.append(doc), lengths.append(len(raw)), texts.append(raw)
            size += len(raw)
            if size >= most:
                yield flush()
                ids, lengths, texts, size, serial = [], [], [], 0, serial + 1
    if ids:
        yield flush()


def ngrams(lengths: list[int], texts: bytes, order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The document of each word, and per order n: (word that ends the n-gram, key)."""
    data = np.frombuffer(_UNPACK.decompress(texts), dtype=np.uint8)
    part = Slice(0, data, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), True)
    starts, ends, doc = part.words()
    word = part.hashes(starts, ends)
    del starts, ends, part
    out, key, at = [], word, np.arange(len(word))
    for n in range(order):
        if n:
            keep = doc[at] == doc[at - n] if len(at) else np.zeros(0, dtype=bool)
            keep &= at >= n
            at, key = at[keep], key[keep]
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + word[at - n] + np.uint64(n))
        out.append((at, key >> np.uint64(64 - _KEY_BITS)))
    return doc, out


REQUESTS = "bucket int, batch long, keys binary, counts binary"


def _requests(order: int, buckets: int):
    edges = np.array([(k << _KEY_BITS) // buckets for k in range(1, buckets)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, lengths, texts in zip(b.column("batch").to_pylist(), b.column("lengths").to_pylist(), b.column("texts").to_pylist(), strict=True):
                keys, counts = np.unique(np.concatenate([key for _, key in ngrams(lengths, texts, order)[1]]), return_counts=True)
                cut = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                filled = np.flatnonzero(np.diff(cut))
                each = [(_squeeze(np.diff(keys[cut[k] : cut[k + 1]], prepend=np.uint64(0))), _squeeze(counts[cut[k] : cut[k + 1]])) for k in filled]
                row = [pa.array(filled, pa.int32()), pa.array([number] * len(filled), pa.int64()), pa.array([k for k, _ in each], pa.binary()), pa.array([n for _, n in each], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["bucket", "batch", "keys", "counts"])

    return run


def _answers(requests: pa.Table) -> pa.Table:
    """The count table of a bucket, joined to what each batch asked of it."""
    each = [np.cumsum(_expand(k), dtype=np.uint64) for k in requests.column("keys").to_pylist()]
    counts = np.concatenate([_expand(c) for c in requests.column("counts").to_pylist()])
    cut = np.cumsum([0, *map(len, each)])
    asked = np.concatenate(each)
    del each
    order = np.argsort(asked, kind="stable")
    first = np.ones(len(asked), dtype=bool)
    np.not_equal(asked[order[1:]], asked[order[:-1]], out=first[1:])
    del asked
    total = np.empty(len(order), dtype=np.uint64)
    total[order] = np.add.reduceat(counts[order], np.flatnonzero(first))[np.cumsum(first) - 1]
    totals = [_squeeze(total[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table({"batch": requests.column("batch"), "bucket": requests.column("bucket"), "totals": pa.array(totals, pa.binary())})


def _scores(model: Backoff, all_words: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids, lengths = texts.column("ids")[0].as_py(), texts.column("lengths")[0].as_py()
        doc, found = ngrams(lengths, texts.column("texts")[0].as_py(), model.order)
        blobs = answers.sort_by("bucket").column("totals").to_pylist()
        totals = np.concatenate([np.zeros(0, dtype=np.uint64), *map(_expand, blobs)])
        counts = totals[np.unique(np.concatenate([key for _, key in found]), return_inverse=True)[1]].astype(np.float64)
        log_s, shorter, taken = np.zeros(len(doc)), None, 0
        for n, (at, _) in enumerate(found):
            count = counts[taken : taken + len(at)]
            taken += len(at)
            if n == 0:
                log_s = np.log(count / all_words) if len(count) else log_s
            else:
                seen = count >= model.least_count
                context = shorter[at - 1]
                log_s[at] = np.where(seen, np.log(count / np.where(seen, context, 1.0)), np.log(model.alpha) + log_s[at])
            shorter = np.ones(len(doc))
            shorter[at] = count
        sums = np.bincount(doc, weights=log_s, minlength=len(ids))
        words = np.bincount(doc, minlength=len(ids))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words, pa.int64()), "log_score": pa.array(sums, pa.float64())})

    return run


def score(docs: DataFrame, model: Backoff = Backoff()) -> DataFrame:
    """doc_id, n_words, log_score for each row of docs, counted and scored over all of docs."""
    packed = scratch_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda rows: pack(rows, model.batch_bytes), PACKED), "lm-batches")
    all_words = int(packed.agg(F.sum("words")).first()[0] or 0)
    buckets = max(1, -(-all_words * model.order // model.bucket_keys))
    requests = packed.select("batch", "lengths", "texts").mapInArrow(_requests(model.order, buckets), REQUESTS)
    answers = requests.groupBy("bucket").applyInArrow(_answers, "batch long, bucket int, totals binary")
    return (
        packed.groupBy("batch").cogroup(answers.groupBy("batch"))
        .applyInArrow(_scores(model, all_words), "doc_id long, n_words long, log_score double")
    )


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs).select(
        "doc_id", "n_words",
        F.round("log_score", 4).alias("log_score"),
        F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6)).alias("mean_log_score"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
w AS (SELECT k, unnest(ws) AS w3, generate_subscripts(ws, 1) AS i FROM d),
g AS (
  SELECT *, lag(w3, 1) OVER (PARTITION BY k ORDER BY i) AS w2, lag(w3, 2) OVER (PARTITION BY k ORDER BY i) AS w1 FROM w
),
c1 AS (SELECT w3 AS x, count(*)::DOUBLE AS c FROM g GROUP BY 1),
c2 AS (SELECT w2 AS x, w3 AS y, count(*)::DOUBLE AS c FROM g WHERE w2 IS NOT NULL GROUP BY 1, 2),
c3 AS (SELECT w1 AS x, w2 AS y, w3 AS z, count(*)::DOUBLE AS c FROM g WHERE w1 IS NOT NULL GROUP BY 1, 2, 3),
s AS (
  SELECT g.k,
         CASE WHEN c3.c >= 2 THEN ln(c3.c / ctx.c)
              WHEN b.c >= 2 THEN ln(b.c / p.c) + CASE WHEN g.i >= 3 THEN ln(0.4::DOUBLE) ELSE 0 END
              ELSE ln(u.c / (SELECT count(*) FROM w)::DOUBLE)
                   + CASE WHEN g.i >= 2 THEN ln(0.4::DOUBLE) ELSE 0 END + CASE WHEN g.i >= 3 THEN ln(0.4::DOUBLE) ELSE 0 END
         END AS l
  FROM g JOIN c1 u ON u.x = g.w3
  LEFT JOIN c1 p ON p.x = g.w2
  LEFT JOIN c2 b ON b.x = g.w2 AND b.y = g.w3
  LEFT JOIN c2 ctx ON ctx.x = g.w1 AND ctx.y = g.w2
  LEFT JOIN c3 ON c3.x = g.w1 AND c3.y = g.w2 AND c3.z = g.w3
),
t AS (SELECT k, count(*)::BIGINT AS n, sum(l) AS l FROM s GROUP BY k)
SELECT d.doc_id, coalesce(t.n, 0)::BIGINT AS n_words, round(coalesce(t.l, 0), 4) AS log_score, round(t.l / t.n, 6) AS mean_log_score
FROM d LEFT JOIN t ON t.k = d.k
"""
