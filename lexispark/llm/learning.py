"""What the two trained operators share: the bounded training sample and where models are fitted."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import release, utf8


#: Bytes of text of a training sample at most, of either class half of them.
SAMPLE_BYTES = 128 << 20
#: A text of more than this share of its class's bytes isn't used to train.
LARGEST_SHARE = 1 / 2


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, positives: int, negatives: int, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, text, label of at most positives + negatives labelled documents and most_bytes of text.

    Rows whose crc32 of the id is held_out modulo modulus are left out. Of each class, the documents with the lowest
    hash of the id are taken until rows or bytes are full; where rows share an id, one text of the least hash is. A text of over LARGEST_SHARE of its class's bytes
    (32 MB with the bound of 128 MB) leaves itself out and none after it. So the sample depends on the table alone. Its ids are bounded in number and broadcast.
    """
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out)
        .groupBy(F.col("doc_id").alias("__lx_id")).agg(F.max(label).cast("int").alias("__lx_label"))
    )
    order = [F.xxhash64("__lx_id"), F.col("__lx_id")]
    ids = [usable.filter(F.col("__lx_label") == y).orderBy(*order).limit(n) for y, n in ((1, positives), (0, negatives))]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__lx_hash"))
    found = rows.join(F.broadcast(ids[0].union(ids[1])), F.col("doc_id") == F.col("__lx_id"))
    sizes = found.groupBy("__lx_id", "__lx_label").agg(F.min(F.struct(F.col("__lx_hash"), F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))).alias("__lx_least"))
    upto = Window.partitionBy("__lx_label").orderBy(*order)
    sizes = sizes.filter(F.col("__lx_least.bytes") <= int(most_bytes // 2 * LARGEST_SHARE))
    chosen = sizes.withColumn("__lx_bytes", F.sum("__lx_least.bytes").over(upto)).filter(F.col("__lx_bytes") <= most_bytes // 2)
    chosen = F.broadcast(chosen.select(F.col("__lx_id").alias("__lx_i"), F.col("__lx_least.__lx_hash").alias("__lx_h"), "__lx_label"))
    texts = rows.join(chosen, (F.col("doc_id") == F.col("__lx_i")) & (F.col("__lx_hash") == F.col("__lx_h")))
    return texts.groupBy("doc_id", F.col("__lx_label").alias("label")).agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def fit_in_task(sample: DataFrame, fit: Callable[[list[int], pa.Array, np.ndarray], np.ndarray]) -> np.ndarray:
    """Fit a model on the bounded sample in one task of an executor; only its weights reach the driver."""

    def run(batches):
        got = [b for b in batches if b.num_rows]
        rows = pa.Table.from_batches(got).sort_by([("doc_id", "ascending"), ("label", "ascending")]) if got else None
        if rows is None or len(set(rows.column("label").to_pylist())) < 2:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary())], ["model"])
            return
        ids, texts, labels = rows.column("doc_id").to_pylist(), utf8(rows.column("text")), rows.column("label").to_numpy().astype(np.float64)
        del got, rows  # one copy of the texts is enough while the model is fitted
        weights = fit(ids, texts, labels)
        del ids, texts, labels
        release()
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary())], ["model"])

    got = [r[0] for r in sample.repartition(1).mapInArrow(run, "model binary").collect() if r[0] is not None]
    return np.frombuffer(bytes(got[0]), dtype=np.float32) if got else np.zeros(0, dtype=np.float32)
