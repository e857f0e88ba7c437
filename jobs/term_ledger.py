"""Keep a ledger of term candidates as documents arrive.

python -m jobs.term_ledger --documents docs.parquet --output ledger --checkpoint ledger-checkpoint [--config FILE]

Reads the Parquet files of `documents` (a file, a folder or a pattern; doc_id, text, lang, other columns are ignored) as a file stream with availableNow: each run takes the files that are new, in batches
of `files_per_batch`, and ends. `output` holds two tables:

deltas/batch=N   the terms of batch N, partitioned by lang and bucket; a batch that is run again overwrites its own folder with the same rows
terms            the ledger, partitioned by lang and bucket: every valid term of up to `longest` words with the number of documents that hold it, the smallest and
                 largest id of those, its status, and the last batch that its partition has taken in

After the stream, each partition of terms that lacks batches is folded with just those and overwritten by itself (dynamic partition overwrite). The mark of what is folded stands in the
partition's rows, so a run that died between any two steps is made good by the next one: a partition that is missing is folded from all deltas. With nothing new nothing is written.

Terms are cut at ASCII white space, edge punctuation goes, and the term rules of the library decide which are valid. Documents are taken as they come: a file that
arrives counts once, a document that is sent twice in two files counts twice. Null or empty texts have no terms; a null or empty lang is `und`; null ids count as documents.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.config import command, options
from lexispark.functions import validity

log = logging.getLogger("term_ledger")

DELTAS = "term string, n_docs long, first_doc long, last_doc long, batch long, lang string, bucket int"
TERMS = "term string, n_docs long, first_doc long, last_doc long, status string, batch long, lang string, bucket int"
WHITE = r"[ \t\n\x0B\f\r]+"
SIGN = r"[^\p{L}\p{N}_ ]"
LEADING, SIGNS_ALONE, TRAILING = rf"(^| ){SIGN}++", rf"(^| ){SIGN}++(?= |\z)", rf"([\p{{L}}\p{{N}}_]){SIGN}++(?= |\z)"


def mine(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """The valid terms of documents: term, n_docs, first_doc, last_doc, lang, bucket.

    Signs at the edges of words are dropped in the whole text, by a few passes, and phrases are put together from a first word without leading and a last word without trailing signs: no
    expression is asked for each phrase. A phrase with a word of signs alone at an edge is a shorter phrase; what is signs and underscores alone is never valid.
    """
    lang = F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("und"))
    whole = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " "))
    rows = docs.select(lang.alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), whole.alias("whole"))
    rows = rows.withColumns({"opened": F.regexp_replace("whole", LEADING, "$1"), "closed": F.regexp_replace(F.regexp_replace("whole", SIGNS_ALONE, "$1"), TRAILING, "$1")})
    words = lambda c: F.transform(F.split(c, " "), lambda w: F.nullif(w, F.lit("")))
    rows = rows.select("lang", "doc_id", F.split("whole", " ").alias("words"), words("opened").alias("first"), words("closed").alias("last"), words(F.regexp_replace("opened", TRAILING, "$1")).alias("single"))
    # a null word, also one behind the last, makes the phrase null
    grams, run = [F.col("single")], F.col("first")
    for k in range(2, longest + 1):
        after = lambda c: F.slice(c, k, F.greatest(F.size("words"), F.lit(1)))  # noqa: B023, E731
        grams.append(F.zip_with(run, after("last"), lambda g, w: F.concat(g, F.lit(" "), w)))
        run = F.zip_with(run, after("words"), lambda g, w: F.concat(g, F.lit(" "), w))
    phrases = F.array_distinct(F.transform(F.concat(*grams), lambda g: F.btrim(g, F.lit("_"))))
    # explode_outer: for explode, the optimizer would derive a filter that makes the phrases once more
    rows = rows.select("lang", "doc_id", F.explode_outer(phrases).alias("term")).filter("term <> ''")
    # the rules are asked once for each distinct term: without n_docs in it, the optimizer would put the condition before the count, where each phrase of each text is asked
    found = rows.groupBy("lang", "term").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    bucket = (F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("int") % buckets).cast("int")
    return found.filter(F.when(F.col("n_docs") > 0, validity.is_valid(F.col("term")))).withColumn("bucket", bucket)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the output; no rows where it hasn't been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish(spark: SparkSession, output: str, least_docs: int) -> int:
    """Fold the deltas that partitions of the ledger lack; returns how many partitions were written."""
    where = ["lang", "bucket"]
    deltas, terms = read(spark, f"{output}/deltas", DELTAS), read(spark, f"{output}/terms", TERMS)
    marks = terms.groupBy(*where).agg(F.max("batch").alias("mark"))
    newest = deltas.groupBy(*where).agg(F.max("batch").alias("newest"))
    # a row for each language and bucket: its number is bounded by the partitioning
    stale = newest.join(marks, where, "left").filter("mark IS NULL OR newest > mark").select(*where, F.coalesce("mark", F.lit(-1)).alias("mark"), "newest").collect()
    if not stale:
        log.info("terms: nothing new in %s", output)
        return 0
    stale = spark.createDataFrame(stale, "lang string, bucket int, mark long, newest long")
    columns = [*where, "newest", "term", "n_docs", "first_doc", "last_doc"]
    new = deltas.join(F.broadcast(stale), where).filter("batch > mark").select(*columns)
    old = terms.join(F.broadcast(stale), where).select(*columns)
    folded = old.unionByName(new).groupBy(*where, "newest", "term").agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc"))
    status = F.when(F.col("n_docs") >= least_docs, "needs_review").otherwise("rare")
    rows = folded.select("term", "n_docs", "first_doc", "last_doc", status.alias("status"), F.col("newest").alias("batch"), *where)
    # rebalance: about a file for each partition, several for a large one
    rows.hint("rebalance", *where).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*where).parquet(f"{output}/terms")
    n = stale.count()
    log.info("terms: %d partitions written below %s/terms", n, output)
    return n


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, files_per_batch: int = 1000, longest: int = 2, buckets: int = 16, least_docs: int = 3) -> None:
    """Take in the files that are new below documents, and bring the ledger up to date. buckets must stay what they were in the first run."""
    schema = spark.read.parquet(documents).select("doc_id", "text", "lang").schema

    def take(batch: DataFrame, number: int) -> None:
        path = f"{output}/deltas/batch={number}"
        mine(batch, longest, buckets).write.mode("overwrite").partitionBy("lang", "bucket").parquet(path)
        log.info("batch %d: %d terms written to %s", number, spark.read.schema("term string, lang string, bucket int").parquet(path).count(), path)

    # as a pattern, for a file stream takes no single file by its plain path
    found = documents.rstrip("/")
    found = found if any(c in found for c in "*?[{") else f"{found[:-1]}[{found[-1]}]"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(found)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d rows of new files in %s", sum(p.numInputRows for p in query.recentProgress), documents)
    publish(spark, output, least_docs)


def main(argv: list[str] | None = None) -> None:
    command("term_ledger", run, options(__doc__.splitlines()[0], "term_ledger.json", argv))


if __name__ == "__main__":
    main()
