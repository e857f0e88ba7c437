"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

The rules count words, signs, duplicate lines and words in repeated 3-word windows. The verdict on a document
that the base rules pass is the mean, over its hashed one- and two-token n-grams, of log p(bucket | trusted) -
log p(bucket | raw). Both multinomials have `buckets` outcomes; raw counts cover every document of the table,
trusted counts the documents that are labelled good, of which at most `trusted_rows` (lowest hash of the id) are
used; those whose crc32(id) modulo `held_out` is 0 are left out, so that verdicts can be tested on them. A document is kept if the mean reaches `threshold`; there is no randomness.

Tokens of the n-grams are runs of letters and digits and runs of other signs, lower-cased, so that junk signs glued to
words count for themselves. The two count vectors (`buckets` numbers each) are all that reaches
the driver; they return to the executors as one array literal. Scoring keeps rows in place and shuffles nothing.

Defined results: a null or empty text has no words and fails the base rules; without trusted rows all
weights are 0 and the base rules alone decide; repeated rows get equal verdicts; other columns pass through
(a column named like the output is replaced, names that begin with `__lx_` are reserved); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.native import text_of
from lexispark.session import table


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeated_percent: int = 50
    buckets: int = 10_000
    smoothing: float = 1.0
    threshold: float = -0.35
    trusted_rows: int = 20_000
    held_out: int = 5


SIGNS = r"([^\p{L}\p{N}\s]+)"
SYMBOLS = "[#*$%&|<>]"


def split_words(text: Column) -> Column:
    """The words of a text. White space becomes spaces first: splitting at one fixed sign needs no regular expression."""
    for c in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def tokens(text: Column) -> Column:
    """Runs of letters and digits and runs of other signs, lower-cased."""
    return split_words(F.regexp_replace(F.lower(text), SIGNS, " $1 "))


def unigram(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def bigram(before: Column, token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(before, token), F.lit(buckets)).cast("int")


def ngram_buckets(column: str, buckets: int) -> Column:
    """Buckets of all tokens and of all pairs of neighbours, of which the first has an empty one. column names a token array."""
    t = F.col(column)
    ones = F.transform(t, lambda w: unigram(w, buckets))
    twos = F.transform(t, lambda w, i: bigram(F.when(i > 0, F.get(t, i - 1)).otherwise(""), w, buckets))
    return F.concat(ones, twos)


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> np.ndarray:
    """Weights of the buckets. labels: doc_id, quality; of those with quality 1, at most trusted_rows are used."""
    trusted = (
        labels.filter((F.col("quality") == 1) & (F.crc32(F.col("doc_id").cast("string")) % rules.held_out != 0)).select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.trusted_rows)
        .select(F.col("doc_id").alias("__lx_id"))
    )
    rows = docs.select("doc_id", tokens(text_of()).alias("__lx_tokens")).join(F.broadcast(trusted), F.col("doc_id") == F.col("__lx_id"), "left")
    rows = rows.withColumn("__lx_buckets", ngram_buckets("__lx_tokens", rules.buckets))
    # explode_outer: for explode, the optimizer would derive a filter that evaluates the array once more
    counts = (
        rows.select(F.col("__lx_id").isNotNull().cast("long").alias("good"), F.explode_outer("__lx_buckets").alias("bucket"))
        .filter("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
        .collect()
    )
    raw, good = np.zeros(rules.buckets), np.zeros(rules.buckets)
    for bucket, r, g in counts:
        raw[bucket], good[bucket] = r, g
    if not good.sum():
        return np.zeros(rules.buckets)
    p = (good + rules.smoothing) / (good.sum() + rules.smoothing * rules.buckets)
    q = (raw + rules.smoothing) / (raw.sum() + rules.smoothing * rules.buckets)
    return np.log(p / q)


def annotate(docs: DataFrame, weights: np.ndarray, rules: Rules = Rules(), out: str = "rules") -> DataFrame:
    """Add a struct: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept."""
    own = [c for c in docs.columns if c != out]
    w, n, tri, at = (F.col(f"__lx_{x}") for x in ("words", "n", "tri", "at"))
    lines = F.filter(F.split(text_of(), "\n"), lambda x: x.rlike(r"\S"))
    count = F.size(at)
    twin = lambda k: ((k > 0) & (F.get(at, k - 1)["h"] == F.get(at, k)["h"])) | ((k < count - 1) & (F.get(at, k + 1)["h"] == F.get(at, k)["h"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("covered"))
    table_ = F.lit(np.ascontiguousarray(weights, dtype=np.float64))
    rows = (
        docs.withColumn("__lx_words", split_words(text_of()))
        .withColumns({"__lx_n": F.size("__lx_words").cast("long"), "__lx_chars": F.length(F.array_join("__lx_words", "")).cast("long")})
        .withColumn(
            "__lx_tri",
            F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))))
            .otherwise(F.expr("cast(array() as array<bigint>)")),
        )
        .drop("__lx_words")
        .withColumn(
            "__lx_at",
            F.when(F.size(F.array_distinct(tri)) < F.size(tri), F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
            .otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)")),
        )
        .drop("__lx_tri")
        .withColumn("__lx_starts", F.when(count > 0, F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), count - 1), twin), lambda k: F.get(at, k)["i"]))))
        .withColumn(
            "__lx_repeat",
            F.coalesce(
                F.aggregate(
                    "__lx_starts", start,
                    lambda a, s: F.struct(s.alias("last"), (a["covered"] + F.least(F.lit(3), s - a["last"])).alias("covered")),
                    lambda a: a["covered"],
                ),
                F.lit(0).cast("long"),
            ),
        )
        .drop("__lx_at", "__lx_starts")
        .withColumn("__lx_lines", lines)
    )
    step = lambda a, t: F.struct(
        t.alias("before"), (a["sum"] + F.get(table_, unigram(t, rules.buckets)) + F.get(table_, bigram(a["before"], t, rules.buckets))).alias("sum")
    )
    opening = F.struct(F.lit("").alias("before"), F.lit(0.0).alias("sum"))
    rows = (
        rows.withColumn("__lx_tokens", tokens(text_of()))
        .withColumn("__lx_sum", F.aggregate("__lx_tokens", opening, step, lambda a: a["sum"]))
        .withColumn("__lx_llr", F.when(F.size("__lx_tokens") > 0, F.col("__lx_sum") / (F.size("__lx_tokens") * 2)).otherwise(0.0))
    )
    failed = (n < rules.least_words) | (F.col("__lx_repeat") * 100 > n * rules.most_repeated_percent)
    return rows.select(
        *own,
        F.struct(
            n.alias("n_words"),
            F.col("__lx_chars").alias("word_chars"),
            F.regexp_count(text_of(), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size("__lx_lines") - F.size(F.array_distinct("__lx_lines"))).cast("long").alias("n_dup_lines"),
            F.col("__lx_repeat").alias("n_repeat_words"),
            failed.alias("base_failed"),
            F.col("__lx_llr").alias("llr"),
            (~failed & (F.col("__lx_llr") >= rules.threshold)).alias("kept"),
        ).alias(out),
    )


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    r = annotate(docs, weights)
    return r.select("doc_id", *[f"rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")], F.round("rules.llr", 6).alias("llr"))
