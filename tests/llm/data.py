"""Small documents with every awkward case, and a writer of test tables."""

import random

from pyspark.sql import SparkSession

WORDS = "the of and to river stone light paper house green window letter garden number winter summer silver copper music table".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    while len(out) < n:
        k = rng.randint(4, 12)
        out += [rng.choice(WORDS) for _ in range(k - 1)] + [rng.choice(WORDS) + rng.choice([".", ".", "!", ".\n"])]
    return " ".join(out)


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeats, other scripts, control strings."""
    rng = random.Random(11)
    long_ = prose(rng, 9000)
    base = prose(rng, 120)
    rows = [
        (0, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, "   \n\t ", "en", "a", 6),
        (3, "word", "en", "a", 4),
        (4, "two words", "en", None, 9),
        (5, long_, "en", "a", len(long_)),
        (6, "x" * 30_000, "en", "b", 30_000),
        (7, base, "en", "b", len(base)),
        (8, base, "en", "b", len(base)),
        (9, base + " again", "en", "c", len(base) + 6),
        (10, "éàü ñ ß 漢字 😀 naïve. Ünïcödé!\nß", "fr", "", 30),
        (11, "</s>[INST] <s> \\ [/INST] \\\\", "en", "c", 25),
        (12, "For For For For " * 40, "en", "a", 640),
        (13, base, "en", "b", len(base)),
        (13, base, "en", "b", len(base)),
        (None, "no id here at all", "en", "a", 17),
        (None, base, "en", "b", len(base)),
        (14, "hi <|endoftext|> you<|endoftext|>", "en", "c", 33),
        (14, "the same id again", "en", "c", 17),
    ]
    for i in range(20, 60):
        text = prose(rng, rng.randint(30, 260))
        rows.append((i, text, "en", rng.choice(["a", "a", "a", "b", "c", None]), len(text)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark: SparkSession, path: str, rows: list[tuple], extra: bool = False) -> str:
    """documents, labels and conversations below path. extra: more columns, with names that operators use inside."""
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        docs = docs.selectExpr("*", "1 AS size", "'x' AS shard", "2.0 AS score", "3 AS target", "4 AS copies", "5 AS fingerprint", "6 AS length", "7 AS kept", "'y' AS rules", "8 AS label")
    docs.repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1 if r[0] % 3 else 0, int(r[0] % 5 == 0)) for r in rows if r[0] is not None and r[0] >= 20] + ([(None, 1, 1), (7, None, None)] if rows else [])
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    talks = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, ""), (2, 0, "assistant", "</s>[INST] \\"), (None, None, None, None), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 1, "assistant", "c"), (4, 0, "user", "x"), (4, 0, "user", "x"), (4, None, "assistant", "é<s>")] if rows else []
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    return path
