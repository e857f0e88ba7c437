"""Boolean trigram queries of regular expressions, and the postings of trigrams.

A query says which trigrams a text must hold to match at all. It is an OR of ANDs: a set of clauses, each a set of
trigrams; the clause without trigrams holds for every text. Trigrams are three bytes of UTF-8 with A-Z lower-cased, as one integer. Queries are
derived from the parsed expression: where it can only match a few strings, their trigrams are mandatory; alternatives are joined by OR, what follows each
other by AND; classes of many signs, open repetitions' further rounds, references and look-arounds demand nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import slices
from lexispark.llm.native import text_of

Query = frozenset[frozenset[int]]
#: Holds for every text.
ALL: Query = frozenset([frozenset()])
#: Strings that a part of an expression is listed as at most, and clauses of a query; beyond, less is demanded.
MOST_STRINGS, MOST_CLAUSES = 64, 64
#: Trigrams of a clause; a clause's postings are tallied in the bits of a long.
MOST_TERMS = 62
#: Bytes of a text whose trigrams are held together.
WINDOW = 1 << 20


def _fold(text: str) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())


def _clause(text: str) -> frozenset[int]:
    b = _fold(text)
    return frozenset(b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2))


def _either(queries) -> Query:
    clauses = frozenset().union(*queries)
    least = frozenset(c for c in clauses if not any(d < c for d in clauses))
    return least if len(least) <= MOST_CLAUSES else ALL


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_CLAUSES:
        return min(a, b, key=lambda q: (q == ALL, len(q)))
    return _either([frozenset(x | y for x in a for y in b)])


def _demand(strings: set[str]) -> Query:
    return _either([frozenset(_clause(s) for s in strings)])


def _sequence(parts) -> tuple[set[str] | None, Query]:
    """The strings that parts in a row match, or None and what they demand."""
    run, query, listed = {""}, ALL, True
    for strings, demanded in parts:
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        query, listed = _both(query, _demand(run)), False
        run = {""} if strings is None else strings
        query = _both(query, demanded) if strings is None else query
    return (run, ALL) if listed else (None, _both(query, _demand(run)))


def _signs(items) -> set[str] | None:
    """The signs of a class, lower-cased, if they are few."""
    out: set[str] = set()
    for what, value in items:
        if what is op.LITERAL:
            out.add(chr(value).lower() if value < 128 else chr(value))
        elif what is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            out |= {chr(c).lower() if c < 128 else chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
        if len(out) > MOST_STRINGS:
            return None
    return out


def _part(what, value) -> tuple[set[str] | None, Query]:
    if what is op.LITERAL:
        return _signs([(what, value)]), ALL
    if what is op.IN:
        return _signs(value), ALL
    if what is op.SUBPATTERN:
        return _sequence(_part(*x) for x in value[3])
    if what is op.BRANCH:
        found = [_sequence(_part(*x) for x in branch) for branch in value[1]]
        if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST_STRINGS:
            return set().union(*(s for s, _ in found)), ALL
        return None, _either([q if s is None else _demand(s) for s, q in found])
    if what in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        strings, demanded = _sequence(_part(*x) for x in inner)
        if low == 0:
            return (strings | {""}, ALL) if high == 1 and strings is not None else (None, ALL)
        if strings is None:
            return None, demanded
        rounds = 1
        while rounds < min(low, 8) and len(strings) ** (rounds + 1) <= MOST_STRINGS:
            rounds += 1
        listed, demanded = _sequence([(strings, ALL)] * rounds)
        return (listed, ALL) if rounds == low == high else (None, _demand(listed))
    if what in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, ALL
    return None, ALL


def query_of(pattern: str) -> Query:
    """The clauses of which every match of a pattern (flag ASCII) meets one; ALL if it has no mandatory trigram."""
    strings, demanded = _sequence(_part(*x) for x in _parser.parse(pattern, re.ASCII))
    query = demanded if strings is None else _demand(strings)
    return frozenset(frozenset(sorted(c)[:MOST_TERMS]) for c in query)


def _codes(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, trigram) of folded texts, each once per window."""
    for low in range(0, len(data), WINDOW):
        d = data[low : low + WINDOW + 2].astype(np.int32)
        if len(d) < 3:
            return
        code = d[:-2] << 16 | d[1:-1] << 8 | d[2:]
        at = np.flatnonzero(known[code]) if known is not None else np.arange(len(code))
        owner = np.searchsorted(offsets, at + low, side="right") - 1
        whole = at + low + 2 < offsets[owner + 1]
        pairs = np.unique(owner[whole].astype(np.int64) << 24 | code[at[whole]])
        yield pairs >> 24, (pairs & 0xFFFFFF).astype(np.int32)


def postings(docs: DataFrame, vocabulary: frozenset[int] | None = None) -> DataFrame:
    """trigram, ref: the trigrams of each text, all or those of a vocabulary (bounded by the rules); ref is the 64-bit hash of the text.

    Copies of a text have the same postings, and a pair may come more than once. Texts that share a hash share their postings, which can only make more candidates.
    """
    words = sorted(vocabulary) if vocabulary is not None else None

    def run(batches):
        known = None
        if words is not None:
            known = np.zeros(1 << 24, dtype=bool)
            known[words] = True
        for batch in batches:
            refs = batch.column(0).to_numpy()
            for part in slices(batch.column(1), fold=True):
                for owner, code in _codes(part.data, part.offsets, known):
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(refs[part.first + owner])], ["trigram", "ref"])

    return docs.select(F.xxhash64(text_of()).alias("ref"), text_of().alias("text")).mapInArrow(run, "trigram int, ref long")


def write_index(docs: DataFrame, path: str) -> None:
    """The inverted index of all trigrams as Parquet, sorted by trigram, so that a query reads the row groups of its trigrams only; a common trigram spans many files."""
    postings(docs).distinct().repartitionByRange("trigram", "ref").sortWithinPartitions("trigram", "ref").write.mode("overwrite").parquet(path)


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """ref, rules (sorted numbers): the texts whose postings meet a clause of a rule's query. index: trigram, ref, also with repeats.

    Postings are intersected by a tally of bits per text and clause, which Spark sums up before it shuffles. Rules of query ALL aren't asked here.
    """
    spark = index.sparkSession
    clauses = [(n, rule, t, 1 << k, (1 << len(c)) - 1) for n, (rule, c) in enumerate((r, c) for r, q in sorted(queries.items()) if q != ALL for c in sorted(q, key=sorted)) for k, t in enumerate(sorted(c))]
    asked = spark.createDataFrame(clauses, "clause int, rule int, term int, bit long, full long")
    met = index.join(F.broadcast(asked), F.col("trigram") == F.col("term"))  # as many rows as the rules' clauses have trigrams
    met = met.groupBy("ref", "clause").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"), F.first("rule").alias("rule")).filter("bits = full")
    return met.groupBy("ref").agg(F.array_sort(F.collect_set("rule")).alias("rules"))
