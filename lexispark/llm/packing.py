"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become token ids (byte-level BPE) with an end id. Documents longer than a sequence are cut into whole
sequences, the remainder first. What remains to solve is bin packing of integer lengths up to `capacity`, and
documents of one length are interchangeable. So a solution is a list of distinct fillings with multiplicities: its size
depends on the capacity and not on the number of documents, and the histogram of lengths, at most
`capacity` numbers, is all that reaches the driver.

Grouping genetic algorithm over such solutions: crossover takes whole well-filled bins of one parent, keeps of
the other parent's bins those that repeat no document (no length beyond its count), and best-fits the documents
so displaced, longest first; mutation dissolves the worst filled bins and packs their documents anew. Before best-fit, displaced
documents are swapped against one or two smaller ones of a bin with room, so that bins get full and small documents remain. Islands are rows of a DataFrame that
evolve in separate tasks; after each epoch every island's best goes to the next island. The state between epochs is
written to the shared folder, and all random choices have seeds, so reruns agree.

The best solution is laid out over the documents: documents of a length are ranked in two levels (within a salt, and over the
salts' counts), and a table of at most some thousand rank ranges gives each its sequence and offset.

Tokens: tiktoken's encoder over the ranks that the tokenizer file holds; a text on which it fails, or that holds an added token
of the file, is encoded by the library tokenizers. Both give the same ids.

Defined results: a null text is empty and has the end id only; repeated rows are documents of their own; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import release, utf8
from lexispark.session import drop_scratch, scratch_table, table

END_ID = 2
SALT_ROWS = 16_000
LEAST_SALTS = 16
#: Swaps of one crossover or mutation; what they leave is best-fitted.
SWAPS = 60
#: Lengths whose pairs a swap may bring in at a time; all lengths take part as singles.
PAIRED = 64


@dataclass(frozen=True)
class Search:
    capacity: int = 1024
    islands: int = 4
    population: int = 6
    epochs: int = 3
    generations: int = 6
    seed: int = 20


# --- tokens ---------------------------------------------------------------------------------------------

_encoders: dict[str, object] = {}


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """A function from text to the ids that the library tokenizers gives; one per worker process.

    A text that holds one of the file's added tokens, or on which the fast encoder fails, goes to the library itself.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        vocabulary, marks = held["model"]["vocab"], [t["content"] for t in held.get("added_tokens") or []]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in marks and all(c in letters for c in token)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        library: list[Tokenizer] = []

        def slow(text: str) -> list[int]:
            if not library:
                library.append(Tokenizer.from_file(path))
            return library[0].encode(text, add_special_tokens=False).ids

        def encode(text: str) -> list[int]:
            if any(m in text for m in marks):
                return slow(text)
            try:
                return fast.encode_ordinary(text)
            except BaseException as failed:  # a panic of the native code is no Exception
                if isinstance(failed, (KeyboardInterrupt, SystemExit)):
                    raise
                return slow(text)

        _encoders[path] = encode
    return _encoders[path]


def pieces(docs: DataFrame, path: str, capacity: int = 1024, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on request, ids, for the pieces of each document."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            rows: list[list] = [[] for _ in names]
            for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1)).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                start, n = 0, len(ids) % capacity or min(capacity, len(ids))
                k = 0
                while start < len(ids):
                    part = ids[start : start + n]
                    for column, value in zip(rows, (doc, k, start, n, zlib.crc32(part.tobytes()), part.tolist() if keep_ids else None), strict=False):
                        column.append(value)
                    start, n, k = start + n, capacity, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], names)
            del rows
            release()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# --- bin packing over histograms ------------------------------------------------------------------------

Filling = tuple[int, ...]  # lengths in a bin, longest first
Solution = Counter  # filling -> number of bins


def best_fit(need: Counter, bins: Solution, capacity: int) -> Solution:
    """Put the lengths of need into bins or new ones, longest first, each into the fullest bin that takes it."""
    done: Solution = Counter()
    open_: dict[int, Counter] = {}
    for filling, n in bins.items():
        open_.setdefault(capacity - sum(filling), Counter())[filling] += n
    rooms = sorted(open_)

    def put(room: int, filling: Filling, n: int) -> None:
        if not room:
            done[filling] += n
            return
        if room not in open_:
            open_[room] = Counter()
            rooms.insert(bisect_left(rooms, room), room)
        open_[room][filling] += n

    for length in sorted(need, reverse=True):
        left = need[length]
        while left > 0:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, n = open_[room].popitem()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, filling, n = capacity, (), left
            each = room // length
            used = min(n, left // each) if left >= each else 0
            if not used:
                each, used = left, 1
            if filling and n > used:
                put(room, filling, n - used)
            put(room - each * length, filling + (length,) * each, used)
            left -= used * each
    for group in open_.values():
        done += group
    return done


def contents(bins: Solution) -> Counter:
    out: Counter = Counter()
    for filling, n in bins.items():
        for length, times in Counter(filling).items():
            out[length] += n * times
    return out


def fitness(bins: Solution, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins that are rather full or rather empty than half full."""
    count = sum(bins.values())
    return -count, sum(n * (sum(f) / capacity) ** 2 for f, n in bins.items()) / max(count, 1)


def improve(need: Counter, bins: Solution, capacity: int, rng: random.Random, most: int) -> tuple[Counter, Solution]:
    """Swap one or two lengths of need for one or two of a bin with room, where that fills the bin better.

    Lengths left in need get smaller and easier to place; bins get full. A swap applies to as many equal bins at once as need has lengths for.
    At most `most` swaps are made.
    """
    need, bins = +need, Counter(bins)
    order = [f for f in bins if sum(f) < capacity]
    rng.shuffle(order)
    sums: dict[int, Filling] = {}
    reach = [0] * (capacity + 1)

    def gather() -> None:
        """Sums of one or two lengths of need, and the largest at or below each size."""
        sums.clear()
        lengths = sorted(need)
        some = sorted(rng.sample(lengths, min(len(lengths), PAIRED)))
        sums.update({x + y: (x, y) for i, x in enumerate(some) for y in some[: i + 1] if x + y <= capacity and (x != y or need[x] > 1)})
        sums.update({x: (x,) for x in lengths})
        for size in range(1, capacity + 1):
            reach[size] = size if size in sums else reach[size - 1]

    gather()
    for filling in order:
        while most and need and bins[filling] and (room := capacity - sum(filling)):
            outs = {(x,) for x in filling} | {(filling[i], filling[j]) for i in range(len(filling)) for j in range(i + 1, min(len(filling), i + 8))}
            gain, out = max((reach[sum(o) + room] - sum(o), o) for o in outs)
            if gain <= 0:
                break
            into = sums[sum(out) + gain]
            times = min(bins[filling], *(need[x] // into.count(x) for x in into))
            if not times:  # swapped away meanwhile
                gather()
                continue
            rest = Counter(filling) - Counter(out) + Counter(into)
            bins[filling] -= times
            for x in into:
                need[x] -= times
            for x in out:
                need[x] += times
            need, filling, most = +need, tuple(sorted(rest.elements(), reverse=True)), most - 1
            bins[filling] += times
    bins += Counter()
    return need, bins


def crossover(one: Solution, two: Solution, demand: Counter, capacity: int, rng: random.Random) -> Solution:
    """Inject well-filled bins of two into one."""
    fill = sorted(two, key=lambda f: (-sum(f), f))
    child: Solution = Counter()
    for f in fill[: max(1, int(len(fill) * rng.uniform(0.2, 0.7)))]:
        if rng.random() < 0.8:
            child[f] = max(1, int(two[f] * rng.uniform(0.5, 1.0)))
    need = demand - contents(child)
    for f in sorted(one, key=lambda f: (-sum(f), f)):
        own = Counter(f)
        keep = min([one[f], *(need[length] // times for length, times in own.items())])
        if keep > 0:
            child[f] += keep
            for length, times in own.items():
                need[length] -= keep * times
    return best_fit(*improve(+need, child, capacity, rng, SWAPS), capacity)


def mutate(bins: Solution, capacity: int, rng: random.Random) -> Solution:
    """Dissolve the worst filled bins and a few others and pack their documents anew."""
    kept, need = Counter(bins), Counter()
    poor = sorted(bins, key=lambda f: (sum(f), f))
    for f in [*poor[: max(1, len(poor) // 10)], *rng.sample(poor, max(1, len(poor) // 20))]:
        n = kept.pop(f, 0)
        for length, times in Counter(f).items():
            need[length] += n * times
    if rng.random() < 0.5:  # exact pairs and triples first: they leave no room
        for length in sorted(need, reverse=True):
            other = capacity - length
            n = min(need[length], need[other]) if other != length else need[length] // 2
            if other > 0 and n > 0:
                kept[tuple(sorted((length, other), reverse=True))] += n
                need[length] -= n
                need[other] -= n
    return best_fit(*improve(+need, kept, capacity, rng, SWAPS), capacity)


def first_solution(demand: Counter, capacity: int, rng: random.Random, k: int) -> Solution:
    start = best_fit(demand, Counter(), capacity)
    for _ in range(k):
        start = mutate(start, capacity, rng)
    return start


def _dump(population: list[Solution]) -> str:
    return json.dumps([[[list(f), n] for f, n in s.items()] for s in population])


def _load(text: str) -> list[Solution]:
    return [Counter({tuple(f): n for f, n in s}) for s in json.loads(text)]


def evolve(demand: Counter, population: list[Solution], search: Search, rng: random.Random) -> list[Solution]:
    rank = lambda s: fitness(s, search.capacity)
    for _ in range(search.generations):
        one, two = (max(rng.sample(population, min(3, len(population))), key=rank) for _ in range(2))
        child = crossover(one, two, demand, search.capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, search.capacity, rng)
        population = sorted([*population, child], key=rank, reverse=True)[: search.population]
    return population


def solve(spark: SparkSession, demand: Counter, search: Search = Search()) -> Solution:
    """The best solution of all islands. demand: length -> number of documents."""
    if not demand:
        return Counter()
    asked = sorted(demand.items())

    def epoch(number: int):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            island = int(frame["island"].iloc[0])
            rng = random.Random(search.seed * 1_000_003 + number * 1009 + island)
            need = Counter(dict(asked))
            population = [s for text in sorted(frame["state"]) if text for s in _load(text)]
            population = population or [first_solution(need, search.capacity, rng, k) for k in range(search.population)]
            population = evolve(need, population, search, rng)
            return pd.DataFrame({"island": [island, (island + 1) % search.islands], "state": [_dump(population), _dump(population[:1])]})

        return run

    state = spark.range(search.islands).select(F.col("id").cast("int").alias("island"), F.lit("").alias("state"))
    for number in range(search.epochs):
        # by number, so that small states are not put together: each island has a task of its own
        new = scratch_table(state.repartition(search.islands, "island").groupBy("island").applyInPandas(epoch(number), "island int, state string"), "packing-islands")
        drop_scratch(state)
        state = new
    finals = [s for row in state.collect() for s in _load(row["state"])]
    drop_scratch(state)
    return max(finals, key=lambda s: (fitness(s, search.capacity), sorted(s.items())))


# --- layout ---------------------------------------------------------------------------------------------


def layout(bins: Solution) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, documents of this length per bin, offset of the first)."""
    out: dict[int, list] = {}
    used: Counter = Counter()
    base = 0
    for filling in sorted(bins, reverse=True):
        n, offset = bins[filling], 0
        for length, times in sorted(Counter(filling).items(), reverse=True):
            out.setdefault(length, []).append((used[length], base, times, offset))
            used[length] += n * times
            offset += length * times
        base += n
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def pack(found: DataFrame, search: Search = Search()) -> DataFrame:
    """Add sequence_id and offset to pieces (a written table: it is read three times)."""
    spark = found.sparkSession
    demand = Counter({int(r["length"]): int(r["count"]) for r in found.groupBy("length").count().collect()})
    full = demand.pop(search.capacity, 0)
    bins = solve(spark, demand, search)
    if full:
        bins[(search.capacity,)] = full
    plan = layout(bins)
    salts = max(LEAST_SALTS, -(-(sum(demand.values()) + full) // (2 * SALT_ROWS)))
    rows = found.withColumn("__lx_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = rows.groupBy(F.col("length").alias("__lx_l"), F.col("__lx_salt").alias("__lx_s")).count()
    before = counts.withColumn("__lx_before", F.sum("count").over(Window.partitionBy("__lx_l").orderBy("__lx_s")) - F.col("count")).drop("count")
    order = Window.partitionBy("length", "__lx_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        rows.withColumn("__lx_row", F.row_number().over(order))
        .join(before, (F.col("length") == F.col("__lx_l")) & (F.col("__lx_salt") == F.col("__lx_s")))
        .withColumn("__lx_rank", F.col("__lx_before") + F.col("__lx_row") - 1)
    )
    place_type = pa.struct([("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        lengths, ranks = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(ranks), dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
        for value in np.unique(lengths):
            at = np.flatnonzero(lengths == value)
            table_ = plan[int(value)]
            row = table_[np.searchsorted(table_[:, 0], ranks[at], side="right") - 1]
            within = ranks[at] - row[:, 0]
            sequence[at] = row[:, 1] + within // row[:, 2]
            offset[at] = row[:, 3] + within % row[:, 2] * value
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], fields=list(place_type))

    udf = F.arrow_udf(place, "sequence_id long, offset long")
    placed = ranked.withColumn("__lx_place", udf(F.col("length"), F.col("__lx_rank")))
    return placed.select(*found.columns, "__lx_place.sequence_id", "__lx_place.offset")


def pack_documents(docs: DataFrame, path: str, search: Search = Search(), keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return pack(scratch_table(pieces(docs, path, search.capacity, keep_ids), "packing-pieces"), search)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), default_tokenizer())
