"""Similarity join and nearest neighbours of vectors, over cells of pivots.

Vectors of length 1 belong to the cell of their nearest pivot. A vector visits another cell only where the triangle inequality leaves room for a
partner: its distance to the plane between its pivot and the other one, and to the ball around the other pivot that holds the whole cell, are both
lower bounds of its distance to any member. Both hold exactly, so no pair is lost; how many cells are visited depends on the vectors. Where they
spread evenly and the similarity asked for is low, all cells are.

In the join equal vectors are one: the smallest key stands for its class, and each other member is paired with it alone. The search for neighbours takes classes too, or every
row by itself: then equal vectors are compared once, under the list of their keys. Rows whose key is null, and vectors
that are null, empty, zero or hold a null, NaN or infinity, have no neighbours. Vectors have one length; another one is an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.session import scratch_table

#: Pivots are collected and sent to the tasks: at most these, whatever the table's size.
MOST_PIVOTS = 4096
#: Vectors of one side of a task. Its similarities are made 256 rows at a time; a vector is copied once for each block of the other side, so larger ones move less.
BLOCK = 16_384
#: Vectors of a block where all pairs of a group are compared; a vector is copied once for each block, so larger ones move less.
GROUP_BLOCK = 4096
#: Hosts as near as the k-th, of 256 guests: where near copies make more of them, they are looked through for 16 guests at a time.
TIES = 1 << 18
#: Similarities are rounded to six places before they are compared.
PLACES, ROUNDING, SLACK = 6, 6e-7, 1e-6


def units(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows of length 1."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    out = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    # Scaled first, so that no square overflows or vanishes.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def reach(similarity):
    """The distance of two vectors of length 1 at this similarity, before rounding."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (similarity - ROUNDING)))


def _usable(v: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.forall(v, number) & F.exists(v, lambda x: x != 0)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * v @ pivots.T))


class Cells:
    """homes has id, v, n, home, gap of each class of equal vectors: its smallest key, its size, the number of its cell and the distance to the pivot.

    With members, also ids, the keys of a class in order; a class of very many is several, dealt by their keys. seekers has id, v, home, gap of each row then, else homes.
    """

    def __init__(self, vectors: DataFrame, key: str, column: str = "embedding", most_pivots: int = MOST_PIVOTS, block: int = BLOCK, members: bool = False):
        rows = vectors.select(F.col(key).alias("id"), F.col(column).alias("v")).filter(F.col("id").isNotNull() & _usable(F.col("v")))
        by, kept = [F.col("v")], [F.min("id").alias("id"), F.count("*").alias("n")]
        if members:
            by.append(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-rows.count() // block)))).alias("part"))
            kept.append(F.sort_array(F.collect_list("id")).alias("ids"))
        classes = scratch_table(rows.groupBy(*by).agg(*kept).select("id", "v", "n", *["ids"] * members), "vector-classes")
        wanted = min(most_pivots, max(1, int(np.sqrt(classes.count()) / 4)))
        chosen = [r.v for r in classes.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()]
        self.pivots = np.unique(np.round(units(pa.array(chosen, pa.list_(pa.float64()))), 6), axis=0) if chosen else np.zeros((1, 1))
        self.pivots /= np.maximum(np.linalg.norm(self.pivots, axis=1, keepdims=True), 1e-300)
        self.rows, self.block, self.id_type = rows, block, classes.schema["id"].dataType.simpleString()
        pivots = self.pivots

        def assign(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    far = _distances(units(part.column("v")), pivots)
                    home = far.argmin(axis=1)
                    gap = far[np.arange(len(home)), home]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int32)), pa.array(gap)], [*part.schema.names, "home", "gap"])

        def placed(df: DataFrame) -> DataFrame:
            types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
            return scratch_table(df.mapInArrow(assign, f"{types}, home int, gap double"), "vector-homes")

        self.homes = placed(classes)
        self.seekers = placed(rows) if members else self.homes
        self.radii = np.full(len(pivots), -np.inf)  # no vector lives in an empty cell, so none visits it
        for r in self.homes.groupBy("home").agg(F.max("gap").alias("gap")).collect():
            self.radii[r.home] = r.gap

    def copies(self) -> DataFrame:
        """id, copy: each member of a class of equal vectors beside the key that stands for it."""
        salts = 16  # a class may hold a third of all rows
        many = self.homes.filter("n > 1").select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        rows = self.rows.select(F.col("id").alias("copy"), "v", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
        return rows.join(many, ["v", "salt"]).filter("copy <> id").select("id", "copy")

    def visits(self, seekers: DataFrame, higher: bool) -> DataFrame:
        """id, v, home, cell: the cells where each seeker may have a partner no farther than its `far`.

        With higher, its own cell and those of higher numbers: two vectors then meet in one cell only. Otherwise all but its own.
        """
        pivots, radii = self.pivots, self.radii
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * pivots @ pivots.T))
        np.fill_diagonal(apart, 1.0)
        numbers = np.arange(len(pivots))

        def find(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    gaps = _distances(units(part.column("v")), pivots)
                    home = part.column("home").to_numpy()
                    own = gaps[np.arange(len(home)), home][:, None]
                    bound = np.maximum((gaps**2 - own**2) / (2 * apart[home]), gaps - radii)
                    room = bound <= part.column("far").to_numpy()[:, None] + SLACK
                    room &= numbers > home[:, None] if higher else numbers != home[:, None]
                    if higher:
                        room[np.arange(len(home)), home] = True
                    row, cell = np.nonzero(room)
                    counts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(home)))]).astype(np.int32)
                    cells = pa.ListArray.from_arrays(pa.array(counts), pa.array(cell.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), part.column("home"), cells], ["id", "v", "home", "cells"])

        v = seekers.schema["v"].dataType.simpleString()
        found = seekers.select("id", "v", "home", "far").mapInArrow(find, f"id {self.id_type}, v {v}, home int, cells array<int>")
        return scratch_table(found, "vector-visits").select("id", "v", "home", F.explode("cells").alias("cell"))

    def meet(self, visits: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """Apply work to hosts (id, v, and ids where classes have them) and guests (id, v, home, cell) of each cell, a block of one side with a block of the other.

        The grid that splits cells has a row for each pivot, so its broadcast is bounded.
        """
        ids = ["ids"] * ("ids" in self.homes.columns)
        blocks = lambda n, name: F.greatest(F.ceil(n / self.block), F.lit(1)).cast("int").alias(name)
        held = F.sum("n") if ids else F.count("*")
        grid = self.homes.groupBy(F.col("home").alias("cell")).agg(blocks(held, "hosts")).join(visits.groupBy("cell").agg(blocks(F.count("*"), "guests")), "cell")
        split = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        hosts = self.homes.select(F.col("home").alias("cell"), *[F.col(c).alias(c) for c in ("id", "v", *ids)])  # names of their own beside the guests'
        hosts = hosts.join(F.broadcast(grid), "cell").select("cell", split("hosts", 1).alias("p"), every("guests").alias("q"), "id", "v", *ids)
        guests = visits.join(F.broadcast(grid), "cell").select("cell", every("hosts").alias("p"), split("guests", 2).alias("q"), "id", "v", "home")
        keys = ["cell", "p", "q"]
        return hosts.groupBy(*keys).cogroup(guests.groupBy(*keys)).applyInArrow(work, schema)


def _result(id_type: pa.DataType, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.array([])] * 3
    return pa.table({"id_a": pa.array(columns[0], id_type), "id_b": pa.array(columns[1], id_type), "similarity": pa.array(columns[2], pa.float64())})


def _slices(hosts: pa.Table, guests: pa.Table):
    """Keys and rows of 256 guests at a time, with the keys of the hosts in order and the rounded similarities."""
    hosts = hosts.sort_by("id")
    ids, right = hosts["id"].to_numpy(), units(hosts["v"])
    for at in range(0, guests.num_rows, 256):
        part = guests.slice(at, 256)
        yield ids, part["id"].to_numpy(), part["home"].to_numpy() == part["cell"].to_numpy(), np.round(units(part["v"]) @ right.T, PLACES)


def in_groups(vectors: DataFrame, key: str, group: str, work: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]], column: str = "embedding", block: int = GROUP_BLOCK) -> DataFrame:
    """group, id_a, id_b, similarity of what work finds among the vectors of each group, a block of at most about `block` vectors with a block.

    work is given keys and vectors of length 1 of some rows, and the same of a block that is ordered by key; each pair of rows comes once in either order. Every pair is compared, so the work is the
    square of a group, by products of blocks; a task holds two blocks, and a vector is copied once for each block of its group.
    """
    named = F.col(group).alias("g"), F.col(key).alias("id"), F.col(column).alias("v")
    rows = vectors.select(*named).filter(F.col("g").isNotNull() & F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy("g").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("own")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("low"), F.greatest(k, F.col("own")).alias("high")))).alias("m")
    keys = ["g", "low", "high"]
    placed = rows.join(sizes, "g").select("g", "id", "v", own, "blocks").select("g", "id", "v", "own", meets).select("g", "m.low", "m.high", "own", "id", "v")
    # by number: the rows are few bytes but meet many others, so they must not be put together into few tasks
    placed = placed.repartition(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)

    def meet(rows: pa.Table) -> pa.Table:
        rows, low, high = rows.sort_by("id"), rows["low"][0].as_py(), rows["high"][0].as_py()
        ids, v, own, parts = rows["id"].to_numpy(), units(rows["v"]), rows["own"].to_numpy(), []
        for mine, other in {(low, high), (high, low)}:
            a, b = np.flatnonzero(own == mine), own == other
            if len(a) and b.any():
                right, host = np.ascontiguousarray(v[b]), ids[b]
                for at in range(0, len(a), 256):
                    some = a[at : at + 256]
                    parts += work(ids[some], v[some], host, right)
        out = _result(rows.schema.field("id").type, parts)
        return out.add_column(0, "g", pa.repeat(rows["g"][0], out.num_rows))

    of = lambda c: rows.schema[c].dataType.simpleString()
    found = placed.groupBy(*keys).applyInArrow(meet, f"g {of('g')}, id_a {of('id')}, id_b {of('id')}, similarity double")
    return found.withColumnRenamed("g", group)


def pairs_in_groups(vectors: DataFrame, key: str, group: str, threshold: float, column: str = "embedding", block: int = GROUP_BLOCK) -> DataFrame:
    """group, id_a, id_b, similarity of the pairs of rows of a group whose cosine reaches the threshold, with id_a < id_b."""

    def work(ids, v, others, w):
        similarity = v @ w.T
        a, b = np.nonzero((similarity >= threshold) & (ids[:, None] < others[None, :]))
        return [(ids[a], others[b], similarity[a, b])]

    return in_groups(vectors, key, group, work, column, block)


def best_in_groups(vectors: DataFrame, key: str, group: str, column: str = "embedding", block: int = GROUP_BLOCK) -> DataFrame:
    """id_a, id_b, similarity: the nearest row with a greater key in the group, by the cosine rounded to six places, the smaller key first on ties. A row without one isn't there."""

    def work(ids, v, others, w):
        similarity = np.round(v @ w.T, PLACES)
        similarity[ids[:, None] >= others[None, :]] = -np.inf
        first = similarity.argmax(axis=1)
        best = similarity[np.arange(len(ids)), first]
        found = best > -np.inf
        return [(ids[found], others[first[found]], best[found])]

    near = in_groups(vectors, key, group, work, column, block)
    return near.groupBy("id_a").agg(F.min_by("id_b", F.struct(-F.col("similarity"), F.col("id_b"))).alias("id_b"), F.max("similarity").alias("similarity"))


def similar_pairs(vectors: DataFrame, key: str, threshold: float, column: str = "embedding", most_pivots: int = MOST_PIVOTS, block: int = BLOCK) -> DataFrame:
    """id_a, id_b, similarity of the pairs whose cosine, rounded to six places, reaches the threshold, with id_a < id_b.

    Each pair of different vectors comes once, under the keys that stand for their classes; each further member of a class comes once, beside that
    key, with similarity 1 (where the threshold is above 1: not at all). No link between different vectors is lost.
    """
    cells = Cells(vectors, key, column, most_pivots, block)

    def work(hosts: pa.Table, guests: pa.Table) -> pa.Table:
        parts = []
        if hosts.num_rows and guests.num_rows:
            for ids, guest, own, similarity in _slices(hosts, guests):
                g, h = np.nonzero(similarity >= threshold)
                a, b = guest[g], ids[h]
                # A pair of one cell comes twice, and each vector with itself.
                once = ~own[g] | (a < b)
                a, b, s = a[once], b[once], similarity[g, h][once]
                parts.append((np.where(a < b, a, b), np.where(a < b, b, a), s))
        return _result(hosts.schema.field("id").type, parts)

    seekers = cells.homes.withColumn("far", F.lit(float(reach(threshold))))
    pairs = cells.meet(cells.visits(seekers, higher=True), work, f"id_a {cells.id_type}, id_b {cells.id_type}, similarity double")
    copies = cells.copies().select(F.col("id").alias("id_a"), F.col("copy").alias("id_b"), F.lit(1.0).alias("similarity"))
    return pairs.unionByName(copies.filter(F.lit(threshold <= 1.0)))


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _nearest(hosts: pa.Table, guests: pa.Table, k: int, later: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of guests and of the k members of hosts nearest to each, and their similarities. Keys are compared by their places among all of the hosts'."""
    if "ids" in hosts.column_names:
        lists = hosts["ids"].combine_chunks()
        sizes, ids = np.diff(lists.offsets.to_numpy()), _keys(lists.flatten())
    else:
        sizes, ids = np.ones(hosts.num_rows, dtype=np.int64), _keys(hosts["id"])
    every, member = np.unique(ids, return_inverse=True)
    bounds, right, parts = np.concatenate([[0], np.cumsum(sizes)]), units(hosts["v"]), []
    spots = np.repeat(np.arange(len(sizes)), sizes) * len(every) + member  # ascending, as the members of a host are
    last, alone = member[bounds[1:] - 1], sizes == 1
    for at in range(0, guests.num_rows, 256):
        part = guests.slice(at, 256)
        guest, similarity = _keys(part["id"]), np.round(units(part["v"]) @ right.T, PLACES)
        above = np.searchsorted(every, guest, "right")
        own = np.where(every[np.maximum(above - 1, 0)] == guest, above - 1, -1)
        similarity[last[None, :] < above[:, None] if later else alone[None, :] & (last[None, :] == own[:, None])] = -np.inf
        some = min(k, len(sizes))
        least = similarity.max(axis=1) if some == 1 else np.partition(similarity, len(sizes) - some, axis=1)[:, len(sizes) - some]
        # each of these has a member that counts, so the k nearest rows are among their first
        near = (similarity >= least[:, None]) & (similarity > -np.inf)
        step = 256 if near.sum() <= TIES else 16
        for a in range(0, len(guest), step):
            g, h = np.nonzero(near[a : a + step])
            g += a
            first = np.searchsorted(spots, h * len(every) + above[g]) if later else bounds[h]
            n = np.minimum(bounds[h + 1] - first, k if later else k + 1)  # one more where the guest may be among them itself
            row, place, s = np.repeat(g, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(similarity[g, h], n)
            other = member[place]
            row, other, s = (c[other != own[row]] for c in (row, other, s))
            order = np.lexsort((other, -s, row))
            row, other, s = row[order], other[order], s[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < k
            parts.append((guest[row[kept]], every[other[kept]], s[kept]))
    return parts


def nearest(
    vectors: DataFrame, key: str, k: int = 1, column: str = "embedding", later: bool = False, most_pivots: int = MOST_PIVOTS, block: int = BLOCK, copies: bool = False
) -> DataFrame:
    """id_a, id_b, similarity of the k nearest other vectors of each vector (later: of those with greater keys), the smaller key first on ties.

    With copies, every row looks for itself and is found by itself, copies of its own vector too. Without, a class of equal vectors takes part as its smallest key, and `Cells.copies` names its
    other members. A vector looks in its own cell first, and then only where something as near as the k-th found could be; a task keeps k for each of its guests. Equal vectors are compared
    with a guest once, whatever their number.
    """
    cells = Cells(vectors, key, column, most_pivots, block, members=copies)

    def work(hosts: pa.Table, guests: pa.Table) -> pa.Table:
        return _result(hosts.schema.field("id").type, _nearest(hosts, guests, k, later) if hosts.num_rows and guests.num_rows else [])

    schema = f"id_a {cells.id_type}, id_b {cells.id_type}, similarity double"
    order = Window.partitionBy("id_a").orderBy(F.desc("similarity"), "id_b")
    top = lambda df: df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
    near = scratch_table(top(cells.meet(cells.seekers.withColumn("cell", F.col("home")), work, schema)), "vector-near")
    least = near.groupBy(F.col("id_a").alias("id")).agg(F.when(F.count("*") >= k, F.min("similarity")).alias("least"))
    far = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (F.coalesce("least", F.lit(-1.0)) - ROUNDING)))
    seekers = cells.seekers.join(least, "id", "left").withColumn("far", far)
    return top(near.unionByName(cells.meet(cells.visits(seekers, higher=False), work, schema)))
