"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors of length 1 with a cosine of at least `COSINE` are at most sqrt(2 - 2 COSINE) apart. Turned by
a random rotation, that distance is spread over all coordinates, so in most of them the two lie within
a window around either; of unrelated vectors only a quarter or so do. A pair is verified by its cosine
if it collides in at least as many of the coordinates of one rotation as a pair at that distance must
(the squares of its misses cannot sum to more than the squared distance), so this count loses nothing.

One sorted projection alone would bring together a fixed share of all pairs, whatever its window. Each
of several tables therefore sorts one projection within the cells of some others: the cells are `CELL`
deviations wide, their number grows with the logarithm of the vectors, and the number of tables follows
from the chance that a pair at the limit shares all cells of none, 1 - `RECALL`. Vectors are read along
the sorted projection, each with those in the window after it.

Equal vectors are one, with a count. A cell with more than `SLICE` vectors is cut into slices, and every
two slices meet in a group of their own. Verified pairs are not sent on: a group returns for each vector
the number of links it found (each pair counts in its first table alone) and one spanning link.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, pa_schema, record, session_of, stored
from candles.llm.components import components

COSINE, RECALL = 0.95, 0.995
#: Widths in deviations that a coordinate of a pair at the limit has: cells, sorted window, counted window.
CELL, WINDOW, COUNTED = 6.0, 4.0, 1.5
#: Share of unrelated pairs that one cell of a coordinate keeps, for vectors in all directions alike.
KEPT = 0.47
SLICE = 4096
#: Candidate pairs looked at together, verified pairs held until their tables are looked up, and vectors
#: turned at once.
AT_ONCE, PENDING, TURNED = 1 << 14, 1 << 20, 1 << 11


class Tables:
    """Rotations and cells for vectors of one dimension."""

    def __init__(self, dimension: int, cells: int, tables: int, cosine: float):
        rng = np.random.default_rng([dimension, cells, tables])
        self.cells, self.tables = min(cells, max(dimension - 1, 1)), tables
        wide = min(self.cells + 1, dimension)
        turns = -(-tables // (dimension // wide))
        basis = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(turns)]
        self.basis = np.hstack(basis)
        each = dimension // wide
        self.begin = [dimension * (t // each) + wide * (t % each) for t in range(tables)]
        self.sort_at = np.array([b + wide - 1 for b in self.begin])
        far = 2 - 2 * cosine
        deviation = math.sqrt(max(far, 1e-12) / dimension)
        self.cell, self.window, self.counted = CELL * deviation, WINDOW * deviation, COUNTED * deviation
        self.least = max(0, dimension - math.floor(far / self.counted**2 + 1e-9))
        self.shift = rng.random(self.basis.shape[1]) * self.cell
        self.mix = rng.integers(1, 1 << 62, self.basis.shape[1], dtype=np.int64) | 1
        self.dimension = dimension

    def turned(self, unit: np.ndarray) -> np.ndarray:
        """All projections, added one coordinate after another, so that a vector has the same ones
        whatever stands beside it."""
        out = np.zeros((len(unit), self.basis.shape[1]))
        for d in range(self.dimension):
            out += unit[:, d, None] * self.basis[d]
        return out

    def keys(self, turned: np.ndarray) -> np.ndarray:
        """A 64-bit number for the cells of each table."""
        cells = np.floor((turned + self.shift) / self.cell).astype(np.int64) * self.mix
        cells ^= cells >> 29
        return np.stack([(cells[:, b:b + self.cells] * self.mix[:self.cells]).sum(axis=1) + t for t, b in enumerate(self.begin)], 1)


@lru_cache(maxsize=8)
def tables_of(dimension: int, cells: int, tables: int, cosine: float) -> Tables:
    return Tables(dimension, cells, tables, cosine)


def plan(vectors: int, recall: float = RECALL) -> tuple[int, int]:
    """(cells of a table, tables) for so many vectors."""
    cells = max(2, math.ceil(math.log(max(vectors, 2)) / -math.log(KEPT)))
    stays = 1 - math.sqrt(2 / math.pi) / CELL
    return cells, math.ceil(math.log(1 - recall) / math.log(1 - stays**cells))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in double precision; scaled first, so that no square overflows."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    squares = np.zeros(len(scaled))
    for d in range(scaled.shape[1]):
        squares += scaled[:, d] ** 2
    return scaled / np.sqrt(squares)[:, None]


def matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():column.offsets[-1].as_py()].reshape(len(column), -1)


def _by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each dimension in a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    for dimension in np.unique(lengths):
        rows = np.flatnonzero(lengths == dimension)
        yield rows, matrix(column.take(pa.array(rows)))


def linked_pairs(
    table: Tables, number: int, vectors: np.ndarray, heights: np.ndarray, group: np.ndarray, part: np.ndarray,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows i and j of verified pairs that meet in table `number` and in none before it. Rows are sorted
    by group and height; part tells the slices of a group that is to compare two of them (-1: all)."""
    unit = units(vectors)
    first = unit @ table.basis[:, :table.dimension]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    alive, shift, pending = np.arange(len(unit)), 0, 0
    while len(alive):
        shift += 1
        alive = alive[alive + shift < len(unit)]
        alive = alive[(group[alive + shift] == group[alive]) & (heights[alive + shift] - heights[alive] <= table.window)]
        for at in range(0, len(alive), AT_ONCE):
            i = alive[at:at + AT_ONCE]
            i = i[(part[i] < 0) | (part[i] != part[i + shift])]
            count = (np.abs(first[i] - first[i + shift]) <= table.counted).sum(axis=1)
            i = i[count >= table.least]
            i = i[np.einsum("nd,nd->n", unit[i], unit[i + shift]) >= cosine]
            if len(i):
                found.append((i, i + shift))
                pending += len(i)
        if pending > PENDING:
            kept.append(_not_met_before(table, number, unit, found))
            found, pending = [], 0
    if found:
        kept.append(_not_met_before(table, number, unit, found))
    if not kept:
        return alive, alive
    return np.concatenate([i for i, _ in kept]), np.concatenate([j for _, j in kept])


def _not_met_before(
    table: Tables, number: int, unit: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]],
) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs found in table `number` those that meet in none before it."""
    i, j = (np.concatenate([pair[side] for pair in found]) for side in (0, 1))
    if not number:
        return i, j
    own, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    keys, heights = np.empty((len(own), number), np.int64), np.empty((len(own), number))
    for at in range(0, len(own), TURNED):
        turned = table.turned(unit[own[at:at + TURNED]])
        keys[at:at + TURNED] = table.keys(turned)[:, :number]
        heights[at:at + TURNED] = turned[:, table.sort_at[:number]]
    a, b = place[:len(i)], place[len(i):]
    met = np.zeros(len(i), bool)
    for t in range(number):
        met |= (keys[a, t] == keys[b, t]) & (np.abs(heights[a, t] - heights[b, t]) <= table.window)
    return i[~met], j[~met]


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL,
) -> DataFrame:
    """(key, n_links, component_id, kept) per row of `vectors`.

    n_links counts the other rows linked directly, component_id is the smallest key reachable, kept
    tells whether that is the row's own. Null and zero vectors and those with null or non-finite
    components link with nothing and are kept; vectors of different dimensions do not link. A pair at
    exactly `cosine` is found with a chance of `recall` at least, a closer one with a higher chance;
    what is found is exact. Repeated rows are vectors of their own. No rows give no rows; other columns are
    not looked at. A crowded cell is compared slice by slice with every slice: memory is bounded, but since links are
    counted exactly the work grows with the square of a crowd that is not of equal vectors.
    """
    spark = session_of(vectors)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    kind = rows.schema["v"].dataType.simpleString()
    number = rows.schema["id"].dataType.simpleString()
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.where(valid)
    distinct = good.groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    cells, count = plan(distinct.count(), recall)

    def placed(columns: dict, heavy: bool) -> Iterable[dict]:
        for own, found in _by_dimension(columns["v"]):
            table = tables_of(found.shape[1], cells, count, cosine)
            turned = table.turned(units(found))
            keys, heights = table.keys(turned), turned[:, table.sort_at]
            taken = {name: columns[name].take(pa.array(own)) for name in columns}
            for t in range(count):
                made = {"t": np.full(len(own), t), "d": np.full(len(own), found.shape[1]), "k": keys[:, t]}
                yield made | ({"height": heights[:, t]} | taken if heavy else {})

    light, place = "t int, d int, k long", ["t", "d", "k"]
    counts = arrow_map(distinct.select("v"), lambda c: placed(c, False), light).groupBy(*place).agg(F.count(F.lit(1)).alias("size"))
    crowded = stored(counts.where(F.col("size") > SLICE).select(*place, F.ceil(F.col("size") / SLICE).cast("int").alias("slices")), "cells")
    spread = arrow_map(distinct.select("v", "node", "n"), lambda c: placed(c, True), f"{light}, height double, v {kind}, node long, n long")
    spread = spread.join(crowded, place, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    group = [*place, F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")]
    spread = spread.select(*group, "height", "v", "node", "n", "part")
    group = [*place, "a", "b"]
    spread = spread.repartition(*group).sortWithinPartitions(*group, "height", "node")
    out = "node long, root long, links long"
    types = pa_schema(spark, out)

    def compared(batch: pa.Table) -> pa.RecordBatch:
        columns = {name: batch.column(name).combine_chunks() for name in batch.column_names}
        nodes, weights = columns["node"].to_numpy(), columns["n"].to_numpy()
        t, d, a, b, part = (columns[x].to_numpy() for x in ("t", "d", "a", "b", "part"))
        links, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        edge = np.flatnonzero(np.diff(t, prepend=-1) | np.diff(d, prepend=-1))
        for begin, end in zip(edge, np.append(edge[1:], len(t))):
            s = slice(begin, end)
            new = np.zeros(end - begin, bool)
            for name in group:
                new |= np.diff(columns[name].to_numpy()[s], prepend=columns[name].to_numpy()[begin]) != 0
            own = np.where(a[s] == b[s], -1, part[s])
            i, j = linked_pairs(tables_of(int(d[begin]), cells, count, cosine), int(t[begin]), matrix(columns["v"].slice(begin, end - begin)),
                                columns["height"].to_numpy()[s], np.cumsum(new), own, cosine)
            i, j = i + begin, j + begin
            np.add.at(links, i, weights[j])
            np.add.at(links, j, weights[i])
            for x, y in zip(i.tolist(), j.tolist()):
                x, y = find(x), find(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        touched = np.flatnonzero(links)
        return record({"node": nodes[touched], "root": nodes[[find(x) for x in touched.tolist()]], "links": links[touched]}, types)

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4 * SLICE:
                continue
            whole = pa.Table.from_batches(held)
            change = np.zeros(len(whole), bool)
            for name in group:
                change[1:] |= np.diff(whole.column(name).to_numpy()) != 0
            cut = np.flatnonzero(change)
            if len(cut):
                yield compared(whole.slice(0, int(cut[-1])))
                held = whole.slice(int(cut[-1])).combine_chunks().to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    found = stored(spread.mapInArrow(sweep, out), "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = stored(known.select("v", "first", "n", "root", F.coalesce("links", F.lit(0)).alias("links")), "vector-roots")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    of = known.join(least, "root").select("v", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    linked = good.join(of, "v").select("id", "n_links", "component_id")
    alone = rows.where(~valid).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").cast(number).alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
