"""Embedding near-duplicates by collision-counting projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, comb, erf, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import written
from millrace.llm.components import smallest_reachable

#: Least cosine of a link, and the recall that the collision count is set for at that cosine.
COSINE, RECALL = 0.95, 0.985
#: Projections, signs that prefix each, and half the width of a query's window.
PROJECTIONS, SIGNS, WINDOW = 24, 12, 0.5
#: Vectors of one cell of a projection that one group compares; larger cells are split.
CELL = 4096
#: Pairs compared at a time.
PAIRS = 1 << 15


def collision_chance(cosine: float, signs: int = SIGNS, window: float = WINDOW) -> float:
    """Chance that two unit vectors of this cosine collide in one projection.

    They must agree in every sign, and their values, normal with a difference of
    variance 2 - 2 cosine, must lie within the window.
    """
    spread = sqrt(max(2 - 2 * cosine, 1e-12))
    return (1 - acos(min(cosine, 1.0)) / pi) ** signs * erf(window / spread / sqrt(2))


def least_collisions(
    cosine: float = COSINE, recall: float = RECALL, projections: int = PROJECTIONS, signs: int = SIGNS, window: float = WINDOW
) -> int:
    """Largest count that pairs of this cosine reach with at least this probability, 1 at least."""
    p, below = collision_chance(cosine, signs, window), 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if 1 - below < recall:
            return max(count, 1)
    return projections


def directions(width: int, seed: int = 0) -> np.ndarray:
    """Normal directions, by projection: one for the value, then those for the signs."""
    return np.random.default_rng(seed + width).normal(size=(width, PROJECTIONS, 1 + SIGNS))


def projected(units: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Value and cell (number of the projection and its signs) of each vector in each projection."""
    found = np.tensordot(units, directions(units.shape[1], seed), 1)
    cells = (found[:, :, 1:] > 0) @ (1 << np.arange(SIGNS))
    return found[:, :, 0], cells + (np.arange(PROJECTIONS) << SIGNS)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors in double precision, scaled to length one without overflow."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest member of the component of each of ``size`` points linked by pairs a, b."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def embedding_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
    cell: int = CELL,
    seed: int = 0,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of a cosine of at least ``cosine``, in double precision, are linked.
    Each distinct vector is projected on many random directions. Each projection
    is sorted within cells given by the signs of some more directions, so a
    query's window on it holds few strangers. A pair collides in a projection if
    both are in the same cell and their values lie within the window. Pairs whose
    number of collisions reaches a count set for ``recall`` at the least cosine
    (closer pairs are found more surely) are verified by their cosine. A pair is
    handled where it collides first, so it is counted once.

    Equal vectors are one class and never compared. Tasks return link counts and
    spanning links of what they compared, not pairs. A cell with more than
    ``cell`` vectors is split, and every two of its pieces meet in a group of
    their own, so no cell is cut off or handled by one task.

    ``n_links`` counts other rows linked directly, ``component_id`` is the
    smallest id that links reach, the row's own included, and ``kept`` whether
    it is the row's id. Vectors that are null, empty, zero or hold null or
    non-finite numbers link with nothing; vectors of different lengths never
    link. Rows that repeat a vector link with each other, also if they repeat an
    id. An empty table gives no rows.
    """
    kind = vectors.schema[vector_col].dataType.elementType
    number = "f4" if isinstance(kind, T.FloatType) else "f8"
    v = F.col("v").cast("array<float>" if number == "f4" else "array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "v", lambda x: x != 0
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).withColumn("v", v)
    rows = rows.withColumn("v", F.when(good, F.col("v")))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    count = least_collisions(cosine, recall)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists = batch.column(2)
                widths = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy().astype(number)
                begin = np.cumsum(widths) - widths
                for width in np.unique(widths):
                    rows = np.flatnonzero(widths == width)
                    data = flat[begin[rows][:, None] + np.arange(width)]
                    values, cells = projected(unit(data), seed)
                    packed = pa.array([row.tobytes() for row in data], pa.binary())
                    again = pa.array(np.repeat(np.arange(len(rows)), PROJECTIONS))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(((np.int64(width) << 32) + cells).ravel()),
                            pa.array(values.ravel()),
                            batch.column(0).take(pa.array(rows)).take(again),
                            batch.column(1).take(pa.array(rows)).take(again),
                            packed.take(again),
                        ],
                        names=["cell", "value", "id", "copies", "data"],
                    )

    schema = "cell long, value double, id long, copies long, data binary"
    points = written(classes.select("id", "copies", "v").mapInArrow(placed, schema), "points")
    large = written(
        points.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell).select(
            "cell", F.ceil(F.col("n") / cell).cast("int").alias("pieces")
        ),
        "large",
    )
    pieces = F.coalesce("pieces", F.lit(1))
    mine = F.pmod(F.xxhash64("id"), pieces).cast("int")
    grouped = (
        points.join(large, "cell", "left")
        .withColumn("piece", mine)
        .withColumn("other", F.explode_outer(F.sequence(F.lit(0), pieces - 1)))
        .select(
            "cell", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece",
            "value", "id", "copies", "data",
        )
    )

    def compared(table: pa.Table) -> pa.RecordBatch:
        """Links found among rows sorted by group and value."""
        columns = {c: table.column(c).to_numpy() for c in ("cell", "low", "high", "piece", "value", "id", "copies")}
        cell, low, high, value = (columns[c] for c in ("cell", "low", "high", "value"))
        new = (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        bounds = np.flatnonzero(np.concatenate([[True], new, [True]]))
        links, found_a, found_b = np.zeros(len(cell), np.int64), [], []
        ends = np.zeros(len(cell), np.int64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                ends[a:b] = a + np.searchsorted(value[a:b], value[a:b] + WINDOW, "right")
        partners = np.maximum(ends - np.arange(len(cell)) - 1, 0)
        used = np.flatnonzero(partners)
        data = table.column("data").combine_chunks()
        for chunk in np.split(used, np.searchsorted(np.cumsum(partners[used]), np.arange(PAIRS, partners.sum(), PAIRS))):
            if not len(chunk):
                continue
            i = np.repeat(chunk, partners[chunk])
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(partners[chunk]) - partners[chunk], partners[chunk])
            # groups of two pieces compare only across them
            across = (low[i] == high[i]) | (columns["piece"][i] != columns["piece"][j])
            i, j = i[across], j[across]
            if not len(i):
                continue
            there, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            for width in np.unique(cell[there] >> 32):
                of = np.flatnonzero(cell[there] >> 32 == width)
                units = unit(np.frombuffer(b"".join(data.take(pa.array(there[of])).to_pylist()), number).reshape(len(of), -1))
                values, cells = projected(units, seed)
                local = np.full(len(there), -1)
                local[of] = np.arange(len(of))
                x, y = local[at[: len(i)]], local[at[len(i) :]]
                pick = np.flatnonzero(x >= 0)
                for part in np.array_split(pick, max(1, len(pick) // PAIRS + 1)):
                    p, q = x[part], y[part]
                    hits = (cells[p] == cells[q]) & (np.abs(values[p] - values[q]) <= WINDOW)
                    here = (cell[i[part]] & ((1 << 32) - 1)) >> SIGNS
                    first = (hits.sum(1) >= count) & (hits.argmax(1) == here)
                    part, p, q = part[first], p[first], q[first]
                    part = part[np.einsum("ij,ij->i", units[p], units[q]) >= cosine]
                    np.add.at(links, i[part], columns["copies"][j[part]])
                    np.add.at(links, j[part], columns["copies"][i[part]])
                    ids, place = np.unique(np.concatenate([i[part], j[part]]), return_inverse=True)
                    root = joined(place[: len(part)], place[len(part) :], len(ids))
                    ties = np.flatnonzero(root != np.arange(len(ids)))
                    found_a.append(columns["id"][ids[ties]])
                    found_b.append(columns["id"][ids[root[ties]]])
        linked = np.flatnonzero(links)
        a = np.concatenate([columns["id"][linked], *found_a])
        b = np.concatenate([columns["id"][linked], *found_b])
        more = np.concatenate([links[linked], np.zeros(len(a) - len(linked), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(more)], names=["a", "b", "links"])

    def compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                waiting.append(batch)
                group = lambda b, k: tuple(b.column(c)[k].as_py() for c in range(3))
                if group(waiting[0], 0) == group(batch, batch.num_rows - 1):
                    continue
                table = pa.Table.from_batches(waiting)
                last, keep = group(batch, batch.num_rows - 1), np.ones(table.num_rows, bool)
                for c, x in zip(("cell", "low", "high"), last):
                    keep &= table.column(c).to_numpy() == x
                begin = int(np.argmax(keep))
                yield compared(table.slice(0, begin).combine_chunks())
                waiting = table.slice(begin).combine_chunks().to_batches()
        if waiting:
            yield compared(pa.Table.from_batches(waiting).combine_chunks())

    found = written(
        grouped.repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high", "value")
        .mapInArrow(compare_groups, "a long, b long, links long"),
        "found",
    )
    links = written(found.where("links > 0").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links")), "links")
    placed_in = smallest_reachable(classes.select("id", "first"), found.where("a <> b").select("a", "b"))
    result = classes.select("id", "v", "copies").join(links, "id", "left").join(placed_in, "id")
    result = written(
        result.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "result"
    )
    return rows.join(result, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
