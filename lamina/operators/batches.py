"""Edit batches: consecutive edits whose payloads stay within a byte budget."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.errors import InvalidParameterError
from lamina.operators.numbering import TASK_BITS
from lamina.session import stage

# Default and largest size of a request body, and the part of it
# kept for framing; what a delete costs beyond the digits of its id.
DEFAULT_MAX_BATCH_BYTES = 1_800_000
MAX_BATCH_BYTES = 6_000_000
OVERHEAD_BYTES = 4_096
DELETE_EXTRA_BYTES = 2

KINDS = ("adds", "updates", "deletes")

# Edits are packed in pieces of up to this many rows of one writing task, and so many
# pieces are joined into one at a time. Neither number shows in the result.
PIECE_BITS = 18
PIECES_AT_ONCE = 8

# The packing functions travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED_SCHEMA = (
    "kind_rank int, seq bigint, oid bigint, problem string, size bigint, "
    "batch_id bigint, position bigint"
)


def check_batch_bytes(max_bytes: int) -> None:
    if not 0 < max_bytes <= MAX_BATCH_BYTES:
        raise InvalidParameterError(
            f"A batch of {max_bytes} bytes is out of range: max_batch_bytes is 1 to {MAX_BATCH_BYTES}."
        )


def delete_size(oid: Column) -> Column:
    return F.length(oid.cast("string")) + F.lit(DELETE_EXTRA_BYTES)


def fill_batches(sizes: np.ndarray, used: int, budget: int) -> tuple[np.ndarray, int]:
    """Batch number of each item, counted from the open batch that holds ``used`` bytes.

    An item that does not fit closes the batch unless that is empty, so an item
    larger than the budget gets a batch of its own. Also returns the bytes in the
    last batch.
    """
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    numbers = np.empty(len(sizes), dtype=np.int64)
    start = number = 0
    while start < len(sizes):
        stop = int(np.searchsorted(ends, ends[start] + budget - used, side="right")) - 1
        if stop <= start and used > 0:
            number, used = number + 1, 0
            continue
        stop = max(stop, start + 1)
        numbers[start:stop] = number
        used += int(ends[stop] - ends[start])
        start = stop
    return numbers, used


@dataclass(frozen=True)
class Passage:
    """What a stretch of edits makes of the open batch it finds.

    A batch that enters with ``u`` bytes and has room for all ``total`` bytes leaves with
    ``u + total`` and no batch is begun. Otherwise the last entry of ``low`` up to ``u``
    says how many batches are begun and how full the last one is. ``first`` is the same
    for a stretch with nothing before it.
    """

    total: int
    low: np.ndarray
    begun: np.ndarray
    used: np.ndarray
    first: tuple[int, int]

    def leave(self, used: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
        """Batches begun and bytes in the last one, for open batches of ``used`` bytes."""
        fits = used + self.total <= budget
        at = np.maximum(np.searchsorted(self.low, used, side="right") - 1, 0)
        if not len(self.low):
            return np.zeros_like(used), used + self.total
        return np.where(fits, 0, self.begun[at]), np.where(fits, used + self.total, self.used[at])

    def enter(self, used: int, budget: int) -> tuple[int, int]:
        if used == 0:
            return self.first
        begun, left = self.leave(np.array([used], np.int64), budget)
        return int(begun[0]), int(left[0])

    def then(self, later: Passage, budget: int) -> Passage:
        begun, used = later.leave(self.used, budget)
        # entries that pass through here and break in the later stretch
        inner = later.low - self.total
        some = inner <= budget - self.total
        some &= np.append(inner[1:], budget) > 1  # of those below 1 the last is enough
        first, left = later.enter(self.first[1], budget)
        return _passage(
            self.total + later.total,
            np.concatenate([np.maximum(inner[some], 1), self.low]),
            np.concatenate([later.begun[some], self.begun + begun]),
            np.concatenate([later.used[some], used]),
            (self.first[0] + first, left),
            budget - self.total,
            int(some.sum()),
        )


def _passage(total, low, begun, used, first, passing, n_inner) -> Passage:
    """A passage without steps that change nothing; of the first ``n_inner`` steps only
    those for entries up to ``passing`` count."""
    real = np.ones(len(low), bool)
    real[:n_inner] = low[:n_inner] <= passing
    low, begun, used = low[real], begun[real], used[real]
    new = np.ones(len(low), bool)
    new[1:] = (begun[1:] != begun[:-1]) | (used[1:] != used[:-1])
    return Passage(int(total), low[new], begun[new], used[new], first)


def passage_of(sizes: np.ndarray, budget: int) -> Passage:
    """The passage of a piece of at least one edit.

    Whatever enters, the piece goes on like one that begins a batch at the first edit
    without room, so one trajectory per edit within a budget of the start says all.
    """
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    n = len(sizes)
    breaks = np.arange(min(n, int(np.searchsorted(ends[1:], budget, side="left")) + 1))
    at, begun = breaks.copy(), np.ones(len(breaks), np.int64)
    moving = np.arange(len(breaks))
    while len(moving):
        here = at[moving]
        stop = np.searchsorted(ends, ends[here] + budget, side="right") - 1
        stop = np.maximum(stop, here + 1)
        moving, stop = moving[stop < n], stop[stop < n]
        at[moving] = stop
        begun[moving] += 1
    used = ends[n] - ends[at]
    first = (int(begun[0]) - 1, int(used[0]))
    low = np.maximum(budget - ends[breaks + 1] + 1, 1)
    # A later break needs a smaller entry; of those with the same least entry the first holds.
    once = np.unique(low, return_index=True)[1]
    return _passage(ends[n], low[once], begun[once], used[once], first, budget, 0)


PASSAGE_SCHEMA = (
    "piece bigint, total bigint, low array<bigint>, begun array<bigint>, used array<bigint>, "
    "first_begun bigint, first_used bigint"
)


def _as_row(piece: int, p: Passage) -> dict:
    return {
        "piece": piece, "total": p.total, "low": p.low.tolist(), "begun": p.begun.tolist(),
        "used": p.used.tolist(), "first_begun": p.first[0], "first_used": p.first[1],
    }


def _as_passage(row) -> Passage:
    steps = [np.asarray(x, np.int64) for x in (row.low, row.begun, row.used)]
    return Passage(int(row.total), *steps, (int(row.first_begun), int(row.first_used)))


def entries(placed: DataFrame, n_pieces: int, budget: int) -> DataFrame:
    """piece, base (batches begun before it) and entry (bytes in the batch it finds open).

    Passages of neighbours are joined eight at a time until one is left; the way back
    hands each its entry. A task holds eight passages, whose steps a budget bounds.
    """
    spark = placed.sparkSession

    def measure(edits: pd.DataFrame) -> pd.DataFrame:
        sizes = edits.sort_values("seq")["size"].to_numpy(np.int64)
        return pd.DataFrame([_as_row(int(edits["piece"].iloc[0]), passage_of(sizes, budget))])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        rows = list(group.sort_values("piece").itertuples())
        joined = _as_passage(rows[0])
        for row in rows[1:]:
            joined = joined.then(_as_passage(row), budget)
        return pd.DataFrame([_as_row(rows[0].piece // PIECES_AT_ONCE, joined)])

    def hand_down(group: pd.DataFrame) -> pd.DataFrame:
        found, rows = [], list(group.sort_values("piece").itertuples())
        base, entry = int(rows[0].base), int(rows[0].entry)
        for row in rows:
            found.append((row.piece, base, entry))
            begun, entry = _as_passage(row).enter(entry, budget)
            base += begun
        return pd.DataFrame(found, columns=["piece", "base", "entry"])

    above = F.expr(f"piece div {PIECES_AT_ONCE}")
    known = spark.createDataFrame([(0, 0, 0)], "piece bigint, base bigint, entry bigint")
    levels, left = [], n_pieces
    while left > 1:
        if levels:
            level = levels[-1].groupBy(above).applyInPandas(join, PASSAGE_SCHEMA)
        else:
            sizes = placed.select("piece", "seq", "size")
            level = sizes.groupBy("piece").applyInPandas(measure, PASSAGE_SCHEMA)
        levels.append(stage(level, "passages"))
        left = -(-left // PIECES_AT_ONCE)
    for level in reversed(levels):
        parents = known.withColumnRenamed("piece", "parent")
        below = level.withColumn("parent", above).join(parents, "parent")
        known = below.groupBy("parent").applyInPandas(
            hand_down, "piece bigint, base bigint, entry bigint"
        )
    return known


def _packer(budget: int):
    """Arrow function over edits sorted by piece and sequence."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, number, used, place = None, 0, 0, 0
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            pieces, starts, bases, opened, sizes = (
                columns[n].to_numpy(zero_copy_only=False)
                for n in ("piece", "start", "base", "entry", "size")
            )
            ids, positions = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
            for lo, hi in _stretches(pieces):
                if pieces[lo] != piece:
                    piece, number, used, place = pieces[lo], int(bases[lo]), int(opened[lo]), 0
                numbers, used = fill_batches(sizes[lo:hi], used, budget)
                ids[lo:hi] = number + numbers
                number += int(numbers[-1])
                positions[lo:hi] = starts[lo:hi] + place + np.arange(hi - lo)
                place += hi - lo
            kept = [columns[n] for n in ("kind_rank", "seq", "oid", "problem", "size")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids), pa.array(positions)],
                names=["kind_rank", "seq", "oid", "problem", "size", "batch_id", "position"],
            )

    return pack


def _stretches(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stretches of equal neighbours."""
    if len(values) == 0:
        return []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:]))


@dataclass(frozen=True)
class Pack:
    """Packed edits, their number per kind, all their bytes, and the first position of
    each (kind, task)."""

    edits: DataFrame
    counts: dict[str, int]
    n_bytes: int
    starts: DataFrame


def pack_edits(edits: DataFrame, max_bytes: int) -> Pack:
    """Give every edit its batch and its position among the edits of its kind.

    ``edits`` is a written table ``(kind_rank, seq, oid, problem, size)`` whose
    ``seq`` is a task tag (see :mod:`lamina.operators.numbering`).

    Batches are what one pass over all edits would give, however they are spread over
    tasks: pieces are measured for every batch they may find open, see :func:`entries`.
    Counts per piece, one small row each, place the pieces in order.
    """
    budget = max_bytes - OVERHEAD_BYTES
    part = F.shiftright(F.col("seq"), PIECE_BITS)
    pieces = (
        edits.groupBy("kind_rank", part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
        .toPandas()
        .sort_values(["kind_rank", "part"], ignore_index=True)
    )
    n = pieces["n"]
    lookup = pieces[["kind_rank", "part"]].assign(
        piece=np.arange(len(pieces)), start=n.groupby(pieces["kind_rank"]).cumsum() - n
    )
    per_kind = n.groupby(pieces["kind_rank"]).sum()
    counts = {kind: int(per_kind.get(rank, 0)) for rank, kind in enumerate(KINDS)}
    total = int(pieces["bytes"].sum())
    table = edits.sparkSession.createDataFrame(
        lookup, "kind_rank int, part bigint, piece bigint, start bigint"
    )
    placed = edits.withColumn("part", part).join(F.broadcast(table), ["kind_rank", "part"])
    opened = F.broadcast(entries(placed, len(pieces), budget))  # one row per piece
    ordered = (
        placed.join(opened, "piece").repartition("piece").sortWithinPartitions("piece", "seq")
    )
    packed = ordered.mapInArrow(_packer(budget), PACKED_SCHEMA)
    task = F.shiftright(F.col("part"), TASK_BITS - PIECE_BITS)
    starts = table.groupBy("kind_rank", task.alias("task")).agg(F.min("start").alias("start"))
    return Pack(packed, counts, total, starts)


def batch_bodies(features: DataFrame) -> DataFrame:
    """Request bodies as JSON text from ``(batch_id, kind, position, feature, oid)`` rows.

    A batch is bounded by the byte budget, so collecting one is safe. Kinds a
    batch lacks are left out; deletes are ids joined by commas.
    """

    def texts(kind: str, value: Column) -> Column:
        rows = F.collect_list(F.when(F.col("kind") == kind, F.struct("position", value.alias("v"))))
        return F.transform(F.array_sort(rows), lambda r: r["v"])

    parts = []
    for kind in KINDS:
        value = F.col("oid").cast("string") if kind == "deletes" else F.col("feature")
        opening, closing = ('"', '"') if kind == "deletes" else ("[", "]")
        listed = texts(kind, value)
        parts.append(
            F.when(
                F.size(listed) > 0,
                F.concat(F.lit(f'"{kind}":{opening}'), F.array_join(listed, ","), F.lit(closing)),
            )
        )
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return features.groupBy("batch_id").agg(body.alias("body"))
