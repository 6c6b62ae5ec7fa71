"""Packing of documents into sequences along a space-filling curve.

A document's tokens are hashed to random signs, which projects its hashed count vector to
three dimensions. The three numbers, centred and scaled by the corpus, are cells of a grid,
and the cell's place on the Hilbert curve is the document's key: near documents get near
keys. The documents are range-sorted by it and laid end to end in that order; every 2,048
ids are one sequence, so neighbours along the curve share sequences. Only the rest of each
range is shorter: it is cut into sequences of a power of two, which need no padding.

Null and empty texts are the end id alone. Equal documents have equal keys and are told
apart by id, so a large group of copies is split over ranges like any others; repeated ids
are packed one by one. An empty table packs into nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices_by_size, texts_of
from lamina.llm.units import AT_ONCE, IDS, IdEncoder, of_worker
from lamina.session import Staging

LENGTH = 2048
DIMENSIONS, BITS = 3, 10
STORED = np.dtype("<u2")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def signs(vocabulary: int) -> np.ndarray:
    """+1 or -1 per token and dimension, from a hash of the token."""
    bits = mix(np.arange(1, vocabulary + 1))[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)
    return ((bits & np.uint64(1)).astype(np.int8) * 2 - 1).astype(np.int8)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each row of grid coordinates below 2**bits.

    From the highest bit down, the axes are reflected and exchanged as the sub-cube there
    is; the bits met on the way are then in Gray code order, which is undone at the end.
    """
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for d in range(n):
            reflect = (x[d] & bit) != 0
            swap = np.where(reflect, 0, (x[0] ^ x[d]) & below)
            x[0] = np.where(reflect, x[0] ^ below, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    carry = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        carry ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | ((x[d] ^ carry) >> level & 1)
    return key


def encoded(docs: DataFrame, path: str, end_id: int, staging: Staging) -> DataFrame:
    """doc_id, ids (16-bit) and the projection v0, v1, v2 of every document, written once."""
    names = [f"v{d}" for d in range(DIMENSIONS)]

    def run(batches):
        encoder = of_worker(IdEncoder, path, True)
        table = signs(1 << 16)
        for batch in slices_by_size(batches, "text", 2000, AT_ONCE):
            ids, points = [], np.zeros((batch.num_rows, DIMENSIONS))
            for row, own in enumerate(encoder.encode_all(batch.column("text"))):
                if len(own):
                    points[row] = table[own].sum(axis=0, dtype=np.int64) / len(own)
                ids.append(np.append(own, end_id).astype(STORED).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), *map(pa.array, points.T)],
                names=["doc_id", "ids", *names],
            )

    kind = "doc_id long, ids binary, " + ", ".join(f"{n} double" for n in names)
    return staging.write(texts_of(docs).mapInArrow(run, kind), "packing-ids")


def with_key(points: DataFrame) -> DataFrame:
    """doc_id, ids and ``key``: the place on the curve, by the corpus's own centre and spread."""
    names = [f"v{d}" for d in range(DIMENSIONS)]
    found = points.agg(
        *[F.avg(n).alias(f"m{n}") for n in names], *[F.stddev_pop(n).alias(f"s{n}") for n in names]
    ).first()
    middle = [found[f"m{n}"] or 0.0 for n in names]
    spread = [found[f"s{n}"] or 1.0 for n in names]

    def run(batches):
        for batch in batches:
            at = (np.column_stack([batch.column(n).to_numpy() for n in names]) - middle) / spread
            cells = ((at + 3) / 6 * (1 << BITS)).clip(0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(hilbert(cells))],
                names=["doc_id", "ids", "key"],
            )

    return points.mapInArrow(run, "doc_id long, ids binary, key long")


def powers(rest: int) -> list[int]:
    """``rest`` as powers of two, largest first."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(ordered: DataFrame, length: int, payload: bool) -> DataFrame:
    """Lays the rows of each partition end to end and cuts them into sequences.

    A sequence's id is the partition's number and a count within it. One document and one
    sequence are in memory at a time.
    """
    last = "ids binary" if payload else "ids_crc32 long"

    def run(batches):
        from pyspark import TaskContext

        base, sequence, offset = TaskContext.get().partitionId() << 40, 0, 0
        waiting: list[tuple] = []  # pieces of the sequence being filled
        done: list[tuple] = []

        def settle(lengths):
            """Close the waiting pieces as sequences of the given lengths."""
            nonlocal waiting, sequence
            parts, at = iter(lengths), 0
            room = next(parts)
            for doc_id, start, own, total in waiting:
                while len(own):
                    taken = own[: room - at]
                    value = taken.astype(IDS).tobytes()
                    done.append(
                        (doc_id, start, len(taken), value if payload else zlib.crc32(value), total,
                         base + sequence, at)
                    )
                    start, own, at = start + len(taken), own[len(taken) :], at + len(taken)
                    if at == room:
                        sequence, at, room = sequence + 1, 0, next(parts, 0)
            waiting = []

        for batch in batches:
            columns = (batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist())
            for doc_id, data in zip(*columns):
                ids, start = np.frombuffer(data, STORED), 0
                while start < len(ids):
                    own = ids[start : start + length - offset]
                    waiting.append((doc_id, start, own, len(ids)))
                    start, offset = start + len(own), offset + len(own)
                    if offset == length:
                        settle([length])
                        offset = 0
                    if len(done) >= 5000:
                        yield as_batch(done)
                        done.clear()
        if waiting:
            settle(powers(offset))
        if done:
            yield as_batch(done)

    names = ["doc_id", "start", "length", last.split()[0], "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64()] * 3 + [pa.binary() if payload else pa.int64()] + [pa.int64()] * 3

    def as_batch(rows):
        arrays = [pa.array(v, t) for v, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return ordered.mapInArrow(
        run,
        f"doc_id long, start long, length long, {last}, doc_tokens long, sequence_id long, "
        "offset long",
    )


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    length: int = LENGTH,
    payload: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids or their crc32, doc_tokens,
    sequence_id, offset."""
    points = encoded(docs, path, end_id, staging or Staging(docs.sparkSession))
    keyed = with_key(points)
    order = ["key", "doc_id", F.crc32("ids")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return pack(ordered.select("doc_id", "ids"), length, payload)
