"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of a range of documents, end to end. 128 ids are a block: its minimum
is subtracted, the differences are packed at the width that holds nine in ten of them, and
the ones that do not fit are kept whole in an exception list. An index at the end has where
each block starts, so any range of ids is read without the rest, and where each document
starts. Layout, little-endian:

    blocks     per block: u32 minimum, u8 width, u8 ids, u8 exceptions, then the packed
               differences, u8 positions and u32 values of the exceptions
    block index  u64 offset of every block
    document index  i64 id (null: smallest), u64 first id, for every document
    footer     u64 ids, u64 blocks, u64 documents, magic

Documents are dealt by range of (doc_id, digest of the text), so file order is id order.
A writing task names its file anew on each attempt and reports it as a row; only reported
files count, so a lost executor leaves at most a file that nobody reads.

Null and empty texts have the end id alone. Repeated ids stay separate documents, in order
of their texts. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices_by_size, texts_of
from lamina.llm.units import AT_ONCE as TEXT_AT_ONCE
from lamina.llm.units import IDS, IdEncoder, of_worker
from lamina.session import Staging, shared_folder

BLOCK = 128
AT_ONCE = 512 * BLOCK
#: Share of a block's differences that its width must hold.
FITTING = 0.9
MAGIC = b"LMPFOR01"
NO_ID = -(1 << 63)
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("ids", "u1"), ("odd", "u1")])
FOOT = np.dtype([("ids", "<u8"), ("blocks", "<u8"), ("docs", "<u8"), ("magic", "S8")])
DOC = np.dtype([("id", "<i8"), ("start", "<u8")])


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2**width as rows of 16 * width bytes, in four interleaved lanes."""
    lanes = values.reshape(len(values), 32, 4)
    words = np.zeros((len(values), width, 4), np.uint32)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        words[:, word] |= lanes[:, i] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= lanes[:, i] >> np.uint32(32 - shift)
    return words.reshape(len(values), width * 4).view(np.uint8)


def unpack_bits(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(packed).view(np.uint32).reshape(len(packed), width, 4)
    lanes = np.zeros((len(packed), 32, 4), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | words[:, word + 1] << np.uint32(32 - shift)
        lanes[:, i] = value & mask
    return lanes.reshape(len(packed), BLOCK)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """One byte string per block of up to 128 ids."""
    n, count = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return []
    wide = np.full(count * BLOCK, ids[-1], np.uint32)
    wide[:n] = ids
    wide = wide.reshape(count, BLOCK)
    low = wide.min(axis=1)
    over = wide - low[:, None]
    fitting = np.partition(over, int(BLOCK * FITTING) - 1, axis=1)[:, int(BLOCK * FITTING) - 1]
    widths = np.ceil(np.log2(fitting.astype(np.float64) + 1)).astype(np.uint8)
    large = (over.astype(np.uint64) >> widths[:, None].astype(np.uint64)) != 0
    large.ravel()[n:] = False
    heads = np.empty(count, HEAD)
    heads["low"], heads["width"], heads["ids"] = low, widths, BLOCK
    heads["ids"][-1] = n - (count - 1) * BLOCK
    heads["odd"] = large.sum(axis=1)
    head_bytes = heads.tobytes()
    places = np.nonzero(large)[1].astype(np.uint8).tobytes()
    values = over[large].tobytes()
    ends = np.cumsum(heads["odd"].astype(np.int64)).tolist()
    out: list[bytes] = [b""] * count
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        mask = np.uint32((1 << width) - 1)
        packed, size = pack_bits(over[rows] & mask, width).tobytes(), 16 * width
        for at, row in enumerate(rows.tolist()):
            low_odd, high_odd = ends[row - 1] if row else 0, ends[row]
            out[row] = (
                head_bytes[row * HEAD.itemsize : (row + 1) * HEAD.itemsize]
                + packed[at * size : (at + 1) * size]
                + places[low_odd:high_odd]
                + values[4 * low_odd : 4 * high_odd]
            )
    return out


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    if not len(starts):
        return np.empty(0, IDS)
    heads = raw[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).ravel()
    out = np.empty((len(starts), BLOCK), np.uint32)
    sizes = heads["width"].astype(np.int64) * 16
    for width in np.unique(heads["width"]).tolist():
        rows = np.flatnonzero(heads["width"] == width)
        body = raw[(starts[rows] + HEAD.itemsize)[:, None] + np.arange(16 * width)]
        out[rows] = unpack_bits(body, width)
    odd = heads["odd"].astype(np.int64)
    if odd.any():
        row = np.repeat(np.arange(len(starts)), odd)
        nth = np.arange(odd.sum()) - np.repeat(np.cumsum(odd) - odd, odd)
        at = (starts + HEAD.itemsize + sizes)[row]
        value_at = (at + odd[row] + 4 * nth)[:, None] + np.arange(4)
        out[row, raw[at + nth]] = raw[value_at].view("<u4")[:, 0]
    out += heads["low"][:, None]
    return out[np.arange(BLOCK) < heads["ids"][:, None]].astype(IDS, copy=False)


class Writer:
    """Appends documents to one file; memory holds a few blocks and the two indexes."""

    def __init__(self, uri: str):
        self.fs, path = pa.fs.FileSystem.from_uri(uri)
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        self.out = self.fs.open_output_stream(path)
        self.waiting: list[bytes] = []
        self.n_waiting = self.ids = self.written = 0
        self.blocks: list[np.ndarray] = []
        self.docs: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, self.ids))
        self.ids += len(ids) // IDS.itemsize
        self.waiting.append(ids)
        self.n_waiting += len(ids) // IDS.itemsize
        if self.n_waiting >= AT_ONCE:
            self.flush(whole_blocks=True)

    def flush(self, whole_blocks: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), IDS)
        cut = len(ids) // BLOCK * BLOCK if whole_blocks else len(ids)
        for at in range(0, cut, AT_ONCE):
            packed = pack_blocks(ids[at : min(cut, at + AT_ONCE)])
            sizes = np.array([len(b) for b in packed], np.uint64)
            self.blocks.append(np.uint64(self.written) + np.cumsum(sizes) - sizes)
            self.written += int(sizes.sum())
            self.out.write(b"".join(packed))
        self.waiting = [ids[cut:].tobytes()]
        self.n_waiting = len(ids) - cut

    def close(self) -> None:
        self.flush(whole_blocks=False)
        blocks = np.concatenate([np.empty(0, np.uint64), *self.blocks]).astype("<u8")
        foot = np.array([(self.ids, len(blocks), len(self.docs), MAGIC)], FOOT)
        self.out.write(blocks.tobytes() + np.array(self.docs, DOC).tobytes() + foot.tobytes())
        self.out.close()


class Reader:
    """Reads any range of a file's ids by its block index."""

    def __init__(self, uri: str):
        fs, path = pa.fs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        foot = np.frombuffer(self.file.read_at(FOOT.itemsize, size - FOOT.itemsize), FOOT)[0]
        if foot["magic"] != MAGIC:
            raise ValueError(f"{uri} is no id file")
        self.n, blocks, docs = int(foot["ids"]), int(foot["blocks"]), int(foot["docs"])
        at = size - FOOT.itemsize - docs * DOC.itemsize - blocks * 8
        self.end = at
        self.blocks = np.frombuffer(self.file.read_at(blocks * 8, at), "<u8").astype(np.int64)
        self.docs = np.frombuffer(self.file.read_at(docs * DOC.itemsize, at + blocks * 8), DOC)

    def read(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.empty(0, IDS)
        first, last = start // BLOCK, -(-stop // BLOCK)
        low = int(self.blocks[first])
        high = int(self.blocks[last]) if last < len(self.blocks) else self.end
        ids = unpack_blocks(self.file.read_at(high - low, low), self.blocks[first:last] - low)
        return ids[start - first * BLOCK : stop - first * BLOCK]

    def documents(self):
        """(id, start, ids) of every document, reading about ``AT_ONCE`` ids at a time."""
        starts = [*self.docs["start"].astype(np.int64).tolist(), self.n]
        low, held = 0, np.empty(0, IDS)
        for k, doc_id in enumerate(self.docs["id"].tolist()):
            start, stop = starts[k], starts[k + 1]
            if stop > low + len(held):
                low, held = start, self.read(start, min(self.n, max(stop, start + AT_ONCE)))
            yield None if doc_id == NO_ID else doc_id, start, held[start - low : stop - low]


def write_ids(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, staging: Staging | None = None
) -> DataFrame:
    """Write the ids of all documents below ``folder``; returns the written list of files:
    file, uri, n_docs, n_ids, start (ids in all files before it)."""

    def run(batches):
        encoder, writer, uri = of_worker(IdEncoder, path), None, ""
        end = np.array([end_id], IDS).tobytes()
        for batch in slices_by_size(batches, "text", 2000, TEXT_AT_ONCE):
            if writer is None:
                uri = f"{folder}/ids-{uuid.uuid4().hex}.pfor"
                writer = Writer(uri)
            ids = encoder.encode_all(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids):
                writer.add(doc_id, own.tobytes() + end)
        if writer is not None:
            from pyspark import TaskContext

            writer.close()
            row = [TaskContext.get().partitionId(), uri, len(writer.docs), writer.ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in row], names=["file", "uri", "n_docs", "n_ids"]
            )

    ordered = (
        texts_of(docs)
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    written = ordered.mapInArrow(run, "file long, uri string, n_docs long, n_ids long")
    files = (staging or Staging(docs.sparkSession)).write(written, "id-files")
    # One short row per writing task, whatever the documents are.
    listed = files.toPandas().sort_values("file", ignore_index=True)
    listed["start"] = listed["n_ids"].cumsum() - listed["n_ids"]
    return docs.sparkSession.createDataFrame(
        listed, "file long, uri string, n_docs long, n_ids long, start long"
    )


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of every document."""
    return _per_document(files, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def id_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from its file."""
    return _per_document(files, "ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())


def _per_document(files: DataFrame, column: str, value, kind) -> DataFrame:
    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                held = []
                for doc_id, start, ids in Reader(uri).documents():
                    held.append((doc_id, base + start, len(ids), value(ids)))
                    if len(held) == 1000:
                        yield as_batch(held)
                        held = []
                if held:
                    yield as_batch(held)

    def as_batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), kind]
        arrays = [pa.array(v, t) for v, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(
            arrays, names=["doc_id", "start", "n_tokens", column.split()[0]]
        )

    dealt = files.repartition(max(2, files.count()), "file")
    return dealt.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def output_folder(spark, label: str) -> str:
    """A new folder's URI below the shared folder."""
    folder = shared_folder(spark)
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{os.path.abspath(folder)}"
    return f"{folder}/lamina/{label}-{uuid.uuid4().hex}"
