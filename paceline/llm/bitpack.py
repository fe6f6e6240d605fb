"""Token ids as files of fixed-width bits.

A shard file holds the documents of one range of doc_id, in ascending order:

    blocks     each of `block` ids (a multiple of 64) in `bits` bits, as little-endian 64-bit words; the last one filled up with zeros
    index      64-bit place in the file of each block
    documents  64-bit doc_id of each (null: the least), then the 64-bit place of its first id; one more place at the end
    trailer    magic "PLBP", then little-endian unsigned 32-bit: version, bits, ids in a block; 64-bit: ids, documents

Blocks have one size and begin at known places, so any document is read by unpacking only its blocks. Files are written
from front to back, as object stores ask for.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import id_and_text, materialize, text_partitions, workspace
from paceline.llm.tokens import encoder

MAGIC, TRAILER, BLOCK = b"PLBP", struct.Struct("<4sIIIQQ"), 4096
NULL_ID = -(1 << 63)
#: Tasks that read files at once, at most; more files than that share tasks.
READERS = 10_000
#: Times the usual limits of the tokenizer's memos.
MEMORY = 2


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids (a multiple of 64 of them) in `bits` bits each, as 64-bit words: 64 ids fill `bits` words."""
    rows = ids.astype(np.uint64).reshape(-1, 64)
    words = np.zeros((len(rows), bits), dtype=np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= rows[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= rows[:, k] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of pack(), as unsigned 32-bit integers."""
    rows = words.reshape(-1, bits)
    out = np.empty((len(rows), 64), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        x = rows[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (rows[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = x & mask
    return out.reshape(-1)


class ShardWriter:
    def __init__(self, sink, bits: int, block: int = BLOCK):
        self.sink, self.bits, self.block = sink, bits, block
        self.rest, self.held, self.ids, self.at, self.blocks = [], 0, 0, 0, []
        self.doc_ids: list[int] = []
        self.starts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NULL_ID if doc_id is None else doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.held += len(ids)
        self.rest.append(ids)
        if self.held >= 64 * self.block:
            self._flush(self.held // self.block * self.block)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        packed = pack(ids[:n], self.bits).astype("<u8", copy=False)  # blocks are whole words, so all of them are packed at once
        self.blocks += range(self.at, self.at + packed.nbytes, self.block * self.bits // 8)
        self.at += packed.nbytes
        self.sink.write(packed.tobytes())
        self.rest, self.held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        """Writes what is left, the indices and the trailer."""
        if self.held:
            self.rest.append(np.zeros(-self.held % self.block, np.uint32))
            self.held += len(self.rest[-1])
            self._flush(self.held)
        for values in (self.blocks, self.doc_ids, [*self.starts, self.ids]):
            self.sink.write(np.array(values, dtype="<i8").tobytes())
        self.sink.write(TRAILER.pack(MAGIC, 1, self.bits, self.block, self.ids, len(self.doc_ids)))


class ShardReader:
    """Random access to a shard: `source` is a file-like object."""

    def __init__(self, source):
        self.source = source
        source.seek(-TRAILER.size, 2)
        magic, _, self.bits, self.block, self.ids, self.docs = TRAILER.unpack(source.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of packed ids")
        n = -(-self.ids // self.block)
        source.seek(-TRAILER.size - 8 * (n + 2 * self.docs + 1), 2)
        tail = np.frombuffer(source.read(8 * (n + 2 * self.docs + 1)), dtype="<i8")
        self.blocks, self.doc_ids, self.starts = tail[:n], tail[n : n + self.docs], tail[n + self.docs :]

    def read(self, lo: int, hi: int) -> np.ndarray:
        """ids lo to hi (exclusive)."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        self.source.seek(int(self.blocks[first]))
        words = np.frombuffer(self.source.read((last - first + 1) * self.block * self.bits // 8), dtype="<u8")
        return unpack(words, self.bits)[lo - first * self.block : hi - first * self.block]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, place of the first id, ids) of every document, reading about `at_once` ids at a time."""
        k = 0
        while k < self.docs:
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + at_once, side="right")) - 1)
            lo = int(self.starts[k])
            ids = self.read(lo, int(self.starts[end]))
            for d in range(k, end):
                yield int(self.doc_ids[d]), int(self.starts[d]), ids[self.starts[d] - lo : self.starts[d + 1] - lo]
            k = end


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, label: str = "ids", chars: int = 16_000_000) -> DataFrame:
    """Encode whole texts, append end_id to each, and write shards in ascending order of doc_id under the shared folder.

    Returns the manifest, written already: shard, folder, name, documents, ids, start (ids of all shards before). The name
    is the task attempt's own, so a task that runs again never touches a file of another attempt, and the manifest alone says
    which files count. Rows that share a doc_id stand in an order fixed by their texts' hash; null ids come first and null
    texts are empty ones (one end id). An empty table gives an empty manifest. The text is dealt out by ranges of
    (doc_id, hash), so a doc_id that repeats may span shards."""
    spark = docs.sparkSession
    folder = workspace(spark, label)
    parts = text_partitions(docs, chars)
    keys = ["doc_id", "__order"]
    dealt = id_and_text(docs).withColumn("__order", F.xxhash64("text")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, MEMORY)
        bits = max(1, (max(encode.size, end_id + 1) - 1).bit_length())
        shard = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        path = f"{root}/{shard:06d}-{uuid.uuid4().hex}"
        end, out, sink = np.array([end_id], np.uint32), None, None
        for batch in batches:
            if out is None:
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(path)
                out = ShardWriter(sink, bits)
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, len(batch), 256):
                encoded = encode.encode(texts.slice(lo, 256).to_pylist())
                for doc_id, x in zip(ids.slice(lo, 256).to_pylist(), encoded, strict=True):
                    out.add(doc_id, np.concatenate([np.frombuffer(x, "<u4"), end]))
        if out is None:
            return
        out.close()
        sink.close()
        row = {"shard": shard, "name": path[len(root) + 1 :], "documents": len(out.doc_ids), "ids": out.ids}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int64()), ("name", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

    manifest = materialize(dealt.select("doc_id", "text").mapInArrow(write, "shard long, name string, documents long, ids long"), f"{label}-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return manifest.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long").alias("start"), F.lit(folder).alias("folder"))


def read_shards(manifest: DataFrame) -> DataFrame:
    """The documents of the files that a manifest names: doc_id, start, n_tokens, ids_crc32 (of all their ids as
    little-endian unsigned 32-bit integers), in the files' order within a shard. Files are dealt evenly to a task each, or
    to READERS tasks where there are more. An empty manifest gives an empty result; rows that share a doc_id stay apart."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, root = pafs.FileSystem.from_uri(row["folder"])
                with fs.open_input_file(f"{root}/{row['name']}") as f:
                    rows = [(None if d == NULL_ID else d, row["start"] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, at, ids in ShardReader(f).documents()]
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, min(manifest.count(), READERS))
    dealt = manifest.select("folder", "name", "start", "shard").repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    return dealt.select("folder", "name", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
