"""Token-id files under a canonical, length-limited Huffman code.

Writing: documents are range-partitioned and sorted by id, encoded once into chunks of
ids, and pinned. Ids are counted over all documents; package-merge over the counts (one
per vocabulary entry, so bounded by the vocabulary) gives code lengths of at most 16 bits,
and canonical codes follow from the lengths alone. Each chunk becomes one file:

    "QHF1", then uint32: documents, checkpoints, ids per checkpoint, payload words,
    crc32 of the payload; uint64: ids, index of the first id in the whole corpus;
    int64 document ids, uint8 null flags, uint64 ids per document,
    uint64 bit offset of every checkpoint, uint32 payload words (first bit highest).

``code.qhc`` holds the code: uint32 entries, then (uint32 id, uint8 length) in code order.
File names ascend with the document ids.

Reading: every file is decoded on its own with one table of 2**16 entries. Its checkpoints
are decoded side by side, one symbol of each per step.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiver.llm.common import bounded_batches, column, id_text, pin, text_steps
from quiver.llm.shared_files import write_file
from quiver.llm.tokens import Encoder, default_vocabulary
from quiver.session import shared_path

MAX_BITS = 16
LANE = 256  # ids per checkpoint
_HEAD = struct.Struct("<4s5I2Q")


# ---------------------------------------------------------------- the code

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge)."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.uint8)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit into codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.float64)
    # per level: which of the merged entries are leaves, in order of weight
    weights, kinds = leaf, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaf, pairs])
        by = np.argsort(both, kind="stable")
        weights = both[by]
        kinds.append(by < n)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for kind in reversed(kinds):
        leaves = int(kind[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.zeros(n, np.uint8)
    out[order] = lengths
    return out


class Code:
    """Canonical code: ``ids`` in code order with their ``lengths``."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        by = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[by].astype(np.uint32), lengths[by].astype(np.uint8)
        step = np.uint64(1) << (np.uint64(MAX_BITS) - self.lengths.astype(np.uint64))
        begin = np.cumsum(step) - step  # each code, left-aligned in MAX_BITS bits
        top = int(self.ids.max(initial=0)) + 1
        self.code_of, self.bits_of = np.zeros(top, np.uint64), np.zeros(top, np.uint8)
        self.code_of[self.ids], self.bits_of[self.ids] = begin, self.lengths
        pad = (1 << MAX_BITS) - int(step.sum())
        self.symbol_at = np.concatenate([np.repeat(self.ids, step.astype(np.int64)), np.zeros(pad, np.uint32)])
        self.bits_at = np.concatenate([np.repeat(self.lengths, step.astype(np.int64)), np.ones(pad, np.uint8)]
                                      ).astype(np.int64)

    def to_bytes(self) -> bytes:
        return struct.pack("<I", len(self.ids)) + self.ids.tobytes() + self.lengths.tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> "Code":
        n = struct.unpack_from("<I", raw)[0]
        return Code(np.frombuffer(raw, np.uint32, n, 4), np.frombuffer(raw, np.uint8, n, 4 + 4 * n))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Payload words and the bit offset of every LANE-th id."""
        bits = self.bits_of[ids].astype(np.int64)
        ends = np.cumsum(bits)
        at = ends - bits
        word, shift = at >> 5, (at & 31).astype(np.uint64)
        wide = self.code_of[ids] << (np.uint64(64 - MAX_BITS) - shift)
        words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
        if len(ids):
            new = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[new]] += np.add.reduceat(wide >> np.uint64(32), new)
            words[word[new] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), new)
        return words.astype(np.uint32), at[::LANE].astype(np.uint64)

    def decode(self, words: np.ndarray, checkpoints: np.ndarray, n: int, lane: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.uint32)
        pairs = np.append(words, np.zeros(2, np.uint32)).astype(np.uint64)
        pairs = (pairs[:-1] << np.uint64(32)) | pairs[1:]
        at = checkpoints.astype(np.int64)
        out = np.empty((lane, len(at)), np.uint32)
        last = len(pairs) - 1
        drop, mask = np.uint64(64 - MAX_BITS), np.uint64((1 << MAX_BITS) - 1)
        for k in range(lane):
            window = (pairs[np.minimum(at >> 5, last)] >> (drop - (at & 31).astype(np.uint64))) & mask
            out[k] = self.symbol_at[window]
            at = at + self.bits_at[window]
        return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- files

def _file(doc_ids, sizes, ids: np.ndarray, first: int, code: Code) -> list[bytes]:
    words, checkpoints = code.encode(ids)
    payload = words.astype("<u4").tobytes()
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    head = _HEAD.pack(b"QHF1", len(doc_ids), len(checkpoints), LANE, len(words), zlib.crc32(payload), len(ids), first)
    return [head, keys.tobytes(), nulls.tobytes(), np.asarray(sizes, "<u8").tobytes(),
            checkpoints.astype("<u8").tobytes(), payload]


def read_file(raw: bytes, code: Code) -> tuple[list, np.ndarray, np.ndarray, int]:
    """(document ids, ids per document, all ids, index of the first id) of one file."""
    magic, docs, marks, lane, n_words, crc, n, first = _HEAD.unpack_from(raw)
    at = _HEAD.size
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", marks), ("<u4", n_words)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += parts[-1].nbytes
    keys, nulls, sizes, checkpoints, words = parts
    if magic != b"QHF1" or zlib.crc32(words.tobytes()) != crc:
        raise ValueError("damaged token file")
    ids = code.decode(words, checkpoints, n, lane)
    return [None if z else int(k) for k, z in zip(keys, nulls)], sizes.astype(np.int64), ids, first


def write_token_files(docs: DataFrame, folder: str | None = None, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", vocabulary: str | None = None, chunk_bytes: int = 8_000_000) -> str:
    """Encode all documents in ascending id order (null ids first) and write the files;
    returns their folder. A null or empty text is its end id alone; repeated ids are
    separate documents, ordered by a hash of their texts; an empty table writes only the
    code file. Other columns are ignored."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = vocabulary or default_vocabulary()
    folder = folder or shared_path(spark, "llm-token-files")

    def encode(batches):
        from pyspark import TaskContext

        shard, encoder, earlier = TaskContext.get().partitionId(), Encoder.of(path), 0
        for chunk, step in enumerate(text_steps(batches, chunk_bytes)):
            ids, offsets = encoder.encode(column(step, "text"))
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4", copy=False)
            sizes = np.diff(offsets) + 1
            narrow = ids.max() < 1 << 16
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "chunk": chunk, "earlier": earlier, "doc_ids": column(step, "doc_id").to_pylist(),
                  "sizes": sizes.tolist(), "n": len(ids), "width": 2 if narrow else 4,
                  "ids": (ids.astype("<u2") if narrow else ids).tobytes()}], schema=_CHUNK)
            earlier += len(ids)

    # rows of one id, nulls above all, are told apart by their text's hash, so they may lie in many ranges
    placed = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    chunks = pin(placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
                 .select("doc_id", "text").mapInArrow(encode, "shard int, chunk int, earlier long, doc_ids array<long>, sizes array<long>, "
                                     "n long, width int, ids binary"), "token-chunks")

    bounded_batches(spark, 1)  # a row is a chunk from here on

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw, width in zip(batch.column("ids"), batch.column("width").to_pylist()):
                seen = np.bincount(np.frombuffer(raw.as_buffer(), f"<u{width}"))
                if len(seen) > len(total):
                    seen, total = total, seen
                total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    counts = (chunks.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id")
              .agg(F.sum("n").alias("n")).orderBy("id").toPandas())  # at most one row per vocabulary entry
    ids, n = counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    code = Code(ids, code_lengths(n)) if len(ids) else Code(np.zeros(0, np.int64), np.zeros(0, np.uint8))
    write_file(folder, "code.qhc", [code.to_bytes()])

    # one row per shard: the window over them and the broadcast are bounded by the number of partitions
    shards = pin(chunks.groupBy("shard").agg(F.sum("n").alias("ids_in_shard"))
                 .select("shard", F.coalesce(F.sum("ids_in_shard").over(
                     Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")),
                 "token-shards")
    shared = spark.sparkContext.broadcast(code.to_bytes())

    def write(batches):
        code = Code.from_bytes(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                got = {name: batch.column(name)[row] for name in ("shard", "chunk", "width", "earlier", "before", "ids")}
                ids = np.frombuffer(got["ids"].as_buffer(), f"<u{got['width'].as_py()}")
                parts = _file(batch.column("doc_ids")[row].as_py(), batch.column("sizes")[row].as_py(), ids,
                              got["before"].as_py() + got["earlier"].as_py(), code)
                name = f"{got['shard'].as_py():07d}-{got['chunk'].as_py():07d}.qhf"
                write_file(folder, name, parts)
                yield pa.RecordBatch.from_pydict({"name": [name]})

    (chunks.join(F.broadcast(shards), "shard").mapInArrow(write, "name string")
     .write.format("noop").mode("overwrite").save())
    return folder


_CHUNK = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("earlier", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked,
    the ids (little-endian uint32)."""
    bounded_batches(spark, 2)
    raw = spark.read.format("binaryFile").load(f"{folder}/code.qhc").select("content").head()[0]
    shared = spark.sparkContext.broadcast(bytes(raw))

    def decode(batches):
        code = Code.from_bytes(shared.value)
        for batch in batches:
            for content in batch.column("content"):
                docs, sizes, ids, first = read_file(content.as_buffer(), code)
                ends = np.cumsum(sizes)
                cuts = list(zip((ends - sizes).tolist(), ends.tolist()))
                ids = ids.astype("<u4", copy=False)
                out = {"doc_id": pa.array(docs, pa.int64()), "start": pa.array(first + ends - sizes, pa.int64()),
                       "n_tokens": pa.array(sizes, pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in cuts], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].tobytes() for a, b in cuts], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.qhf").load(folder).select("content"))
    return files.mapInArrow(decode, schema)
