"""Helpers shared by the training-data operators: input clean-up, pinned tables,
bounded bit filters and vectorised word hashing of Arrow text columns."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.session import shared_path

NULL_KEY = 2 ** 63 - 1  # stands for a null id, so that it sorts last and joins with itself

#: Text per Python step: Arrow batches are cut so that the arrays built from one stay bounded.
STEP_BYTES = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark scan of one table, of a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): other columns are left out so their names cannot clash;
    a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Fewer rows per Arrow batch than Spark's 10,000, since texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, several
    readers see the same rows, and lost executors do not lose them."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def suspects_of(docs: DataFrame, key: Column, keys: DataFrame, key_col: str, log2_bits: int = 22):
    """``docs`` in two parts: rows whose key is in ``keys`` for certain not, and the others.
    Only the others need a join, so the texts of most rows are never shuffled."""
    maybe = maybe_in(bit_filter(F.col(key_col), keys, log2_bits), key)
    return docs.where(~maybe), docs.where(maybe)


def text_key(id_column: Column, text_column: Column) -> Column:
    """63-bit hash of a row's id and text (null ids are one value, a null text is empty): rows
    that repeat an id are told apart, rows that repeat id and text are one."""
    return F.xxhash64(F.coalesce(id_column.cast("long"), F.lit(NULL_KEY)),
                      F.coalesce(text_column, F.lit(""))).bitwiseAND(F.lit(NULL_KEY))


def drop_keys(docs: DataFrame, id_col: str, text_col: str, decisions: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text_key is in ``decisions`` (column ``doc_id``)."""
    own = text_key(F.col(id_col), F.col(text_col))
    return drop_ids(docs.withColumn("_text_key", own), "_text_key", decisions).drop("_text_key")


def drop_ids(docs: DataFrame, id_col: str, decisions: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``decisions`` (column ``doc_id``, nulls match)."""
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY))
    d = pin(decisions.select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("_drop_id")).distinct(), "dropped-ids")
    clear, suspects = suspects_of(docs, own, d, "_drop_id")
    return clear.unionByName(suspects.join(d, own == F.col("_drop_id"), "left_anti"))


# ---------------------------------------------------------------- bounded bit filter

def _bit_of(key: Column, log2_bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << log2_bits))


def bit_filter(keys: Column, of: DataFrame, log2_bits: int = 22) -> Column:
    """The scalar value of a filter over ``of``'s column ``keys``: 2**log2_bits bits as an
    array of longs. Its size is fixed by the parameter, whatever the number of keys; a
    fuller filter only lets more rows through, and the callers check exactly afterwards."""
    return _packed_bits(of.select(_bit_of(keys, log2_bits).alias("_b")), log2_bits).scalar()


def hashed_key_bits(keys: Column, of: DataFrame, log2_bits: int = 22) -> np.ndarray:
    """The same filter over keys that are hashes already, for use in Python tasks: bit
    ``key & (2**log2_bits - 1)`` of a uint64 array, whose size the parameter fixes."""
    bits = of.select(F.pmod(keys, F.lit(1 << log2_bits)).alias("_b"))
    packed = _packed_bits(bits, log2_bits).toArrow().column(0).combine_chunks()
    return packed.values.to_numpy().view(np.uint64).copy()


def among_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which uint64 ``keys`` may be in the filter."""
    at = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _packed_bits(bits: DataFrame, log2_bits: int) -> DataFrame:
    bit = bits.distinct()
    words = bit.groupBy(F.shiftright("_b", 6).cast("int").alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_b & 63 as int))")).alias("_v"))
    every = bits.sparkSession.range(1 << (log2_bits - 6)).select(F.col("id").cast("int").alias("_w"))
    packed = (every.join(words, "_w", "left")
              .groupBy().agg(F.sort_array(F.collect_list(F.struct("_w", F.coalesce("_v", F.lit(0)).alias("_v"))))
                             .alias("_a")))
    return packed.select(F.col("_a._v").alias("_f"))


def maybe_in(filter_value: Column, key: Column, log2_bits: int = 22) -> Column:
    """True if ``key`` may be in the filter; never false for a key that is."""
    b = _bit_of(key, log2_bits)
    word = F.get(filter_value, F.shiftright(b, 6).cast("int"))
    return F.getbit(word, b.bitwiseAND(F.lit(63)).cast("int")) == 1


# ---------------------------------------------------------------- words of Arrow text

def text_steps(batches, limit: int = STEP_BYTES):
    """Arrow record batches regrouped so that each holds about ``limit`` bytes of ``text``
    (a longer single text stays whole)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64()))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + limit - size, side="right"))
            stop = max(stop, start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1] - base)
            if stop < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            start = stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    held = None
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: a Python worker lives on
    for other tasks, and what its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def column(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name)
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array, lower: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text as one dictionary array, and the
    offsets of each text's words in it. ``lower`` folds A-Z only."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not keep.all():  # leading or trailing white space gives empty pieces
        before = np.concatenate([[0], np.cumsum(keep)])
        offsets = before[offsets]
        flat = flat.filter(pa.array(keep))
    return flat.dictionary_encode(), offsets


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2 ** 64 - 1], np.uint64)  # first k bytes of eight
_LONG = 512  # bytes; longer words are hashed one by one


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes end to end, and each text's offsets in them."""
    texts = texts.cast(pa.large_string())
    _, offs, data = texts.buffers()
    at = np.frombuffer(offs, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` of the texts, and the texts' offsets in
    them. Eight bytes of all words are mixed in at a time."""
    raw, at = text_bytes(texts)
    n = len(raw)
    data = np.zeros(n + 8, np.uint8)
    data[:n] = _LOWER[raw] if lower else raw
    space = _SPACE[raw]
    first = np.zeros(n + 1, bool)
    first[at] = True  # a text's first byte starts a word, and ends the one before
    edge = np.ones(n + 1, bool)
    edge[1:n] = space[:-1] if n else True
    edge |= first
    starts = np.flatnonzero(edge[:n] & ~space)
    stop = first.copy()
    stop[:n] |= space
    ends = np.flatnonzero(stop[1:] & ~space) + 1
    left = ends - starts
    words = np.ndarray((n + 1,), "<u8", data, strides=(1,))  # the eight bytes from each place on
    h = mix64(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    h = mix64(h ^ (words[starts] & _KEEP[np.minimum(left, 8)]))
    rows = np.flatnonzero((left > 8) & (left <= _LONG))
    done = 8
    while len(rows):
        chunk = words[starts[rows] + done] & _KEEP[np.minimum(left[rows] - done, 8)]
        h[rows] = mix64(h[rows] ^ chunk)
        done += 8
        rows = rows[left[rows] > done]
    for i in np.flatnonzero(left > _LONG):
        h[i] = _short_hash(data[starts[i]: ends[i]])
    return h, np.searchsorted(starts, at).astype(np.int64)


_M = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on (positions up to len - n)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        h *= _M
        h ^= h >> np.uint64(29)
        h += words[k: len(words) - n + 1 + k]
    return mix64(h)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingle hashes of each text, ascending, flat, with offsets.
    A text of 1 to n-1 words has its whole word sequence as one shingle."""
    counts = np.diff(offsets)
    grams = ngram_hashes(words, n)
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(sizes)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    for i, (size, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
        if not size:
            continue
        a = int(offsets[i])
        part = flat[end - size: end]
        if counts[i] >= n:
            part[:] = grams[a: a + size]
            part.sort()
        else:
            part[0] = _short_hash(words[a: a + int(counts[i])])
    if not len(flat):
        return flat, np.zeros(len(counts) + 1, np.int64)
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    return flat[new], np.concatenate([[0], np.cumsum(new)[ends - 1] * (ends > 0)]).astype(np.int64)


def _short_hash(words: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(words.tobytes(), 0x5A17)
