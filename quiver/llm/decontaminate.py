"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by size: class c holds items of 2**c to 2**(c+1) - 1 words. For each
class present, documents are cut into blocks of 2**(c+1) words, and every two neighbouring
blocks are a segment. A run as long as any item of the class lies whole in one segment, and
segment and item sizes stay comparable however long the document is.

Items and segments are sketched by one permutation: shingles are hashed into bins and each
bin keeps its smallest value; a segment's bin is the smaller one of its blocks'. An item is
a candidate where one of its bins equals the segment's. The number of bins of a class is
chosen so that an item with ``percent`` of its shingles in a segment is missed with a chance
of about ``MISS``: a shared shingle is hidden by a smaller one of its bin with a chance of
half the shingles per bin. Where that takes more than ``MOST_BINS`` bins (items of very few
shingles), every shingle has a bin of its own and nothing is missed.

Candidates (document, item) are then verified exactly: the item's distinct shingles that
occur anywhere in the document are counted, and containment must reach ``percent``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import (NULL_KEY, among_bits, bit_filter, bounded_batches, column, drop_keys, hashed_key_bits,
                               id_text, maybe_in, mix64, ngram_hashes, pin, shingle_sets, text_key, text_steps, word_hashes)

MISS = 1e-6
MOST_BINS = 2048
_CELLS = 1 << 16  # bins held at a time: they stay in a core's cache
_EMPTY = np.uint64(2 ** 64 - 1)


def bins_of(c: int, words: int = 5, percent: int = 80) -> int:
    """Bins per sketch of size class ``c``; 0: every shingle has its own."""
    item = max(2 ** c - words + 1, 1)
    shared = math.ceil(percent / 100 * item)
    per_bin = min(0.5, 2 * MISS ** (1 / shared))
    bins = math.ceil(2 ** (c + 2) / per_bin)
    return bins if bins <= MOST_BINS else 0


def _values(shingles: np.ndarray, c: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(shingles + np.uint64(0x9E3779B97F4A7C15 * (c + 1) % 2 ** 64))
    return ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64), x * np.uint64(0xD6E8FEB86659FD93)


def _bin_keys(minima: np.ndarray, c: int) -> np.ndarray:
    """Keys of (class, bin, value) for (n, bins) minima; empty bins have keys too."""
    lanes = mix64(np.arange(1, minima.shape[1] + 1, dtype=np.uint64) * np.uint64(64) + np.uint64(c))
    return minima ^ lanes[None, :]


def sketch_keys(shingles: np.ndarray, c: int, bins: int) -> np.ndarray:
    """All keys of one item's sketch."""
    if not bins:
        return mix64(shingles + np.uint64(c))
    cell, value = _values(shingles, c, bins)
    minima = np.full((1, bins), _EMPTY, np.uint64)
    np.minimum.at(minima[0], cell, value)
    return _bin_keys(minima, c)[minima != _EMPTY]


def segment_hits(hashed: np.ndarray, offsets: np.ndarray, c: int, words: int, bins: int, bits: np.ndarray):
    """(text, key) pairs of segment keys that the filter lets through, in pieces."""
    counts = np.diff(offsets)
    grams = ngram_hashes(hashed, words)
    owner = np.repeat(np.arange(len(counts)), counts)[: len(grams)]
    place = np.arange(len(grams))
    inside = place + words <= offsets[1:][owner]
    grams, owner, place = grams[inside], owner[inside], place[inside]
    if not bins:
        keys = mix64(grams + np.uint64(c))
        hit = among_bits(bits, keys)
        yield owner[hit], keys[hit]
        return
    size = 2 ** (c + 1)
    per = -(-counts // size)
    base = np.cumsum(per) - per
    block = base[owner] + (place - offsets[:-1][owner]) // size
    total = int(per.sum())
    text = np.repeat(np.arange(len(counts)), per)
    cell, value = _values(grams, c, bins)
    step = max(_CELLS // bins, 2)
    for a in range(0, total, step):
        b = min(a + step + 1, total)  # one block more: the last segment's second
        lo, hi = np.searchsorted(block, [a, b])
        minima = np.full((b - a, bins), _EMPTY, np.uint64)
        np.minimum.at(minima.reshape(-1), (block[lo:hi] - a) * bins + cell[lo:hi], value[lo:hi])
        pair = text[a: b - 1] == text[a + 1: b]
        minima[:-1][pair] = np.minimum(minima[:-1], minima[1:])[pair]
        minima = minima[: min(step, total - a)]
        rows, lanes = np.nonzero(among_bits(bits, keys := _bin_keys(minima, c)) & (minima != _EMPTY))
        yield text[a + rows], keys[rows, lanes]


def contaminated(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                 log2_bits: int = 22) -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, item_shingles, shared,
    containment. Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z. Items of fewer than
    ``words`` words are no evidence and never found; null or empty texts hold nothing; rows
    that repeat an id count as one document or item; empty tables give no rows; other
    columns are ignored."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keyed = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("node"), "text")
    tests = id_text(items, item_id_col, item_text_col).select(
        F.coalesce("doc_id", F.lit(NULL_KEY)).alias("item"), "text")

    def read_items(batches):
        for step in text_steps(batches):
            hashed, offsets = word_hashes(column(step, "text"), lower=True)
            flat, ends = shingle_sets(hashed, offsets, words)
            for i, item in enumerate(column(step, "item").to_pylist()):
                n = int(offsets[i + 1] - offsets[i])
                if n < words:
                    continue
                c = n.bit_length() - 1
                own = flat[ends[i]: ends[i + 1]]
                keys = sketch_keys(own, c, bins_of(c, words, percent))
                yield pa.RecordBatch.from_pylist([{"item": item, "class": c, "shingles": own.view(np.int64).tolist(),
                                                   "keys": keys.view(np.int64).tolist()}], schema=_ITEM)

    read = pin(tests.mapInArrow(read_items, "item long, class int, shingles array<long>, keys array<long>"), "items")
    item_shingles = pin(read.select("item", F.explode("shingles").alias("shingle")).distinct(), "item-shingles")
    item_keys = read.select("item", F.explode("keys").alias("key")).distinct()
    classes = sorted(r[0] for r in read.select("class").distinct().collect())  # at most one per power of two
    key_bits = spark.sparkContext.broadcast(hashed_key_bits(F.col("key"), item_keys, log2_bits))
    shingle_bits = spark.sparkContext.broadcast(hashed_key_bits(F.col("shingle"), item_shingles, log2_bits))

    def search(batches):
        bits = key_bits.value
        for step in text_steps(batches):
            nodes = column(step, "node").to_numpy()
            hashed, offsets = word_hashes(column(step, "text"), lower=True)
            for c in classes:
                for text, keys in segment_hits(hashed, offsets, c, words, bins_of(c, words, percent), bits):
                    if len(text):
                        found = np.unique(np.stack([nodes[text], keys.view(np.int64)]), axis=1)
                        yield pa.RecordBatch.from_pydict({"node": found[0], "key": found[1]})

    hits = keyed.mapInArrow(search, "node long, key long")
    candidates = pin(hits.join(item_keys, "key").select("node", "item").distinct(), "leak-candidates")

    def shared(batches):
        bits = shingle_bits.value
        for step in text_steps(batches):
            flat, ends = shingle_sets(*word_hashes(column(step, "text"), lower=True), words)
            owner = np.repeat(column(step, "node").to_numpy(), np.diff(ends))
            keep = among_bits(bits, flat)
            yield pa.RecordBatch.from_pydict({"node": owner[keep], "shingle": flat[keep].view(np.int64)})

    suspects = keyed.where(maybe_in(bit_filter(F.col("node"), candidates), F.col("node")))
    counted = (suspects.mapInArrow(shared, "node long, shingle long").distinct().join(item_shingles, "shingle")
               .groupBy("node", "item").agg(F.count(F.lit(1)).alias("shared"))
               .join(candidates, ["node", "item"], "left_semi"))
    sizes = item_shingles.groupBy("item").agg(F.count(F.lit(1)).alias("item_shingles"))
    return (counted.join(sizes, "item").where(100 * F.col("shared") >= percent * F.col("item_shingles"))
            .select(F.when(F.col("node") != NULL_KEY, F.col("node")).alias("doc_id"),
                    F.when(F.col("item") != NULL_KEY, F.col("item")).alias("item_id"), "item_shingles", "shared",
                    (F.col("shared") / F.col("item_shingles")).alias("containment")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` with all its columns, without the rows whose own text holds an item. Rows
    that share an id, or have none, are each judged by their own text."""
    own = docs.select(text_key(F.col(id_col), F.col(text_col)).alias("doc_id"), F.col(text_col).alias("text"))
    return drop_keys(docs, id_col, text_col, contaminated(own, items, **options).select("doc_id"))


_ITEM = pa.schema([("item", pa.int64()), ("class", pa.int32()), ("shingles", pa.list_(pa.int64())),
                   ("keys", pa.list_(pa.int64()))])
