"""Repeated word windows across documents, found by level-wise doubling.

A window of ``window`` words (5 * 2**k of them; 20 by default) can only repeat if its
parts do. Level 1 looks at 5-word windows, but only at each longer window's anchor, the
5-word window inside it with the smallest hash: equal windows have equal anchors, so this
loses nothing. Anchors that repeat alone are extended to twice their length, rightwards
and leftwards inside the longer window; extensions that repeat alone are extended again,
until the full length is reached or no candidates survive. What repeats is handed to the
next scan as a bit filter of fixed size; a false hit there only lets a window go on to the
next level, and the last level compares the full windows (64-bit hashes of all words).

At the full length every batch of documents first settles its own repeats, so a window
that is everywhere meets once per batch. The rest is grouped by the window's own hash, so
that windows around a common shorter passage spread over all groups; whole groups are
compared at a time, and every occurrence but the first (smallest document, then smallest
start) gives a span to remove. Spans that touch are joined per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import (NULL_KEY, among_bits, bounded_batches, column, hashed_key_bits, id_text, mix64,
                               ngram_hashes, pin, text_steps, word_hashes)

ANCHOR = 5


def _levels(window: int) -> list[int]:
    sizes = [ANCHOR]
    while sizes[-1] < window:
        sizes.append(sizes[-1] * 2)
    if sizes[-1] != window or len(sizes) < 2:
        raise ValueError(f"the window must be {ANCHOR} words doubled at least once, not {window}")
    return sizes


class Windows:
    """Window starts of a step's documents, their anchors and extensions."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray, window: int):
        counts = np.diff(offsets)
        per = np.maximum(counts - window + 1, 0)
        self.words, self.window = words, window
        self.text = np.repeat(np.arange(len(counts)), per)
        ends = np.cumsum(per)
        self.start = np.arange(len(self.text)) - np.repeat(ends - per, per)  # within the document
        self.at = self.start + offsets[:-1][self.text]
        self.grams = {ANCHOR: ngram_hashes(words, ANCHOR)}
        self.anchor = self._anchors()

    def _anchors(self) -> np.ndarray:
        """Place of the smallest anchor hash in each window, the first of equal ones."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        span = self.window - ANCHOR + 1
        best = self.grams[ANCHOR].copy()
        place = np.arange(len(best))
        width = 1
        while width < span:  # windowed minimum by doubling, the last step overlapping
            step = min(width, span - width)
            left, right = best[: len(best) - step], best[step:]
            take = right < left
            place = np.where(take, place[step:], place[: len(place) - step])
            best = np.where(take, right, left)
            width += step
        return place[self.at]

    def gram(self, size: int) -> np.ndarray:
        if size not in self.grams:
            half = self.gram(size // 2)
            self.grams[size] = mix64(half[: max(len(half) - size // 2, 0)] * np.uint64(0x9E3779B97F4A7C15)
                                     + half[size // 2:]) if len(half) > size // 2 else np.zeros(0, np.uint64)
        return self.grams[size]

    def extension(self, size: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash of a ``size``-word part of each window that holds its anchor: right
        of the anchor's start if that fits the window, else ending with the anchor."""
        anchor = self.anchor[rows]
        fits = anchor + size <= self.at[rows] + self.window
        place = np.where(fits, anchor, anchor + ANCHOR - size)
        return place, self.gram(size)[place]


def repeated_spans(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   log2_bits: int = 26, group_windows: int = 1_000_000) -> DataFrame:
    """(node, tag, start, length) word spans covered by windows that also start earlier:
    in a document of a smaller id (null ids last; documents of equal id by a hash of their
    text) or earlier in the same document; spans of a document do not touch. node is the id, 2**63-1 if null; tag is the
    xxhash64 of the text. Rows that repeat id and text are one document. Texts of fewer
    than ``window`` words, null or empty ones hold no window."""
    found = _document_spans(docs, window, id_col, text_col, log2_bits, group_windows)
    return found.select("node", "tag", F.explode(F.arrays_zip("starts", "lengths")).alias("x")).select(
        "node", "tag", F.col("x.starts").alias("start"), F.col("x.lengths").alias("length"))


def _document_spans(docs: DataFrame, window: int, id_col: str, text_col: str, log2_bits: int = 26,
                    group_windows: int = 1_000_000) -> DataFrame:
    """The spans of repeated_spans as one row per document: (node, tag, starts, lengths)."""
    keyed = _keyed(docs, id_col, text_col)
    spark = docs.sparkSession
    sizes = _levels(window)
    filters: list = []  # one bit filter per settled level

    def survivors(w: Windows) -> np.ndarray:
        rows = np.arange(len(w.at))
        for size, bits in zip(sizes, filters):
            if not len(rows):
                break
            rows = rows[among_bits(bits.value, w.extension(size, rows)[1])]
        return rows

    total = 0
    for size in sizes[:-1]:
        def level(batches, size=size):
            for step in text_steps(batches):
                w = Windows(*word_hashes(column(step, "text"), lower=False), window)
                rows = survivors(w)
                place, keys = w.extension(size, rows)
                keys, n = np.unique(keys[np.unique(place, return_index=True)[1]], return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "n": pa.array(n, pa.int64())})

        again = pin(keyed.select("text").mapInArrow(level, "key long, n long").groupBy("key")
                    .agg(F.sum("n").alias("n")).where("n > 1"), f"repeats-{size}")
        total = again.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
        filters.append(spark.sparkContext.broadcast(hashed_key_bits(F.col("key"), again, log2_bits)))

    # windows per 10 words or more that repeat: half of those possible, so a group has about group_windows
    groups = max(1, -(-total * (window - ANCHOR + 1) // (2 * group_windows)))
    last = pin(keyed.mapInArrow(lambda batches: _last_level(batches, window, survivors, groups),
                                "grp long, node long, tag long, start int, length int, hashes binary, docs binary, "
                                "starts binary, nodes binary, tags binary"), "full-windows")
    compared = (last.where("hashes is not null").select("grp", "hashes", "docs", "starts", "nodes", "tags")
                .groupBy("grp").applyInArrow(lambda group: _compare(group, window), "node long, tag long, start int, length int"))
    spans = last.where("hashes is null").select("node", "tag", "start", "length").unionByName(compared)
    # a text's own words bound the number of its spans
    spans = spans.groupBy("node", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    return spans.mapInArrow(_joined, "node long, tag long, starts array<int>, lengths array<int>")


def _joined(batches):
    """Sorted spans of each row, those that touch or overlap joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        spans = batch.column("spans")
        sizes = np.diff(spans.offsets.to_numpy())
        flat, row = spans.flatten(), np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        start = flat.field("start").to_numpy() + (row << 33)
        end = np.maximum.accumulate(start + flat.field("length").to_numpy())  # later rows begin beyond it
        head = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
        tail = np.append(head[1:], len(start)) - 1
        ends = pa.array(np.searchsorted(row[head], np.arange(len(sizes) + 1)), pa.int32())
        own = row[head] << 33
        yield pa.RecordBatch.from_pydict({
            "node": batch.column("node"), "tag": batch.column("tag"),
            "starts": pa.ListArray.from_arrays(ends, pa.array((start[head] - own).astype(np.int32))),
            "lengths": pa.ListArray.from_arrays(ends, pa.array((end[tail] - start[head]).astype(np.int32)))})


def _keyed(docs, id_col, text_col):
    bounded_batches(docs.sparkSession)
    return id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("node"),
                                                  F.xxhash64("text").alias("tag"), "text")


_LAST = pa.schema([("grp", pa.int64()), ("node", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()),
                   ("length", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("starts", pa.binary()),
                   ("nodes", pa.binary()), ("tags", pa.binary())])


def _last_level(batches, window, survivors, groups):
    """Per step: spans of its own repeats, and its first occurrences packed per group."""
    for step in text_steps(batches):
        w = Windows(*word_hashes(column(step, "text"), lower=False), window)
        rows = survivors(w)
        if not len(rows):
            continue
        nodes, tags = column(step, "node").to_numpy(), column(step, "tag").to_numpy()
        rank = np.empty(len(nodes), np.int64)  # order of documents; equal rows share a rank
        order = np.lexsort((tags, nodes))
        new = np.ones(len(order), bool)
        new[1:] = (nodes[order][1:] != nodes[order][:-1]) | (tags[order][1:] != tags[order][:-1])
        rank[order] = np.cumsum(new) - 1
        hashes, doc, start = w.gram(window)[w.at[rows]], rank[w.text[rows]], w.start[rows]
        group = (hashes % np.uint64(groups)).astype(np.int64)
        by = np.lexsort((start, doc, hashes))
        hashes, doc, start, group = hashes[by], doc[by], start[by], group[by]
        first, later = _first_and_later(hashes, doc, start)
        names = np.stack([nodes[order][new], tags[order][new]])
        yield from _span_batches(names[:, doc[later]], start[later], window)
        hashes, doc, start, group = (x[first] for x in (hashes, doc, start, group))
        by = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[by], prepend=-1))
        out = []
        for a, b in zip(cuts, np.append(cuts[1:], len(by))):
            part = by[a:b]
            held, local = np.unique(doc[part], return_inverse=True)
            out.append({"grp": int(group[part[0]]), "hashes": hashes[part].tobytes(),
                        "docs": local.astype(np.uint32).tobytes(), "starts": start[part].astype(np.uint32).tobytes(),
                        "nodes": names[0][held].tobytes(), "tags": names[1][held].tobytes()})
        for k in range(0, len(out), 512):
            yield pa.RecordBatch.from_pylist(out[k: k + 512], schema=_LAST)


def _first_and_later(hashes, doc, start):
    """Of occurrences sorted by (hash, document, start): the first of each hash, and those
    that are later than it (an equal row of the same document and start is neither)."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return new, (doc != doc[head]) | (start != start[head])


def _spans(names, start, window):
    """Windows as (node, tag, start, length) spans, runs of consecutive starts joined."""
    if not len(start):
        return {"node": names[0], "tag": names[1], "start": start.astype(np.int32), "length": start.astype(np.int32)}
    by = np.lexsort((start, names[1], names[0]))
    node, tag, start = names[0][by], names[1][by], start[by].astype(np.int64)
    cut = np.ones(len(start), bool)
    cut[1:] = (node[1:] != node[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(start)) - 1
    return {"node": node[head], "tag": tag[head], "start": start[head].astype(np.int32),
            "length": (start[tail] - start[head] + window).astype(np.int32)}


def _span_batches(names, start, window):
    if len(start):
        cols = _spans(names, start, window)
        rows = len(cols["node"])
        yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows, f.type)
                                          for f in _LAST], schema=_LAST)


def _compare(table: pa.Table, window: int) -> pa.Table:
    """Spans of all occurrences in one group of windows that are not the first."""
    raw = {c: [x.as_buffer() for x in table.column(c)] for c in ("hashes", "docs", "starts", "nodes", "tags")}
    read = lambda c, kind: [np.frombuffer(x, kind) for x in raw[c]]
    hashes = np.concatenate(read("hashes", np.uint64))
    local, held = read("docs", np.uint32), read("nodes", np.int64)
    node = np.concatenate([n[d] for n, d in zip(held, local)])
    tag = np.concatenate([t[d] for t, d in zip(read("tags", np.int64), local)])
    start = np.concatenate(read("starts", np.uint32)).astype(np.int64)
    by = np.lexsort((start, tag, node, hashes))
    hashes, node, tag, start = hashes[by], node[by], tag[by], start[by]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (node != node[head]) | (tag != tag[head]) | (start != start[head])
    cols = _spans(np.stack([node[later], tag[later]]), start[later], window)
    return pa.table({k: pa.array(v) for k, v in cols.items()})


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (the words that stay,
    joined by one space). Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null text has none;
    which windows count, and the cases of ties and nulls, are those of repeated_spans. An
    empty table gives an empty result; other columns are ignored."""
    spans = pin(_document_spans(docs, window, id_col, text_col, **options), "spans")

    def cut(batches):
        from itertools import compress

        for batch in batches:
            rows, removed, kept = [], [], []
            for text, starts, lengths in zip(batch.column("text"), batch.column("starts"), batch.column("lengths")):
                words = text.as_buffer().to_pybytes().split()
                n = len(words)
                if starts.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    a, size = starts.values.to_numpy(), lengths.values.to_numpy()
                    np.add.at(edge, a, 1)
                    np.add.at(edge, a + size, -1)
                    stay = np.cumsum(edge[:n]) == 0
                    words = list(compress(words, stay.tolist()))
                rows.append(n)
                removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("node"), "n_words": pa.array(rows, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    joined = _keyed(docs, id_col, text_col).join(spans, ["node", "tag"], "left")
    done = joined.select("node", "text", "starts", "lengths").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != NULL_KEY, F.col("doc_id")))
