"""Phrase collocations counted in direct-address tiles.

Words are counted per language; the frequent ones of the ``head`` get ids by falling
frequency. A pair of ids is a cell of a square, cut into tiles of 1024 x 1024 cells: the
tiles of common ids fill up and are counted by one dense bincount, the thin ones are kept as
sorted (cell, count) lists. Tasks count their own documents and Spark adds the tasks' cells.
The frequent pairs are ranked again and get ids of their own, so that three words are a
(pair, word) cell and four words a (pair, pair) cell of the next pass.

The heads of words and pairs bound what is broadcast. Units beyond them are exact too: a bit
filter of fixed size says which words or pairs may be frequent outside the head. Phrases with
such a pair are counted by their word ids in a sorted list, phrases with such a word by their
text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import among_bits, column, hashed_key_bits, pin, release_memory, text_bytes, text_steps

NO_LANG = "und"
_TILE = 10  # log2 of a tile's side
_CELLS = 1 << (2 * _TILE)
_DENSE = _CELLS // 16  # buffered pairs from which a tile is counted densely
_BITS = 24  # log2 of the bit filters' size
_SHIFT = np.int64(32)
_STEP = 2_000_000  # bytes of text per step
_OUT = 50_000  # rows of a batch that a task hands out

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a step of texts, in order: ``combo`` numbers the distinct (lang, word) of
    the step, ``same`` tells whether a word and the next one are in one piece."""

    def __init__(self, step: pa.Table):
        langs = column(step, "lang").dictionary_encode()
        raw, at = text_bytes(column(step, "text"))
        kind = _KIND[raw]
        inside = kind == 0
        edge = np.ones(len(raw) + 1, bool)
        edge[1:-1] = ~inside[:-1]
        edge[at] = True
        starts = np.flatnonzero(edge[:-1] & inside)
        last = np.ones(len(raw) + 1, bool)
        last[:-1] = ~inside
        last[at] = True
        ends = np.flatnonzero(last[1:] & inside) + 1
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)),
                                                pa.py_buffer(_LOWER[raw[inside]])).dictionary_encode()
        text = np.searchsorted(at, starts, side="right")
        piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts] + text if len(starts) else text
        self.same = piece[1:] == piece[:-1]
        self.langs = langs.dictionary.to_pylist()
        self.vocabulary = flat.dictionary
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text - 1]
        key = lang * max(len(self.vocabulary), 1) + flat.indices.to_numpy(zero_copy_only=False)
        self.key, self.combo = _number(key, len(self.langs) * max(len(self.vocabulary), 1))
        self.lang_of = self.key // max(len(self.vocabulary), 1)
        self.word_of = self.key % max(len(self.vocabulary), 1)
        self.lang_words = np.bincount(lang, minlength=len(self.langs))
        self._texts: list | None = None

    def texts(self) -> list[str]:
        """The words of the combos."""
        if self._texts is None:
            self._texts = self.vocabulary.take(pa.array(self.word_of)).to_pylist()
        return self._texts

    def phrase(self, at: int, words: int) -> str:
        own = self.texts()
        return " ".join(own[c] for c in self.combo[at: at + words])


def _number(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and each key's place among them."""
    if size > 1 << 23:
        return np.unique(key, return_inverse=True)
    found = np.flatnonzero(np.bincount(key, minlength=size))
    place = np.zeros(size, np.int64)
    place[found] = np.arange(len(found))
    return found, place[key]


class PairTiles:
    """Exact counts of (row id, column id) pairs in bounded memory: a buffer is folded into
    dense tiles and one sorted list; what grows too long is handed out and started anew."""

    def __init__(self, buffer: int = 600_000, listed: int = 1_200_000, tiles: int = 8):
        self.buffer, self.listed, self.tiles = buffer, listed, tiles
        self.held: list[np.ndarray] = []
        self.size = 0
        self.dense: dict[int, np.ndarray] = {}
        self.codes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, columns: np.ndarray):
        """Count the pairs; yields (rows, columns, counts) that had to be handed out."""
        self.held.append((rows.astype(np.int64) << _SHIFT) | columns.astype(np.int64))
        self.size += len(rows)
        if self.size >= self.buffer:
            self._fold()
            if len(self.codes) >= self.listed:
                yield self._list()

    def rest(self):
        self._fold()
        for tile in list(self.dense):
            yield self._tile(tile)
        if len(self.codes):
            yield self._list()

    def _fold(self) -> None:
        if not self.size:
            return
        codes = np.concatenate(self.held)
        self.held, self.size = [], 0
        tile = ((codes >> (_SHIFT + _TILE)) << np.int64(22)) | ((codes & np.int64(2 ** 32 - 1)) >> np.int64(_TILE))
        which, place = np.unique(tile, return_inverse=True)
        full = np.bincount(place) >= _DENSE
        for k in np.flatnonzero(full):
            key = int(which[k])
            if key not in self.dense and len(self.dense) >= self.tiles:
                full[k] = False  # room is for the commonest tiles, which come first; the others are listed
                continue
            own = codes[place == k]
            cell = ((own >> _SHIFT) & np.int64(1023)) << np.int64(_TILE) | (own & np.int64(1023))
            self.dense[key] = self.dense.get(key, 0) + np.bincount(cell, minlength=_CELLS)
        thin = codes[~full[place]]
        codes, counts = np.unique(thin, return_counts=True)
        both = np.concatenate([self.codes, codes])
        order = np.argsort(both, kind="stable")  # two sorted runs
        both, n = both[order], np.concatenate([self.counts, counts])[order]
        first = np.append(True, both[1:] != both[:-1])[: len(both)]
        self.codes = both[first]
        self.counts = np.add.reduceat(n, np.flatnonzero(first)) if len(both) else n

    def _list(self):
        codes, counts = self.codes, self.counts
        self.codes, self.counts = codes[:0], counts[:0]
        return codes >> _SHIFT, codes & np.int64(2 ** 32 - 1), counts

    def _tile(self, key: int):
        counts = self.dense.pop(key)
        cells = np.flatnonzero(counts)
        return ((key >> 22) << _TILE) + (cells >> _TILE), ((key & (2 ** 22 - 1)) << _TILE) + (cells & 1023), counts[cells]


class WidePairs:
    """Exact counts of pairs of 64-bit codes that have no cell: one sorted list of bounded length."""

    def __init__(self, buffer: int = 300_000, listed: int = 600_000):
        self.buffer, self.listed = buffer, listed
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, left: np.ndarray, right: np.ndarray):
        self.held.append((left, right, np.ones(len(left), np.int64)))
        self.size += len(left)
        if self.size >= self.buffer:
            self._fold()
            if len(self.held[0][0]) >= self.listed:
                yield from self.rest()

    def rest(self):
        self._fold()
        if self.held:
            yield self.held.pop()

    def _fold(self) -> None:
        if not self.held:
            return
        left, right, n = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((right, left))
        left, right, n = left[order], right[order], n[order]
        first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[: len(left)])
        self.held = [(left[first], right[first], np.add.reduceat(n, first))] if len(first) else []
        self.size = 0


class Units:
    """Frequent words: ids of the head, and the filter of those beyond it (None: there are none)."""

    def __init__(self, ids: dict, bits: np.ndarray | None):
        self.ids, self.bits = ids, bits


def word_codes(words: Words, units: Units) -> np.ndarray:
    """Per word its id in the head, -2 if it may be frequent beyond the head, -1 if it is rare."""
    langs = words.langs
    none: dict = {}
    tables = [units.ids.get(lang, none) for lang in langs]
    own = np.fromiter((tables[k].get(w, -1) for k, w in zip(words.lang_of.tolist(), words.texts())), np.int64, len(words.key))
    if units.bits is not None:
        rest = np.flatnonzero(own < 0)
        texts = words.texts()
        keys = np.fromiter((zlib.crc32(f"{langs[k]} {texts[i]}".encode()) for i, k in zip(rest.tolist(), words.lang_of[rest].tolist())),
                           np.uint64, len(rest))
        own[rest[among_bits(units.bits, keys)]] = -2
    return own[words.combo] if len(own) else np.zeros(0, np.int64)


def _code(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return (rows.astype(np.int64) << _SHIFT) | columns.astype(np.int64)


class Pairs:
    """Frequent pairs of head words: ids of their head by rank, and the filter of those beyond it."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, bits: np.ndarray | None):
        codes = _code(rows, columns)
        self.ranked, self.bits = codes, bits
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]

    def __call__(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), -1, np.int64)
        if len(self.codes):
            codes = _code(rows, columns)
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            out = np.where(self.codes[at] == codes, self.order[at], -1)
        if self.bits is not None:
            rest = np.flatnonzero(out < 0)
            keys = (rows[rest] * _MIX + columns[rest]).astype(np.uint64)
            out[rest[among_bits(self.bits, keys)]] = -2
        return out


_MIX = 1000003  # key of a pair in the filter: row * _MIX + column


def pair_codes(words: Words, code: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Per word what the pair that starts there is: its id in the head, -2 if it may be
    frequent beyond it (or holds a word beyond the words' head), -1 if it is none."""
    out = np.full(len(code), -1, np.int64)
    a, b = code[:-1], code[1:]
    known = np.flatnonzero(words.same & (a >= 0) & (b >= 0))
    out[known] = pairs(a[known], b[known])
    out[:-1][words.same & (a != -1) & (b != -1) & ((a == -2) | (b == -2))] = -2
    return out


# ---------------------------------------------------------------- the passes

_CELL = "size int, a int, b int, c int, d int, lang string, phrase string, n long"


def _cells(size: int, left: np.ndarray, right: np.ndarray, n: np.ndarray):
    """Counted phrases as word ids, in small batches: two words, or the codes of a pair and a
    word, or of two pairs."""
    for start in range(0, len(n), _OUT):
        part = slice(start, start + _OUT)
        yield _cell_batch(size, left[part], right[part], n[part])


def _cell_batch(size: int, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    low = np.int64(2 ** 32 - 1)
    ids = [left, right] if size == 2 else [left >> _SHIFT, left & low, right] if size == 3 else [
        left >> _SHIFT, left & low, right >> _SHIFT, right & low]
    none = [pa.nulls(len(n), pa.int32())] * (4 - size)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(n), size, np.int32)), *(pa.array(i.astype(np.int32)) for i in ids), *none,
        pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.string()), pa.array(n.astype(np.int64))],
        names=["size", "a", "b", "c", "d", "lang", "phrase", "n"])


def _phrases(words: Words, at: np.ndarray, size: int) -> pa.RecordBatch:
    """Counts of the phrases of ``size`` words from the places ``at``, by their text."""
    counts: dict = {}
    for i in at.tolist():
        key = (words.langs[words.lang_of[words.combo[i]]], words.phrase(i, size))
        counts[key] = counts.get(key, 0) + 1
    own = list(counts)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(own), size, np.int32)), *[pa.nulls(len(own), pa.int32())] * 4,
        pa.array([k[0] for k in own], pa.string()), pa.array([k[1] for k in own], pa.string()),
        pa.array([counts[k] for k in own], pa.int64())], names=["size", "a", "b", "c", "d", "lang", "phrase", "n"])


def _word_pass(batches):
    """(lang, word, n) of every step, and (lang, null, words) in all."""
    for step in text_steps(batches, _STEP):
        w = Words(step)
        langs = pa.array(w.langs, pa.string())
        n = np.bincount(w.combo, minlength=len(w.key))
        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([langs.take(pa.array(w.lang_of)), langs]),
            pa.concat_arrays([w.vocabulary.take(pa.array(w.word_of)).cast(pa.string()), pa.nulls(len(langs), pa.string())]),
            pa.array(np.concatenate([n, w.lang_words]))], names=["lang", "phrase", "n"])


def _pair_pass(units):
    def run(batches):
        tiles = PairTiles()
        for step in text_steps(batches, _STEP):
            w = Words(step)
            code = word_codes(w, units.value)
            a, b = code[:-1], code[1:]
            both = w.same & (a != -1) & (b != -1)
            known = both & (a >= 0) & (b >= 0)
            for found in tiles.add(a[known], b[known]):
                yield from _cells(2, *found)
            if units.value.bits is not None:
                yield _phrases(w, np.flatnonzero(both & ~known), 2)
        for found in tiles.rest():
            yield from _cells(2, *found)
        release_memory()
    return run


def _long_pass(units, pairs):
    def run(batches):
        ranked = pairs.value.ranked
        # by size: tiles of (pair id, word id) and (pair id, pair id), and the list of what has no ids
        counters = {size: (PairTiles(400_000, 800_000, 4), WidePairs()) for size in (3, 4)}

        def coded(size, rows, columns, n):
            return _cells(size, ranked[rows], columns if size == 3 else ranked[columns], n)

        for step in text_steps(batches, _STEP):
            w = Words(step)
            code = word_codes(w, units.value)
            pair = pair_codes(w, code, pairs.value)
            for size, (tiles, wide) in counters.items():
                n = max(len(pair) - size + 1, 0)
                first, rest = pair[:n], code[2: 2 + n] if size == 3 else pair[2: 2 + n]
                open_ = (first != -1) & (rest != -1) & (pair[1: 1 + n] != -1)
                ids = open_ & (first >= 0) & (rest >= 0)
                for found in tiles.add(first[ids], rest[ids]):
                    yield from coded(size, *found)
                if (ids == open_).all():
                    continue
                own = np.all([code[k: k + n] >= 0 for k in range(size)], axis=0)
                at = np.flatnonzero(open_ & ~ids & own)
                right = code[at + 2] if size == 3 else _code(code[at + 2], code[at + 3])
                for found in wide.add(_code(code[at], code[at + 1]), right):
                    yield from _cells(size, *found)
                yield _phrases(w, np.flatnonzero(open_ & ~ids & ~own), size)
        for size, (tiles, wide) in counters.items():
            for found in tiles.rest():
                yield from coded(size, *found)
            for found in wide.rest():
                yield from _cells(size, *found)
        release_memory()
    return run


def _frequent(cells: DataFrame, least: int) -> DataFrame:
    return cells.groupBy("size", "a", "b", "c", "d", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _head(units: DataFrame, head: int, columns: list[str]):
    """At most ``head`` units, the commonest, by rank on the driver (that many rows of
    ``columns``), and a DataFrame of the others (None if there are none). The cut lies between
    two counts of six leading bits, found in their histogram."""
    drop = "greatest(length(bin(n)) - 6, 0)"
    low = F.expr(f"shiftleft(shiftright(n, {drop}), {drop})")
    cut, size = 0, 0
    for row in units.groupBy(low.alias("low")).count().orderBy(F.desc("low")).collect():  # 32 rows per bit length
        size += row["count"]
        if size > head:
            break
        cut = row["low"]
    whole = size <= head
    top = units if whole else units.where(F.col("n") >= cut) if cut else units.limit(0)
    top = top.select("n", *columns).toPandas().sort_values(["n", *columns], ascending=[False] + [True] * len(columns), ignore_index=True)
    return top, None if whole else units.where(F.col("n") < cut) if cut else units


def phrase_counts(docs: DataFrame, least: int = 30, head: int = 1 << 18, pair_head: int = 1 << 21, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 4 words with at least ``least`` occurrences: (lang, phrase, size, n),
    and (lang, n) of all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = (rows.mapInArrow(_word_pass, "lang string, phrase string, n long").groupBy("lang", "phrase")
               .agg(F.sum("n").alias("n")))
    singles = pin(counted.where(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    words = singles.where(F.col("phrase").isNotNull())
    top, beyond = _head(words, head, ["lang", "phrase"])
    top["id"] = np.arange(len(top), dtype=np.int32)
    ids: dict = {}
    for i, lang, phrase in zip(top["id"].tolist(), top["lang"], top["phrase"]):
        ids.setdefault(lang, {})[phrase] = i
    bits = None if beyond is None else hashed_key_bits(F.crc32(F.concat_ws(" ", "lang", "phrase").cast("binary")), beyond, _BITS)
    units = spark.sparkContext.broadcast(Units(ids, bits))
    table = spark.createDataFrame(top[["id", "lang", "phrase"]], "id int, lang string, phrase string")

    twos = pin(_frequent(rows.mapInArrow(_pair_pass(units), _CELL), least), "pairs")
    # the frequent pairs are ranked again: their ids are the rows and columns of the next tiles
    top, beyond = _head(twos.where(F.col("a").isNotNull()), pair_head, ["a", "b"])
    bits = None if beyond is None else hashed_key_bits(F.col("a").cast("long") * _MIX + F.col("b"), beyond, _BITS)
    pairs = spark.sparkContext.broadcast(Pairs(top["a"].to_numpy(np.int64), top["b"].to_numpy(np.int64), bits))
    longer = pin(_frequent(rows.mapInArrow(_long_pass(units, pairs), _CELL), least), "phrases")

    named = _named(twos.unionByName(longer), table)
    return words.select("lang", "phrase", F.lit(1).alias("size"), "n").unionByName(named), singles.where(
        F.col("phrase").isNull()).select("lang", "n")


def _named(found: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, size, n): ids replaced by the words of the head, whose size is bounded."""
    for k in "abcd":
        own = words.select(F.col("id").alias(f"{k}_id"), F.col("phrase").alias(f"{k}_word"),
                           *([F.col("lang").alias("id_lang")] if k == "a" else []))
        found = found.join(F.broadcast(own), F.col(k) == F.col(f"{k}_id"), "left")
    return found.select(F.coalesce("lang", "id_lang").alias("lang"), F.coalesce("phrase", F.concat_ws(
        " ", *[f"{k}_word" for k in "abcd"])).alias("phrase"), "size", "n")


# ---------------------------------------------------------------- scores

def collocations(docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, head: int = 1 << 18,
                 pair_head: int = 1 << 21, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A null text counts as empty and a null lang as ``und``; rows without words give nothing,
    an empty table gives an empty result. Rows that repeat count each; ties in score go to
    the larger a, then to the smaller phrase in byte order. A text is held whole in one task,
    as Arrow itself holds it. Only the two named columns are read. Every score, and the
    test against longer phrases, is whole-number arithmetic in 38 digits.
    """
    counts, totals = phrase_counts(docs, least, head, pair_head, lang_col, text_col)
    counts = pin(counts, "phrase-counts")
    many = counts.where("size > 1")
    split = F.split("phrase", " ")
    cuts = (many.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
                        split.alias("w"), "size")
            .select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("left"),
                    F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("right")))
    part = counts.select(F.col("lang").alias("plang"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    scored = cuts
    for side, name in (("left", "l"), ("right", "r")):
        scored = (scored.join(part, (F.col("lang") == F.col("plang")) & (F.col(side) == F.col("part")))
                  .withColumnRenamed("f", name).drop("plang", "part"))
    best = (scored.withColumn("score", _floor_ratio("a", "l", "r")).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "m.score"))
    # every part of two or more words of a longer phrase, with the commonest phrase around it
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.concat_ws(" ", F.slice("w", i, m)))))
    around = (counts.where("size > 2").select("lang", "size", "n", split.alias("w"))
              .select(F.col("lang").alias("clang"), F.explode(inner).alias("inner"), "n")
              .groupBy("clang", "inner").agg(F.max("n").alias("most")))
    wide = F.coalesce("most", F.lit(0)).cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * cover
    kept = (best.join(around, (F.col("lang") == F.col("clang")) & (F.col("phrase") == F.col("inner")), "left")
            .where(~wide).select("lang", "phrase", "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(16))
    first = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    first = first.where(F.col("rank") <= top).drop("rank", "salt")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _floor_ratio(a: str, l: str, r: str) -> Column:
    """floor(2000000 * a / (l + r)), exact beyond 64 bits."""
    return F.expr(f"(cast({a} as decimal(20,0)) * 2000000) div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))")
