"""Records of large text files whose ends need the text before them.

A JSON object of many entries, or CSV with line ends inside quotes, cannot be cut at line
ends alone: whether a brace or a line end counts depends on the quotes so far. Spark reads
the files in byte ranges, as fragments up to a separator. A first pass folds every range to
what it does to each state it might start in (inside a quoted string or not, and how much
deeper it gets). Combined over the ranges in order, one row per range, that gives every
range's true start. The second pass cuts the records; only the pieces at the ranges' edges
are put together afterwards, so a file of any size is read by many tasks.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class JsonEntries:
    """Entries of one large JSON object: fragments end at ``}``, an entry where the depth is back at one."""

    separator = "}"
    _escaped = re.compile(r"\\.", re.DOTALL)

    def step(self, fragment: str, inside: bool) -> tuple[bool, int]:
        """(inside a string at the end, change of depth), the separator included."""
        parts = self._escaped.sub("", fragment).split('"')
        own = "".join(parts[1::2] if inside else parts[0::2])
        after = inside ^ (len(parts) % 2 == 0)
        return after, own.count("{") - own.count("}") - (not after)

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside and depth <= 1

    def text(self, fragments: list[str]) -> str:
        return "".join(f + "}" for f in fragments)


class CsvRecords:
    """CSV records: fragments are lines, a record ends at a line end outside quotes. A quote opens
    a field only as its first character; a doubled quote inside quotes is a character."""

    separator = "\n"
    _close = re.compile(r'(?:[^"]|"")*+"')
    _open = re.compile(r'(?:^|(?<=,))"')

    def step(self, line: str, inside: bool) -> tuple[bool, int]:
        at = 0
        while '"' in line[at:]:
            found = (self._close if inside else self._open)
            m = found.match(line, at) if inside else found.search(line, at)
            if m is None:
                break
            at, inside = m.end(), not inside
        return inside, 0

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside

    def text(self, lines: list[str]) -> str:
        return "\n".join(lines)


def _fragments(spark: SparkSession, path: str, machine) -> DataFrame:
    raw = spark.read.text(path, lineSep=machine.separator)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches, columns: list[str]):
    """Consecutive rows of one range: (file, start, other columns' first values, fragments)."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in columns)))
        values = batch.column("value").to_pylist()
        first = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[first]:
                yield keys[first], values[first:i]
                first = i


def range_effects(fragments: DataFrame, machine) -> DataFrame:
    """(file, start, in0, depth0, in1, depth1): what every range does if it starts outside (0) or
    inside (1) a string: whether it ends inside one, and how much deeper."""
    def run(batches):
        pieces: dict = {}
        for (file, start), values in _runs(batches, ["file", "start"]):
            effect = pieces.get((file, start), ((False, 0), (True, 0)))
            out = []
            for inside, depth in effect:
                for v in values:
                    inside, change = machine.step(v, inside)
                    depth += change
                out.append((inside, depth))
            pieces[(file, start)] = tuple(out)
        rows = [(f, s, a[0], a[1], b[0], b[1]) for (f, s), (a, b) in pieces.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "start", "in0", "depth0", "in1", "depth1"), r)) for r in rows],
                                         schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("in0", pa.bool_()),
                                                           ("depth0", pa.int64()), ("in1", pa.bool_()), ("depth1", pa.int64())]))

    return fragments.mapInArrow(run, "file string, start long, in0 boolean, depth0 long, in1 boolean, depth1 long")


def range_starts(effects: DataFrame) -> list[tuple[str, int, bool, int]]:
    """(file, start, inside, depth) of every range: the effects of the ranges before it, combined
    in order. One row per byte range of the files comes to the driver, no text."""
    out, file, inside, depth = [], None, False, 0
    for r in sorted(effects.collect(), key=lambda r: (r.file, r.start)):  # sorted by Spark, the texts would be read twice
        if r.file != file:
            file, inside, depth = r.file, False, 0
        out.append((r.file, r.start, inside, depth))
        inside, change = (r.in1, r.depth1) if inside else (r.in0, r.depth0)
        depth += change
    return out


def _cut(machine):
    """Whole records of a range (part NULL), and its edges: before its first end (0) or all of
    it if it has none (0), and after its last end (1)."""
    columns = ["range", "inside", "depth"]

    def run(batches):
        key, held, seen, inside, depth = None, [], False, False, 0
        done: list = []

        def edge():
            # a range that stops at a record's end leaves an empty edge: the next record begins anew
            return [(key, int(seen), machine.text(held) if held else None)] if key is not None and (held or seen) else []

        for (number, first_inside, first_depth), values in _runs(batches, columns):
            if number != key:
                done += edge()
                key, held, seen, inside, depth = number, [], False, first_inside, first_depth
            for v in values:
                inside, change = machine.step(v, inside)
                depth += change
                held.append(v)
                if machine.ends(inside, depth):
                    done.append((number, None if seen else 0, machine.text(held)))
                    held, seen = [], True
            yield _batch(done)
            done = []
        done += edge()
        yield _batch(done)
    return run


_PIECE = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("record", pa.string())])


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _PIECE.field(k).type) for k in range(3)], schema=_PIECE)


def read_records(spark: SparkSession, path: str, machine) -> DataFrame:
    """(file, start, first, record): the records of all files under ``path``; ``start`` is the byte
    range in which a record begins, ``first`` tells a file's first record. Records keep no order
    beyond that; empty ones may come or go."""
    fragments = _fragments(spark, path, machine)
    starts = range_starts(range_effects(fragments, machine))
    # one row per byte range; rows carry its number, not the file's path
    table = F.broadcast(spark.createDataFrame([(i, *r) for i, r in enumerate(starts)],
                                              "range int, file string, start long, inside boolean, depth long"))
    placed = fragments.join(table, ["file", "start"], "left").select(
        F.coalesce("range", F.raise_error(F.lit("a byte range was not seen in the first pass"))).alias("range"), "inside", "depth", "value")
    pieces = placed.mapInArrow(_cut(machine), "range int, part int, record string")
    named = lambda d: d.join(table.select("range", "file", "start"), "range")
    whole = named(pieces.where(F.col("part").isNull())).select("file", "start", F.lit(False).alias("first"), "record")
    # edges: a range's first piece ends what the last piece before it began
    order = Window.partitionBy("file").orderBy("start", "part")
    edges = named(pieces.where(F.col("part").isNotNull())).withColumn("began", F.sum("part").over(order))
    joined = edges.groupBy("file", "began").agg(F.sort_array(F.collect_list(F.struct("start", "part", "record"))).alias("l")).select(
        "file", F.col("l")[0]["start"].alias("start"), (F.col("began") == 0).alias("first"), F.array_join(F.col("l.record"), "\n" if machine.separator == "\n" else "").alias("record"))
    return whole.unionByName(joined)
