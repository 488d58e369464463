"""Chat transcripts: roles recovered by a hidden Markov model, canonical turn rendering.

A transcript is a table of lines (conversation, position, line). Each line becomes one
symbol from its speaker marker and line features. The hidden states are, per role, the
first line of a turn, a further line, and a blank line. The model is estimated by counting
labelled lines; Viterbi then finds each line's state, and turns are rendered.

No conversation is held in one task, however long: positions are cut into chunks of
``span``, a chunk is reduced to the matrix of its best path scores (max-plus), and the
matrices of up to ``FAN`` neighbours are multiplied level by level. From the top, the
states at the borders are fixed level by level again, and each chunk finds its own best
path between the states at its borders. The result is the exact Viterbi path.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import bounded_batches, pin

ROLES = ("system", "user", "assistant")
STATES = [f"{role}_{kind}" for role in ROLES for kind in ("first", "further", "blank")]
S = len(STATES)
START = S  # the state before a conversation's first line
FAN = 32

#: Speaker markers at the start of a line, by role (fixed values).
MARKERS = {
    "system": r"system|sys|instructions?|context",
    "user": r"user|human|customer|client|question|q|me|you|prompt",
    "assistant": r"assistant|ai|bot|agent|gpt|answer|a|model|support|response",
}
#: A name in brackets, or a name (perhaps as a heading or in bold) and a colon, arrow or line end.
_SHAPE = (r"^\s*(?:(?:\[|<\|?)(?i:{names})(?:\]|\|?>)\s*:?"
          r"|(?:#+\s*|\*\*)?(?i:{names})(?:\*\*)?\s*(?::|>|$)(?:\*\*)?)\s*")

N_SYMBOLS = 1 + 4 * 2 * 3


def marker_pattern(role: str) -> str:
    return _SHAPE.format(names="(?:" + MARKERS[role] + ")")


def symbol(line: Column) -> Column:
    """0 for a blank line, else 1 to 24 from marker, closing question mark and length."""
    body = F.trim(line)
    marker = F.lit(0)
    for k, role in reversed(list(enumerate(ROLES))):
        marker = F.when(line.rlike(marker_pattern(role)), F.lit(k + 1)).otherwise(marker)
    size = F.when(F.length(body) < 40, 0).when(F.length(body) < 200, 1).otherwise(2)
    return F.when(F.length(body) == 0, 0).otherwise(
        1 + (marker * 2 + F.when(body.endswith("?"), 1).otherwise(0)) * 3 + size).cast("int")


def without_marker(line: Column) -> Column:
    out = line
    for role in ROLES:
        found = line.rlike(marker_pattern(role))
        out = F.when(found, F.regexp_replace(line, marker_pattern(role), "")).otherwise(out)
    return out


# ---------------------------------------------------------------- the model

class Hmm:
    """Log probabilities: ``step[i, j]`` from state i (or START) to j, ``emit[j, symbol]``."""

    def __init__(self, steps: np.ndarray, emissions: np.ndarray, prior: float = 0.1):
        self.step = np.log((steps + prior) / (steps + prior).sum(1, keepdims=True))
        self.emit = np.log((emissions + prior) / (emissions + prior).sum(1, keepdims=True))


def fit(labelled: DataFrame, span: int) -> Hmm:
    """Count transitions and emissions of lines with known states (columns conv_id, pos,
    line, state). Neighbours inside a chunk are paired by a window over the chunk, and
    chunk borders by joining each chunk's last line with the next chunk's first."""
    lines = labelled.select("conv_id", "pos", F.floor(F.col("pos") / span).alias("chunk"), "state",
                            symbol(F.col("line")).alias("symbol"))
    inner = lines.withColumn("before", F.lag("state").over(Window.partitionBy("conv_id", "chunk").orderBy("pos")))
    ends = lines.groupBy("conv_id", "chunk").agg(F.min_by("state", "pos").alias("head"), F.max_by("state", "pos").alias("tail"))
    after = ends.select("conv_id", (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("before"))
    border = ends.join(after, ["conv_id", "chunk"], "left").select(
        F.coalesce("before", F.when(F.col("chunk") == 0, START)).alias("before"), F.col("head").alias("state"))
    steps, emissions = np.zeros((S + 1, S)), np.zeros((S, N_SYMBOLS))
    pairs = inner.select("before", "state").unionByName(border).where("before is not null")
    for i, j, n in pairs.groupBy("before", "state").count().collect():  # at most (S + 1) * S rows
        steps[i, j] += n
    for i, k, n in lines.groupBy("state", "symbol").count().collect():  # at most S * N_SYMBOLS rows
        emissions[i, k] += n
    return Hmm(steps, emissions)


# ---------------------------------------------------------------- exact Viterbi in chunks

def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of (.., n, n) matrices."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(-2)


def chunk_matrix(hmm: Hmm, symbols: np.ndarray) -> np.ndarray:
    """Best score from the state before the chunk to the state of its last line; START is
    only ever left."""
    out = np.full((S + 1, S + 1), -np.inf)
    out[:, :S] = hmm.step + hmm.emit[:, symbols[0]]
    for k in symbols[1:]:
        out[:, :S] = (out[:, :S, None] + hmm.step[None, :S]).max(1) + hmm.emit[:, k]
    return out


def chunk_path(hmm: Hmm, symbols: np.ndarray, entry: int, leave: int) -> np.ndarray:
    """Best states of a chunk's lines between the state before it and its last state."""
    score = hmm.step[entry] + hmm.emit[:, symbols[0]]
    back = np.zeros((len(symbols), S), np.int64)
    for t, k in enumerate(symbols[1:], 1):
        ways = score[:, None] + hmm.step[:S]
        back[t] = ways.argmax(0)
        score = ways.max(0) + hmm.emit[:, k]
    path = np.empty(len(symbols), np.int64)
    path[-1] = leave
    for t in range(len(symbols) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def _borders(mats: np.ndarray, entry: int, leave: int) -> list[int]:
    """Best states after each of the children, given the state before and after all."""
    score = [np.full(S + 1, -np.inf)]
    score[0][entry] = 0.0
    back = []
    for m in mats:
        ways = score[-1][:, None] + m
        back.append(ways.argmax(0))
        score.append(ways.max(0))
    states = [leave]
    for b in reversed(back[1:]):
        states.append(int(b[states[-1]]))
    return states[::-1]


def _group_rows(df: DataFrame, value: str) -> DataFrame:
    """Children of each node in order: (conv_id, up, ks, values)."""
    kids = F.sort_array(F.collect_list(F.struct("k", F.col(value).alias("v"))))
    return (df.groupBy("conv_id", F.floor(F.col("k") / FAN).alias("up")).agg(kids.alias("kids"))
            .select("conv_id", "up", F.col("kids.k").alias("ks"), F.col("kids.v").alias("vs")))


def viterbi(lines: DataFrame, hmm: Hmm, span: int) -> DataFrame:
    """(conv_id, chunk, pos, state) of every line of ``lines`` (conv_id, pos, symbol)."""
    shared = lines.sparkSession.sparkContext.broadcast(hmm)
    packed = F.sort_array(F.collect_list(F.struct("pos", "symbol")))
    chunks = pin(lines.groupBy("conv_id", F.floor(F.col("pos") / span).alias("k")).agg(packed.alias("l"))
                 .select("conv_id", "k", F.col("l.pos").alias("pos"), F.col("l.symbol").alias("symbols")), "chat-chunks")

    def reduce_chunks(batches):
        for batch in batches:
            mats = [chunk_matrix(shared.value, s.values.to_numpy()).reshape(-1) for s in batch.column("symbols")]
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "k": batch.column("k"),
                                              "m": pa.array(mats, pa.list_(pa.float64()))})

    level = pin(chunks.select("conv_id", "k", "symbols").mapInArrow(reduce_chunks, "conv_id long, k long, m array<double>"),
                "chat-level")
    levels = [level]
    while (level.agg(F.max("k")).head()[0] or 0) > 0:
        def multiply(batches):
            for batch in batches:
                mats = []
                for vs in batch.column("vs"):
                    total = None
                    for m in _matrices(vs):
                        total = m if total is None else _times(total, m)
                    mats.append(total.reshape(-1))
                yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "k": batch.column("up"),
                                                  "m": pa.array(mats, pa.list_(pa.float64()))})

        level = pin(_group_rows(level, "m").mapInArrow(multiply, "conv_id long, k long, m array<double>"), "chat-level")
        levels.append(level)

    def best_end(batches):
        for batch in batches:
            ends = [int(np.asarray(m.values).reshape(S + 1, S + 1)[START, :S].argmax()) for m in batch.column("m")]
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "k": batch.column("k"),
                                              "entry": pa.array([START] * len(ends), pa.int32()),
                                              "leave": pa.array(ends, pa.int32())})

    fixed = levels[-1].mapInArrow(best_end, "conv_id long, k long, entry int, leave int")
    for lower in reversed(levels[:-1]):
        def descend(batches):
            for batch in batches:
                rows = []
                cols = [batch.column(c) for c in ("conv_id", "ks", "vs", "entry", "leave")]
                for conv, ks, vs, entry, leave in zip(*cols):
                    after = _borders(np.stack(_matrices(vs)), entry.as_py(), leave.as_py())
                    before = [entry.as_py()] + after[:-1]
                    rows += zip([conv.as_py()] * len(after), ks.as_py(), before, after)
                c = list(zip(*rows))
                yield pa.RecordBatch.from_pydict({"conv_id": pa.array(c[0], pa.int64()), "k": pa.array(c[1], pa.int64()),
                                                  "entry": pa.array(c[2], pa.int32()), "leave": pa.array(c[3], pa.int32())})

        groups = _group_rows(lower, "m")
        joined = groups.join(fixed, groups.conv_id.eqNullSafe(fixed.conv_id) & (groups.up == fixed.k)).select(
            groups.conv_id, "ks", "vs", "entry", "leave")
        fixed = joined.mapInArrow(descend, "conv_id long, k long, entry int, leave int")

    fixed = pin(fixed, "chat-borders")

    def paths(batches):
        for batch in batches:
            cols = [batch.column(c) for c in ("symbols", "entry", "leave")]
            found = [chunk_path(shared.value, s.values.to_numpy(), e.as_py(), l.as_py()).astype(np.int32) for s, e, l in zip(*cols)]
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "chunk": batch.column("k"),
                                              "pos": batch.column("pos"), "state": pa.array(found, pa.list_(pa.int32()))})

    met = chunks.join(fixed, chunks.conv_id.eqNullSafe(fixed.conv_id) & (chunks.k == fixed.k)).select(
        chunks.conv_id, chunks.k, "pos", "symbols", "entry", "leave")
    solved = met.mapInArrow(paths, "conv_id long, chunk long, pos array<long>, state array<int>")
    return solved.select("conv_id", "chunk", F.explode(F.arrays_zip("pos", "state")).alias("x")).select(
        "conv_id", "chunk", F.col("x.pos").alias("pos"), F.col("x.state").alias("state"))


def _matrices(values) -> list[np.ndarray]:
    return [np.asarray(v.values).reshape(S + 1, S + 1) for v in values]


# ---------------------------------------------------------------- positions

def starts_of(rows: DataFrame, group: str, order: list[str], size: Column) -> DataFrame:
    """``rows`` with start, the sum of ``size`` over the rows before it in its group, in the
    ``order`` given (nulls last); equal rows are told apart by their place in the input.
    Rows are cut into ranges, so a group of any size is spread; a group's ranges, not its
    rows, meet in one task."""
    by = [F.col(group).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order], F.col("_row")]
    ranged = pin(rows.withColumn("_size", size.cast("long")).withColumn("_row", F.monotonically_increasing_id())
                 .repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "chat-ranges")
    own = Window.partitionBy("_range", group).orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.sum("_size").alias("_sum"))
    base = ranges.select("_g", "_r", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    placed = ranged.withColumn("_own", F.coalesce(F.sum("_size").over(own), F.lit(0)))
    return (placed.join(base, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
            .withColumn("start", F.col("_base") + F.col("_own"))
            .drop("_size", "_row", "_range", "_own", "_g", "_r", "_base"))


# ---------------------------------------------------------------- turns

def parse_transcripts(lines: DataFrame, hmm: Hmm, span: int = 1 << 26) -> DataFrame:
    """One row per recovered turn: conv_id, turn, role, text, rendered.

    ``lines`` has conv_id, pos (unique within a conversation, 0 or more, never null; see
    starts_of) and line; a null line is blank, and a null conv_id is a conversation of its
    own. Lines of a conversation up to its
    second turn's first line are its first turn, whatever their states. ``text`` is the
    turn's lines without the speaker marker and outer blank lines, ``rendered`` the
    canonical ``<|role|>`` block. An empty table gives no rows.
    """
    bounded_batches(lines.sparkSession)
    told = lines.select("conv_id", F.col("pos").cast("long").alias("pos"), F.coalesce("line", F.lit("")).alias("line"))
    states = pin(viterbi(told.select("conv_id", "pos", symbol(F.col("line")).alias("symbol")), hmm, span)
                 .distinct(), "chat-states")
    # a turn starts at a first line; its key and number are carried across chunks by levels of sums
    first = (F.col("state") % 3 == 0)
    own = Window.partitionBy("conv_id", "chunk").orderBy("pos")
    marked = states.withColumn("n", F.sum(first.cast("long")).over(own)).withColumn(
        "at", F.last(F.when(first, F.col("pos")), ignorenulls=True).over(own)).withColumn(
        "role", F.last(F.when(first, F.floor(F.col("state") / 3)), ignorenulls=True).over(own))
    carried = _carry(states.where(first).groupBy("conv_id", F.col("chunk").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.max("pos").alias("at"), F.floor(F.max_by("state", "pos") / 3).alias("role"))
        .unionByName(states.select("conv_id", F.col("chunk").alias("k"), F.lit(0).cast("long").alias("n"),
                                   F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("role")).distinct())
        .groupBy("conv_id", "k").agg(F.sum("n").alias("n"), F.max("at").alias("at"), F.max("role").alias("role")))
    c = carried.select(F.col("conv_id").alias("_c"), F.col("k").alias("_k"), F.col("n").alias("n0"),
                       F.col("at").alias("at0"), F.col("role").alias("role0"))
    keyed = marked.join(c, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("chunk") == F.col("_k")), "left").select(
        "conv_id", "pos", (F.greatest(F.coalesce("n0", F.lit(0)) + F.col("n"), F.lit(1)) - 1).alias("turn"),
        F.coalesce("role", "role0", F.floor(F.col("state") / 3)).alias("role"),
        (F.col("state") % 3).alias("kind"))
    k = keyed.select(F.col("conv_id").alias("_c"), F.col("pos").alias("_p"), "turn", "role", "kind")
    whole = told.join(k, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("pos") == F.col("_p")))
    shown = F.when(F.col("kind") == 0, without_marker(F.col("line"))).otherwise(F.col("line"))
    turns = whole.select("conv_id", "turn", "role", "pos", shown.alias("line")).groupBy("conv_id", "turn").agg(
        F.min_by("role", "pos").cast("int").alias("role"),
        F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    text = F.regexp_replace(F.array_join(F.col("lines.line"), "\n"), r"^[ \t]*\n+|\s+$", "")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("role") + 1)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")))


def _carry(nodes: DataFrame) -> DataFrame:
    """For nodes (conv_id, k, n, at, role): over all earlier nodes of the conversation, the
    sum of n and the last at and role. Sums of FAN neighbours go up level by level and
    come down again, so no conversation's nodes meet in one task."""
    levels = [pin(nodes, "chat-carry")]
    while (levels[-1].agg(F.max("k")).head()[0] or 0) > 0:
        up = levels[-1].groupBy("conv_id", F.floor(F.col("k") / FAN).alias("k")).agg(
            F.sum("n").alias("n"), F.max_by("at", F.when(F.col("at").isNotNull(), F.col("k"))).alias("at"),
            F.max_by("role", F.when(F.col("at").isNotNull(), F.col("k"))).alias("role"))
        levels.append(pin(up, "chat-carry"))
    above = None
    for level in reversed(levels):
        before = Window.partitionBy("conv_id", F.floor(F.col("k") / FAN)).orderBy("k").rowsBetween(
            Window.unboundedPreceding, -1)
        here = level.select("conv_id", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
                            F.last("at", ignorenulls=True).over(before).alias("at"),
                            F.last("role", ignorenulls=True).over(before).alias("role"))
        if above is not None:
            a = above.select(F.col("conv_id").alias("_c"), F.col("k").alias("_k"), F.col("n").alias("_n"),
                             F.col("at").alias("_at"), F.col("role").alias("_role"))
            here = here.join(a, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.floor(F.col("k") / FAN) == F.col("_k"))
                             ).select("conv_id", "k", (F.col("n") + F.col("_n")).alias("n"),
                                      F.coalesce("at", "_at").alias("at"), F.coalesce("role", "_role").alias("role"))
        above = pin(here, "chat-carried")
    return above
