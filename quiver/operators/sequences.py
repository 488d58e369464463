"""Ordered per-key sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add_playlist_ids(raw: DataFrame) -> DataFrame:
    """``*`` plus composite keys ``user_id-playlist`` and ``artist|||track``.

    ``concat_ws('')`` skips NULL parts like DuckDB ``CONCAT`` (plain ``concat``
    would return NULL).
    """
    return raw.withColumns({
        "playlist_id": F.concat_ws("", F.col("user_id"), F.lit("-"), F.col("playlist")),
        "track_id": F.concat_ws("", F.col("artist"), F.lit("|||"), F.col("track")),
    })


def ordered_lists(df: DataFrame, key: str, order_col: str, value_cols: list[str]) -> DataFrame:
    """``LIST(v ORDER BY order_col)`` per key for several value columns at once.

    Structs are collected (bare ``collect_list`` drops NULL elements) and
    sorted once; each value list is a ``transform`` of the one sorted array.
    ``collect_list`` is partially aggregated before the shuffle.
    """
    s = F.sort_array(F.collect_list(F.struct(order_col, *value_cols)))
    out = df.groupBy(key).agg(s.alias("_seq"))
    return out.select(key, *[F.transform("_seq", _field(c)).alias(f"{c}_list") for c in value_cols])


def _field(name: str):
    return lambda e: e[name]


def leave_last_out(seq_col) -> tuple:
    """(all but last, last) of an array column."""
    c = F.col(seq_col) if isinstance(seq_col, str) else seq_col
    return F.slice(c, 1, F.size(c) - 1), F.element_at(c, -1)


def playlist_sequences(playlists: DataFrame, min_len: int = 3) -> DataFrame:
    """D04+D05+S05: artist and track sequences per playlist in row order,
    the next-track test pair (all but last, last), kept when len > min_len - 1."""
    seq = ordered_lists(playlists, "playlist_id", "row_id", ["artist", "track_id"])
    seq = seq.filter(F.size("track_id_list") >= min_len)
    x, y = leave_last_out("track_id_list")
    return seq.select(
        "playlist_id",
        F.col("artist_list").alias("artist_sequence"),
        F.col("track_id_list").alias("track_sequence"),
        x.alias("track_test_x"),
        y.alias("track_test_y"),
    )


def last_pairs(df: DataFrame, key: str, order_col: str, value_col: str, min_len: int = 3) -> DataFrame:
    """P05 without the sequences: (key, x_last, y), the last two values of every key by
    ``order_col`` (unique per key), for keys of at least ``min_len`` (2 or more) rows.

    Only a key's last ``min_len`` rows are ever needed. Spark limits each task's rows to that
    number per key before they are shuffled, so a key with any share of all rows sends
    ``min_len`` rows per task and no list is built."""
    newest = Window.partitionBy(key).orderBy(F.desc(order_col))
    top = (df.select(key, order_col, value_col).withColumn("_n", F.row_number().over(newest))
           .where(F.col("_n") <= max(min_len, 2)))
    last = top.groupBy(key).agg(F.max(F.when(F.col("_n") == 1, F.col(value_col))).alias("y"),
                                F.max(F.when(F.col("_n") == 2, F.col(value_col))).alias("x_last"),
                                F.max("_n").alias("_len"))
    return last.where(F.col("_len") >= max(min_len, 2)).select(key, "x_last", "y")


def next_pairs(df: DataFrame, key: str, order_col: str, value_col: str, chunk_size: int = 100_000) -> DataFrame:
    """(item, next_item, n): how often an item follows another in a key's order, from chunk rows:
    neighbours inside a chunk, and the last of a chunk with the first of the next one."""
    chunks = ordered_chunks(df, key, order_col, [value_col], chunk_size)
    items = F.col(f"{value_col}_list")
    inside = chunks.select(F.explode(F.arrays_zip(F.slice(items, 1, F.size(items) - 1).alias("a"),
                                                  F.slice(items, 2, F.size(items)).alias("b"))).alias("p")).select("p.*")
    ends = chunks.select(key, "chunk", items[0].alias("first"), F.element_at(items, -1).alias("last"))
    after = ends.select(F.col(key).alias("_key"), (F.col("chunk") - 1).alias("_chunk"), F.col("first").alias("b"))
    across = ends.join(after, ends[key].eqNullSafe(F.col("_key")) & (F.col("chunk") == F.col("_chunk"))).select(
        F.col("last").alias("a"), "b")
    both = inside.toDF("item", "next_item").unionByName(across.toDF("item", "next_item"))
    return both.groupBy("item", "next_item").agg(F.count(F.lit(1)).alias("n"))


def flatten_items(df: DataFrame, list_col: str, item_name: str = "item") -> DataFrame:
    """One bag of items from a list column."""
    return df.select(F.explode(list_col).alias(item_name))


def sequence_positions(df: DataFrame, key: str, order_col: str, pos_col: str = "pos") -> DataFrame:
    """1-based position of every row inside its key, by ``order_col`` (unique per key).

    Computed as a running count over range partitions of (key, order), so a
    key holding a large share of all rows is split across tasks instead of
    being numbered by one window."""
    from quiver.operators.ranking import running_sums

    d = df.withColumn("_one", F.lit(1))
    r = running_sums(d, order_col, ["_one"], group_cols=[key])
    return r.withColumn(pos_col, (F.col("before__one") + 1).cast("bigint")).drop("_one", "before__one")


def ordered_chunks(df: DataFrame, key: str, order_col: str, value_cols: list[str],
                   chunk_size: int = 100_000) -> DataFrame:
    """D04 in bounded pieces: the ordered list of each key cut into consecutive
    chunks of at most ``chunk_size`` elements, one row per (key, chunk).

    Concatenating a key's chunks by ``chunk`` gives exactly ``ordered_lists``;
    no array (and no task's collect) grows beyond ``chunk_size`` elements, so
    a key with billions of rows stays buildable."""
    pos = sequence_positions(df, key, order_col)
    pos = pos.withColumn("chunk", F.floor((F.col("pos") - 1) / chunk_size).cast("bigint"))
    s = F.sort_array(F.collect_list(F.struct("pos", *value_cols)))
    out = pos.groupBy(key, "chunk").agg(s.alias("_seq"))
    return out.select(key, "chunk", *[F.transform("_seq", _field(c)).alias(f"{c}_list") for c in value_cols])
