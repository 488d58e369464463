"""Exact ranks and top-N without a one-partition window (section 4.3 recipes).

``global_rank``: rank rows by a seeded md5 of a key, exactly as
``row_number() over (order by md5(key||seed), key)`` would, but the sort is
spread over ``16**digits`` hash buckets; bucket offsets come from a running
sum over a table of at most ``16**digits`` rows, which is broadcast (its size
is bounded by construction, not by the data).

``top_n_per_group``: ``row_number() over (partition by g order by o) <= n`` in
two rounds, first inside (group, spread bucket) cells, then over at most
``n * buckets`` candidates per group, so one hot group never lands whole in
one task.

``rank_by`` and ``running_sums``: rank / exclusive running sums under any
order. Rows are range-partitioned and sorted once, get their partition and
place as columns, and that frame is pinned; partition totals and rows are then
both read from the pinned copy, so they always agree. The number of partitions
follows ``spark.sql.shuffle.partitions`` and AQE, unless given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.common import seeded_hash

def require_bounded(df: DataFrame, max_rows: int, what: str) -> None:
    """Refuse to pack ``df`` into one value when it is larger than ``max_rows``
    (lists shipped as scalar subqueries must have a measured bound)."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; not packable into one value")


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later branches read one fixed
    copy (deterministic range sampling, no recomputation, survives executor loss)."""
    return df.checkpoint(eager=True)


def _order_exprs(order_cols):
    out = []
    for c in order_cols:
        out.append(F.col(c) if isinstance(c, str) else c)
    return out


def global_rank(df: DataFrame, key_cols: list[str], seed, rank_col: str = "rank",
                total_col: str | None = "n_total", group_cols: list[str] | None = None,
                digits: int = 3) -> DataFrame:
    """Dense 1-based rank by ``md5(key || seed), key`` (optionally within groups).

    Keys are expected to be unique (within a group); rows with equal keys get
    distinct but arbitrary ranks among themselves.
    """
    group_cols = list(group_cols or [])
    h = seeded_hash(key_cols, seed)
    d = pin(df.withColumn("_qh", h)  # read twice below
              .withColumn("_qb", F.conv(F.substring("_qh", 1, digits), 16, 10).cast("int")))
    w_local = Window.partitionBy(*group_cols, "_qb").orderBy("_qh", *key_cols)
    ranked = d.withColumn("_qlr", F.row_number().over(w_local))
    counts = d.groupBy(*group_cols, "_qb").agg(F.count(F.lit(1)).alias("_qn"))
    w_run = (Window.partitionBy(*group_cols).orderBy("_qb")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *group_cols, "_qb",
        F.coalesce(F.sum("_qn").over(w_run), F.lit(0)).alias("_qoff"),
        F.sum("_qn").over(Window.partitionBy(*group_cols)).alias("_qtot"),
    )
    if not group_cols:
        # at most 16**digits rows: a proven size bound
        offsets = F.broadcast(offsets)
    out = ranked.join(offsets, [*group_cols, "_qb"])
    out = out.withColumn(rank_col, (F.col("_qlr") + F.col("_qoff")).cast("bigint"))
    if total_col:
        out = out.withColumn(total_col, F.col("_qtot").cast("bigint"))
    return out.drop("_qh", "_qb", "_qlr", "_qoff", "_qtot", "_qn")


def top_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list, n: int,
                    rank_col: str | None = None, buckets: int = 64) -> DataFrame:
    """Rows with ``row_number() over (partition by group order by order_cols) <= n``.

    ``order_cols`` must give a total order inside each group. Round one keeps
    the top ``n`` of each (group, bucket) cell; round two ranks the survivors.
    """
    order = _order_exprs(order_cols)
    hashable = [c for c, t in df.dtypes if not t.startswith("map")]  # maps cannot be hashed
    spread = F.pmod(F.xxhash64(*hashable), F.lit(buckets))
    d = df.withColumn("_tb", spread)
    w1 = Window.partitionBy(*group_cols, "_tb").orderBy(*order)
    cand = d.withColumn("_tr", F.row_number().over(w1)).filter(F.col("_tr") <= n)
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    out = cand.withColumn("_tr2", F.row_number().over(w2)).filter(F.col("_tr2") <= n)
    if rank_col:
        out = out.withColumn(rank_col, F.col("_tr2").cast("bigint"))
    return out.drop("_tb", "_tr", "_tr2")


def _range_sorted(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    """``df`` in range partitions under ``order``, sorted, pinned, with columns
    ``_rp`` (partition) and ``_rl`` (1-based place in it) taken right after the sort."""
    part = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    local = (part.sortWithinPartitions(*order)
                 .withColumn("_rp", F.spark_partition_id())
                 .withColumn("_rl", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition << 33) + position inside the partition
    return pin(local.withColumn("_rl", F.col("_rl") - F.shiftleft(F.col("_rp").cast("bigint"), 33) + 1))


def rank_by(df: DataFrame, order_cols: list, rank_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """Dense 1-based rank under an arbitrary total order, without a
    one-partition window: rows numbered inside each sorted range partition, plus
    the row counts of all earlier partitions (one row per partition, broadcast)."""
    local = _range_sorted(df, _order_exprs(order_cols), partitions)
    counts = local.groupBy("_rp").agg(F.count(F.lit(1)).alias("_rn"))
    w = Window.orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rp", F.coalesce(F.sum("_rn").over(w), F.lit(0)).alias("_ro"))
    out = local.join(F.broadcast(offsets), "_rp")  # one row per partition
    return out.withColumn(rank_col, (F.col("_rl") + F.col("_ro")).cast("bigint")).drop("_rp", "_rl", "_ro")


def running_sums(df: DataFrame, order_col: str, value_cols: list[str], group_cols: list[str] | None = None,
                 descending: bool = False, partitions: int | None = None) -> DataFrame:
    """Exclusive running sums ``sum(v) over (partition by g order by o rows
    unbounded preceding .. 1 preceding)`` for each ``v``, spread over range
    partitions: partition-local windows plus the totals of earlier partitions
    of the same group (one row per (group, partition)).

    ``order_col`` must be unique within a group (aggregate to distinct values first).
    Adds ``before_<v>`` columns.
    """
    group_cols = list(group_cols or [])
    o = F.desc(order_col) if descending else F.asc(order_col)
    part = _range_sorted(df, [*[F.asc(g) for g in group_cols], o], partitions)
    w = (Window.partitionBy("_rp", *group_cols).orderBy("_rl")
         .rowsBetween(Window.unboundedPreceding, -1))
    local = part.withColumns({f"_l_{v}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in value_cols})
    totals = part.groupBy(*group_cols, "_rp").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    w2 = (Window.partitionBy(*group_cols).orderBy("_rp")
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("_rp", *[F.col(g).alias(f"_g_{g}") for g in group_cols],
                            *[F.coalesce(F.sum(f"_t_{v}").over(w2), F.lit(0)).alias(f"_o_{v}")
                              for v in value_cols])
    # without groups the offsets table has one row per partition (a proven
    # bound, broadcast); with groups it grows with the group count: AQE decides
    offsets = offsets if group_cols else F.broadcast(offsets)
    same = local["_rp"] == offsets["_rp"]
    for g in group_cols:  # a null group is a group
        same = same & local[g].eqNullSafe(offsets[f"_g_{g}"])
    out = local.join(offsets, same).drop(offsets["_rp"], *[f"_g_{g}" for g in group_cols])
    out = out.withColumns({f"before_{v}": F.col(f"_l_{v}") + F.col(f"_o_{v}") for v in value_cols})
    return out.drop("_rp", "_rl", *[f"_l_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])
