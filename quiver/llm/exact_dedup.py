"""Exact dedup by progressive refinement, in DataFrame functions only.

1. Every row is reduced to (length of the normalised text, hash of its first characters).
   Lengths that occur once leave the search.
2. Of the lengths left, groups of (length, prefix hash) that occur once leave.
3. The full content is hashed only for rows of the groups left, and equal hashes are
   one group of copies.

Texts are never shuffled: step 3 finds its rows inside the scan with a bit filter of
fixed size (``log2_bits``) over the surviving (length, prefix hash) groups. A row the
filter lets through by chance only costs one more hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import NULL_KEY, bit_filter, maybe_in, pin, suspects_of

#: The white space that does not count when texts are compared (fixed values).
SPACE = " \t\n\x0b\x0c\r"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256,
                log2_bits: int = 22, digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ASCII white space; of equal texts the
    row with the most code points, then the smallest id (null ids last) stays. Rows that
    repeat id and text are copies of each other: exactly one is kept. A null text counts
    as empty, and all empty texts are one group. ``text_sha256`` (lower-case hex of the
    normalised text) is null for rows that left the search before step 3, unless
    ``digest_all``. An empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, SPACE, "")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).alias("n_code_points"),
                       norm.alias("norm"))
    prefix = F.xxhash64(F.substring("norm", 1, prefix_chars))

    sized = pin(rows.select(F.length("norm").alias("n"), prefix.alias("p"))
                .groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows")), "dedup-sizes")
    by_length = sized.groupBy("n").agg(F.sum("rows").alias("rows")).where("rows > 1").select("n")
    open_groups = sized.join(by_length, "n", "left_semi").where("rows > 1").select("n", "p")

    key = F.struct("n", "p")
    held = bit_filter(key, open_groups, log2_bits)
    searched = maybe_in(held, F.struct(F.length("norm").alias("n"), prefix.alias("p")), log2_bits)
    digest = F.sha2("norm", 256)
    hashed = pin(rows.select("doc_id", "n_code_points", digest.alias("text_sha256") if digest_all else
                             F.when(searched, digest).alias("text_sha256"),
                             searched.alias("searched"))
                 .withColumn("row", F.monotonically_increasing_id()), "dedup-hashes")

    first = F.min(F.struct(-F.col("n_code_points"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
                           F.col("row"))).alias("first")
    # pinned, so that the join below deals both sides anew and a hot group can be split
    groups = pin(hashed.where("searched").groupBy("text_sha256").agg(first, F.count(F.lit(1)).alias("group_size"))
                 .where("group_size > 1")
                 .select(F.col("text_sha256").alias("g"), F.col("first.doc_id").alias("keep"),
                         F.col("first.row").alias("keep_row"), "group_size"), "dedup-groups")
    # rows outside the search get a key of their own, so that they do not meet in one partition
    on = F.when(F.col("searched"), F.col("text_sha256")).otherwise(F.concat(F.lit("row "), F.col("row")))
    return (hashed.join(groups, on == F.col("g"), "left")
            .select("doc_id", F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"), "text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns and one row of each group of equal texts (which one:
    see exact_dedup). Rows that repeat id and text leave one row; ids that repeat with
    different texts are separate rows."""
    norm = F.translate(F.coalesce(F.col(text_col), F.lit("")), SPACE, "")
    fate = pin(exact_dedup(docs, id_col, text_col, **options).where("text_sha256 is not null")
               .groupBy(F.col("doc_id").alias("_dup_id"), F.col("text_sha256").alias("_dup_sha"))
               .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "dedup-fate")
    # only rows with an id of a dropped or repeated one are joined (and hashed again)
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY))
    ids = fate.where("not kept or n > 1").select(F.coalesce("_dup_id", F.lit(NULL_KEY)).alias("_dup_key"))
    clear, suspects = suspects_of(docs, own, ids, "_dup_key")
    tagged = suspects.withColumn("_own_sha", F.sha2(norm, 256))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_dup_id")) & (F.col("_own_sha") == F.col("_dup_sha"))
    rest = tagged.join(fate.where("not kept"), same, "left_anti")
    again = fate.where("kept and n > 1")
    once = rest.join(again, same, "left_semi").dropDuplicates([id_col, "_own_sha"])
    return clear.unionByName(rest.join(again, same, "left_anti").unionByName(once).drop("_own_sha"))
