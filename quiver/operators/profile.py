"""Profiles and small aggregates."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """``count(distinct c)`` for several columns in one job.

    Exact mode dedups (value, column) pairs map-side before the shuffle;
    ``approx=True`` uses HyperLogLog++ (one pass, fixed-size state).
    """
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(*[f(c).cast("bigint").alias(f"n_{c}") for c in cols])


def peek(df: DataFrame, order_col: str, cols: list[str]) -> DataFrame:
    """Row count and the first row by ``order_col`` in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(order_col).alias(f"first_{order_col}"),
        *[F.min_by(c, order_col).alias(f"first_{c}") for c in cols],
    )


def head(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows under a total order (a bounded top-n, not a sort)."""
    return df.orderBy(*order_cols).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, dtype, n_values) in column order; ``n_values`` counts
    non-NULL values, one aggregate for all columns."""
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    each = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("dtype"),
                              F.col(f"c{i}").alias("n_values")) for i, (c, t) in enumerate(df.dtypes)])
    return counts.select(F.explode(each).alias("e")).select("e.*")


def most_common(df: DataFrame, col: str, n: int, count_col: str = "n") -> DataFrame:
    """Top-n values by count, ties by value; a bounded top-k after a partial count."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.desc(count_col), F.asc(col)).limit(n)


def playlist_names(playlists: DataFrame, id_col: str = "playlist_id") -> DataFrame:
    """Distinct ``id.split('-')[1].lower().strip()``."""
    name = F.lower(F.trim(F.try_element_at(F.split(id_col, "-"), F.lit(2))))
    return playlists.select(name.alias("playlist_name")).distinct()


def keyword_grams(words: list[str], longest: int = 3) -> list[tuple[str, str, int]]:
    """(gram, word, priority) of every different keyword, first occurrence first: of its grams
    of ``longest`` letters the one that fewest keywords hold (a shorter word is its own gram)."""
    first = {}
    for i, w in enumerate(words):
        first.setdefault(w, i + 1)
    grams = {w: {w[i: i + longest] for i in range(max(len(w) - longest, 0) + 1)} for w in first}
    held = Counter(g for own in grams.values() for g in own)
    return [(min(grams[w], key=lambda g: (held[g], g)), w, i) for w, i in first.items()]


def first_keyword(names: DataFrame, col: str, words: list[str], longest: int = 3) -> DataFrame:
    """(col, word, priority): for every different name that contains a keyword, the earliest one
    in ``words``. Names and keywords meet on one gram of the keyword, so the work follows the
    names' letters and not the number of keywords."""
    rows = keyword_grams(words, longest)
    kw = F.broadcast(names.sparkSession.createDataFrame(rows, "_gram string, word string, priority int"))  # the parameter's size
    sizes = sorted({len(g) for g, _, _ in rows})
    own = names.select(col).where(F.col(col).isNotNull()).distinct()
    none = F.array().cast("array<string>")

    def grams(n: int):
        last = F.length(col) - n + 1
        every = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(col, i, F.lit(n)))
        return F.when(last >= 1, every).otherwise(none)

    met = own.select(col, F.explode(F.array_distinct(F.concat(none, *map(grams, sizes)))).alias("_gram")).join(kw, "_gram")
    found = met.where(F.col(col).contains(F.col("word"))).groupBy(col).agg(F.min(F.struct("priority", "word")).alias("_m"))
    return found.select(col, "_m.word", "_m.priority")


def tag_categories(tracks: DataFrame, seqs: DataFrame, words: list[str]) -> DataFrame:
    """Each track is 'unknown' until a playlist whose id contains a
    keyword holds it; the earliest keyword in ``words`` wins."""
    named = first_keyword(seqs, "playlist_id", words)
    hits = (seqs.join(named, "playlist_id").select(F.explode("track_sequence").alias("track_id"), "priority", "word")
                .join(tracks.select("track_id"), "track_id", "left_semi")
                .groupBy("track_id").agg(F.min(F.struct("priority", "word")).alias("_m")))
    return tracks.join(hits, "track_id", "left").select("track_id", F.coalesce("_m.word", F.lit("unknown")).alias("category"))


def class_distribution(df: DataFrame, class_col: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))


def histogram(values: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed (NumPy rule).

    min/max are scalar subqueries; a constant column is spread over
    [v - 0.5, v + 0.5] as NumPy does. Every bin is returned, empty ones with 0.
    """
    x = F.col(col).cast("double")
    mm = values.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()  # one job
    lo0, hi0 = F.coalesce(mm["lo"], F.lit(0.0)), F.coalesce(mm["hi"], F.lit(1.0))  # [0, 1] for no values
    same = hi0 == lo0
    lo = F.when(same, lo0 - 0.5).otherwise(lo0)
    hi = F.when(same, hi0 + 0.5).otherwise(hi0)
    width = (hi - lo) / bins
    b = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = (values.sparkSession.range(1)
             .select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
             .select("bin", (lo + F.col("bin") * width).alias("lo"),
                     (lo + (F.col("bin") + 1) * width).alias("hi")))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def contract_checks(df: DataFrame, model: str, col: str) -> DataFrame:
    """Unique and not_null contract tests; failures = offending values (unique) or rows (not_null)."""
    dup_values = (df.filter(F.col(col).isNotNull()).groupBy(col).count()
                    .filter(F.col("count") > 1))
    n_dup = dup_values.select(F.count(F.lit(1))).scalar()
    n_null = df.select(F.count_if(F.col(col).isNull())).scalar()
    return (df.sparkSession.range(1).select(  # two rows whatever the table holds
        F.explode(F.array(
            F.struct(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                     F.lit("unique").alias("test"), n_dup.cast("bigint").alias("failures")),
            F.struct(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                     F.lit("not_null").alias("test"), n_null.cast("bigint").alias("failures")),
        )).alias("c"))
        .select("c.*", (F.col("c.failures") == 0).alias("passed")))


def onehot_check(df: DataFrame, vec_col: str) -> DataFrame:
    """Every one-hot vector sums to exactly 1."""
    s = F.aggregate(F.col(vec_col), F.lit(0.0), lambda acc, v: acc + v)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.bool_and(s == 1.0), F.lit(True)).alias("all_valid"))


def best_by_metric(df: DataFrame, group_cols: list[str], item_col: str, metric_col: str,
                   order_col: str, floor: float | None = None) -> DataFrame:
    """Arg-max of ``metric_col`` per group, the first (lowest ``order_col``)
    winning ties. With ``floor``, only metrics strictly above it can win."""
    d = df if floor is None else df.filter(F.col(metric_col) > F.lit(floor))
    key = F.struct(F.col(metric_col), (-F.col(order_col)).alias("_o"))
    return d.groupBy(*group_cols).agg(
        F.max_by(item_col, key).alias(f"best_{item_col}"),
        F.max(metric_col).alias(f"best_{metric_col}"))


def last_record_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Last-write-wins row per key under a total order (a map-side
    combinable ``max_by``, not a window)."""
    others = [c for c in df.columns if c != key]
    rec = F.max_by(F.struct(*others), F.struct(*order_cols))
    return df.groupBy(key).agg(rec.alias("_r")).select(key, "_r.*")
