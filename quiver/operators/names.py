"""Names that differ by a few edits (L03: "Get Lucky - Radio Edit" next to "Get Lucky").

A similarity self-join on edit distance without comparing all pairs. A name is cut into
positional q-grams, rare grams first; two names within ``d`` edits share one of their first
``q * d + 1`` grams, at places at most ``d`` apart, and their lengths differ by at most ``d``.
So names meet on (gram, length, place) in steps, which also splits a gram that very many names hold;
names too short for that argument meet on what is left after deleting up to ``d`` letters.
A signature of the names' letter pairs rules most others out, and Spark's banded edit
distance decides. All expressions run in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin

_BUCKETS = 1 << 16  # of the gram counts that order the grams: what the driver holds


def clean_names(df: DataFrame, col: str) -> DataFrame:
    """(name, n_rows): lower-cased ASCII letters, digits and single blanks of a text column;
    names left empty, and NULL, are dropped."""
    plain = F.regexp_replace(F.lower(F.col(col)), "[^a-z0-9 ]", "")
    name = F.trim(F.regexp_replace(plain, " +", " "))
    return df.select(name.alias("name")).where(F.col("name") != "").groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


def _grams(q: int) -> Column:
    """Structs (gram, place) of the padded name, one per place. The letters are taken apart once,
    so a long name costs no more per gram than a short one."""
    return F.transform(F.slice("letters", 1, F.length("name") + q - 1), lambda c, i: F.struct(
        F.concat(*[F.get(F.col("letters"), i + k) for k in range(q)]).alias("gram"), (i + 1).alias("place")))


def _lettered(names: DataFrame, q: int) -> DataFrame:
    return names.withColumn("letters", F.split(F.concat(F.lit("\x01" * (q - 1)), F.col("name"), F.lit("\x02" * (q - 1))), ""))


def _signature(q: int) -> Column:
    """128 bits of the name's letter pairs, as an array of two longs. An edit takes at most two
    pairs away and brings two, so it changes at most four bits."""
    pairs = F.transform(F.slice("letters", q, F.greatest(F.length("name") - 1, F.lit(0))), lambda c, i: F.pmod(
        F.xxhash64(F.concat(c, F.get(F.col("letters"), i + q))), F.lit(128)).cast("int"))
    half = lambda k: F.aggregate(F.filter(pairs, lambda h: F.floor(h / 64) == k), F.lit(0).cast("long"),
                                 lambda acc, h: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), h)))
    return F.array(half(0), half(1))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(_BUCKETS)).cast("int")


def gram_levels(names: DataFrame, q: int) -> Column:
    """How common the grams of every bucket are, on a logarithmic scale of one byte each: a
    binary constant of a fixed size. Any order of the grams is right, this one is fast."""
    counts = (_lettered(names, q).select(F.explode(_grams(q)).alias("g")).groupBy(_bucket(F.col("g.gram")).alias("b"))
              .agg(F.count(F.lit(1)).alias("n")).collect())
    levels = bytearray(_BUCKETS)
    for r in counts:
        levels[r.b] = min(255, int(6 * math.log2(1 + r.n)))
    return F.lit(bytes(levels))


def _met_on_grams(names: DataFrame, d: int, q: int) -> DataFrame:
    levels = gram_levels(names, q)
    ordered = F.sort_array(F.transform(_grams(q), lambda g: F.struct(
        F.substring(levels, _bucket(g["gram"]) + 1, F.lit(1)).alias("level"), g["gram"].alias("gram"), g["place"].alias("place"))))
    first = pin(_lettered(names, q).select(F.xxhash64("name").alias("id"), F.length("name").alias("size"),
                                           _signature(q).alias("bits"), F.explode(F.slice(ordered, 1, q * d + 1)).alias("g")).select(
        "id", "size", "bits", F.col("g.gram").alias("gram"), F.col("g.place").alias("place")))
    # lengths and places are dealt in steps, so that a name asks for at most two of each
    by, at = d + 1, 2 * d + 1
    step = lambda c, k: F.floor(c / k).cast("int")
    held = first.withColumns({"long": step(F.col("size"), by), "where": step(F.col("place"), at)})
    asks = (first.select(F.col("id").alias("other"), "gram", F.col("size").alias("other_size"), F.col("bits").alias("other_bits"),
                         F.col("place").alias("other_place"))
            .withColumn("long", F.explode(F.sequence(step(F.col("other_size") - d, by), step(F.col("other_size"), by))))
            .withColumn("where", F.explode(F.sequence(step(F.col("other_place") - d, at), step(F.col("other_place") + d, at)))))
    apart = sum(F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("other_bits")[k])) for k in (0, 1))
    met = held.join(asks, ["gram", "long", "where"]).where(
        F.col("size").between(F.col("other_size") - d, F.col("other_size")) & (F.abs(F.col("place") - F.col("other_place")) <= d)
        & (apart <= 4 * d))
    pairs = met.select("id", "other").distinct()
    # hashes that agree by chance only bring more names to compare
    named = names.select(F.xxhash64("name").alias("id"), "name")
    return (pairs.join(named, "id").join(named.select(F.col("id").alias("other"), F.col("name").alias("other_name")), "other")
            .select("name", F.col("other_name").alias("other")))


def _met_on_deletions(names: DataFrame, d: int, longest: int) -> DataFrame:
    """Pairs of names of at most ``longest`` letters that are equal after up to ``d`` deletions each."""
    short = names.where(F.length("name") <= longest).select("name", F.array("name").alias("left"))
    for _ in range(d):
        fewer = F.flatten(F.transform("left", lambda w: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
            lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))
        short = short.select("name", F.array_distinct(F.concat("left", fewer)).alias("left"))
    rest = short.select("name", F.explode("left").alias("rest"))
    return rest.join(rest.select(F.col("name").alias("other"), "rest"), "rest").select("name", "other")


def similar_pairs(names: DataFrame, max_edits: int = 2, q: int = 3) -> DataFrame:
    """(name, other, distance): every pair of different names at most ``max_edits`` edits apart,
    each once, ``name`` the shorter one (the smaller of two of one length).

    ``names`` has distinct, non-empty ``name``s."""
    d = max_edits
    names = pin(names.select("name"))
    met = _met_on_grams(names, d, q).unionByName(_met_on_deletions(names, d, q * (d - 1) + 1))
    before = F.struct(F.length("name"), "name") < F.struct(F.length("other"), "other")
    near = met.where(before).withColumn("distance", F.levenshtein("name", "other", d))
    return near.where(F.col("distance") >= 0).distinct()


def similar_names(names: DataFrame, max_edits: int = 2, q: int = 3) -> DataFrame:
    """One row per name: name, n_rows, n_links (other names within ``max_edits``), the nearest
    of them (smallest distance, then smallest name; NULL without any) and its distance."""
    names = pin(names)
    pairs = pin(similar_pairs(names, max_edits, q))
    links = pairs.unionByName(pairs.select(F.col("other").alias("name"), F.col("name").alias("other"), "distance"))
    found = links.groupBy("name").agg(F.count(F.lit(1)).alias("n_links"),
                                      F.min(F.struct("distance", "other")).alias("best"))
    return names.join(found, "name", "left").select(
        "name", "n_rows", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("best.other").alias("nearest"), F.col("best.distance").alias("distance"))
