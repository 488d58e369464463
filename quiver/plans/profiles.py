"""Profile plans: histogram, contracts, report formatting, rounding, nested scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions import vectors as vf
from quiver.functions.common import r6, round_even
from quiver.operators import profile
from quiver.plans.playlists import _playlists
from quiver.plans.purchases import articles, customers, split_table
from quiver.plans.registry import plan
from quiver.plans.sqlparts import PLAYLISTS, SPLIT, STAGED_ARTICLES, STAGED_CUSTOMERS, with_
from quiver.sources.tables import read_table


@plan("freq_histogram", with_(PLAYLISTS) + """,
f AS (SELECT track_id, count(*)::DOUBLE AS x FROM playlists GROUP BY track_id),
mm AS (SELECT CASE WHEN max(x) = min(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN max(x) = min(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM f),
b AS (SELECT least(floor((x - lo) * 50 / (hi - lo)), 49)::INTEGER AS bin FROM f, mm),
bins AS (SELECT unnest(range(50))::INTEGER AS bin)
SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / 50), 6) AS lo, round(lo + (bins.bin + 1) * ((hi - lo) / 50), 6) AS hi,
       count(b.bin) AS n
FROM bins CROSS JOIN mm LEFT JOIN b ON b.bin = bins.bin GROUP BY bins.bin, mm.lo, mm.hi""")
def q_freq_histogram(spark, sf):
    """50 equal-width bins of track frequency (last bin closed)."""
    f = _playlists(spark, sf).groupBy("track_id").agg(F.count(F.lit(1)).alias("x"))
    h = profile.histogram(f, "x", 50)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


def _dup_sql(table, col):
    return (f"(SELECT count(*) FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1))")


_CONTRACT_ROWS = [("articles_staging", "articles", "article_id"), ("customers_staging", "customers", "customer_id")]


@plan("contract_checks", with_(STAGED_ARTICLES, STAGED_CUSTOMERS) + ", checks AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'unique' AS test, {_dup_sql(t, c)} AS failures "
    f"UNION ALL SELECT '{m}', '{c}', 'not_null', (SELECT count(*) FROM {t} WHERE {c} IS NULL)"
    for m, t, c in _CONTRACT_ROWS) + ") SELECT *, failures = 0 AS passed FROM checks")
def q_contract_checks(spark, sf):
    """Unique and not_null tests on the staged article and customer ids."""
    a = profile.contract_checks(articles(spark, sf), "articles_staging", "article_id")
    c = profile.contract_checks(customers(spark, sf), "customers_staging", "customer_id")
    return a.unionByName(c)


@plan("split_report", with_(SPLIT) + """
SELECT split, count(*) AS n, format('{:,}', count(*)) AS n_text,
       printf('%.2f%%', 100.0 * count(*) / (SELECT count(*) FROM split_rows)) AS share
FROM split_rows GROUP BY split""")
def q_split_report(spark, sf):
    """Rows per split with a thousands separator and a percent share."""
    s = split_table(spark, sf, ["split"])
    total = s.select(F.count(F.lit(1))).scalar()
    c = s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return c.select("split", "n", F.format_number("n", 0).alias("n_text"),
                    F.format_string("%.2f%%", F.lit(100.0) * F.col("n") / total).alias("share"))


@plan("round_even", """
SELECT DISTINCT l_quantity / 8 AS value, round_even(l_quantity / 8, 2) AS half_even,
       round(l_quantity / 8, 2) AS half_up FROM lineitem""")
def q_round_even(spark, sf):
    """Python-style half-even rounding next to half-up, on exact binary ties."""
    li = read_table(spark, sf, "lineitem")
    v = (F.col("l_quantity") / 8)
    return li.select(v.alias("value"), round_even(v, 2).alias("half_even"), F.round(v, 2).alias("half_up")).distinct()


@plan("nested_scale", """
WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, unnest(range(0, len(embedding), 8)) // 8 AS row FROM embeddings)
SELECT vec_id, row, round(list_sum(list_transform(list_slice(v, row * 8 + 1, row * 8 + 8), lambda x: x * 10)), 6) AS total FROM n""")
def q_nested_scale(spark, sf):
    """Every value of a list of lists x10 (whole vectors, cut into rows of 8), row sums."""
    e = read_table(spark, sf, "embeddings")
    v = F.col("embedding").cast("array<double>")
    starts = F.filter(F.sequence(F.lit(0), F.size(v)), lambda i: (i % 8 == 0) & (i < F.size(v)))
    nested = F.transform(starts, lambda i: F.slice(v, i + 1, F.lit(8)))
    scaled = e.select("vec_id", F.posexplode(vf.nested_scale(nested, 10.0)).alias("row", "r"))
    total = F.aggregate("r", F.lit(0.0), lambda a, x: a + x)
    return scaled.select("vec_id", F.col("row").cast("long").alias("row"), r6(total).alias("total"))


POWERLAW = """,
f AS (SELECT track_id, count(*) AS x FROM playlists GROUP BY track_id),
coc AS (SELECT x, count(*) AS m FROM f GROUP BY x),
cand AS (SELECT x AS xmin FROM coc WHERE x < (SELECT max(x) FROM coc)),
tail AS (SELECT cand.xmin, coc.x, coc.m FROM cand JOIN coc ON coc.x >= cand.xmin),
fit AS (SELECT xmin, sum(m) AS n, 1 + sum(m) / sum(m * ln(x / (xmin - 0.5))) AS alpha FROM tail GROUP BY xmin),
cdf AS (SELECT t.xmin, sum(t.m) OVER (PARTITION BY t.xmin ORDER BY t.x) / fit.n AS emp,
               1 - pow((t.x + 0.5) / (t.xmin - 0.5), 1 - fit.alpha) AS fitc
        FROM tail t JOIN fit ON t.xmin = fit.xmin),
ks AS (SELECT xmin, max(abs(emp - fitc)) AS ks FROM cdf GROUP BY xmin),
res AS (SELECT fit.xmin, fit.n AS n_tail, fit.alpha, ks.ks FROM fit JOIN ks ON fit.xmin = ks.xmin)"""


@plan("powerlaw_fit", with_(PLAYLISTS) + POWERLAW + """
SELECT xmin, n_tail, round(alpha, 6) AS alpha, round(ks, 6) AS ks,
       xmin = (SELECT arg_min(xmin, (ks, xmin)) FROM res) AS is_best FROM res""")
def q_powerlaw_fit(spark, sf):
    """Discrete power-law fit of track frequencies: alpha and KS distance for every xmin."""
    from quiver.operators.powerlaw import powerlaw_fit

    f = _playlists(spark, sf).groupBy("track_id").agg(F.count(F.lit(1)).alias("x"))
    p = powerlaw_fit(f, "x")
    return p.select("xmin", "n_tail", r6("alpha").alias("alpha"), r6("ks").alias("ks"), "is_best")


@plan("powerlaw_best", with_(PLAYLISTS) + POWERLAW + """
SELECT xmin, n_tail, round(alpha, 6) AS alpha, round(ks, 6) AS ks FROM res ORDER BY res.ks, xmin LIMIT 1""")
def q_powerlaw_best(spark, sf):
    """The best power-law fit of track frequencies, found by bounds on the KS distance."""
    from quiver.operators.powerlaw import best_powerlaw

    f = _playlists(spark, sf).groupBy("track_id").agg(F.count(F.lit(1)).alias("x"))
    return best_powerlaw(f, "x").select("xmin", "n_tail", r6("alpha").alias("alpha"), r6("ks").alias("ks"))
