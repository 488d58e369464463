"""Name plans: similar names of the documents' titles."""

from __future__ import annotations

from quiver.operators import names
from quiver.plans.registry import plan
from quiver.sources.tables import titles

TITLES = r"""
titles AS (
  SELECT trim(regexp_replace(regexp_replace(lower(regexp_extract(text, '^[^.\n]*')), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS name
  FROM documents),
names AS (SELECT name, count(*) AS n_rows FROM titles WHERE name <> '' GROUP BY name)"""


@plan("similar_names", "WITH " + TITLES.strip() + """,
links AS (
  SELECT a.name, b.name AS other, levenshtein(a.name, b.name) AS distance
  FROM names a JOIN names b ON a.name <> b.name AND abs(length(a.name) - length(b.name)) <= 2
  WHERE levenshtein(a.name, b.name) <= 2),
best AS (SELECT name, count(*) AS n_links, min({'d': distance, 'o': other}) AS m FROM links GROUP BY name)
SELECT n.name, n.n_rows, coalesce(b.n_links, 0) AS n_links, m.o AS nearest, m.d::INT AS distance
FROM names n LEFT JOIN best b ON b.name = n.name""")
def q_similar_names(spark, sf):
    """Every title with the number of titles at most two edits away, and the nearest."""
    return names.similar_names(names.clean_names(titles(spark, sf), "title"), max_edits=2)
