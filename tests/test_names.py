"""Similar names: against all pairs, short names, a gram that every name holds, the plan."""

import random

from quiver.operators.names import clean_names, similar_names, similar_pairs


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _brute(names, d):
    names = sorted(set(names), key=lambda n: (len(n), n))
    return {(a, b, _edits(a, b)) for i, a in enumerate(names) for b in names[i + 1:] if _edits(a, b) <= d}


def _pairs(spark, names, **options):
    df = spark.createDataFrame([(n,) for n in sorted(set(names))], "name string").repartition(3)
    return {tuple(r) for r in similar_pairs(df, **options).collect()}


def _random_names(seed, letters, shortest, longest, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest)))
        out.append(w)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:]])
            out.append(w or "a")
    return out


def test_pairs_are_those_of_all_pairs(spark):
    names = _random_names(1, "ab ", 1, 9, 60) + _random_names(2, "abcdefgh ", 8, 30, 60)
    for d, q in ((1, 2), (2, 3), (2, 2), (3, 2)):
        assert _pairs(spark, names, max_edits=d, q=q) == _brute(names, d), (d, q)


def test_a_gram_in_every_name(spark):
    names = ["radio edit " + w for w in _random_names(3, "klmnop", 3, 12, 80)] + ["radio edit"]
    assert _pairs(spark, names) == _brute(names, 2)


def test_rows_of_names(spark):
    rows = [("Get Lucky - Radio Edit",), ("Get  lucky radio edit!",), ("get luckyy radio edit",), (None,), ("...",), ("é",), ("solo",)]
    names = clean_names(spark.createDataFrame(rows, "title string"), "title")
    got = {r.name: (r.n_rows, r.n_links, r.nearest, r.distance) for r in similar_names(names).collect()}
    assert got == {"get lucky radio edit": (2, 1, "get luckyy radio edit", 1),
                   "get luckyy radio edit": (1, 1, "get lucky radio edit", 1), "solo": (1, 0, None, None)}
    assert similar_names(names.where("name = 'zzz'")).collect() == []


def test_no_all_pairs_in_the_plan(spark):
    names = spark.createDataFrame([("abcdef",), ("abcdeg",)], "name string")
    plan = similar_pairs(names)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
