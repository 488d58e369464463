"""Edge rows: several files, missing lists, empty tables, repeated positions, retried batches."""

import os
import tempfile

from pyspark.sql import functions as F

from quiver.operators import boxes, metrics, profile, recs
from quiver.sources import files


def folder():
    return tempfile.mkdtemp(prefix="quiver-edge-")


def test_row_ids_over_files_of_unequal_size(spark):
    root = folder()
    at = 0
    for k, n in enumerate((5, 4000, 300)):
        spark.range(at, at + n).coalesce(1).write.parquet(f"{root}/{k}")
        at += n
    scan = spark.read.parquet(*[f"{root}/{k}" for k in (2, 0, 1)])
    got = files.row_ids(scan).collect()
    assert all(r.row_id == r.id for r in got) and len(got) == at


def test_csv_lines_equal_to_the_header_and_quoted_line_ends(spark):
    root = folder()
    with open(os.path.join(root, "a.csv"), "w") as f:
        f.write('x,y\n1,2\nx,y\n3\n4,5,6\n\n"7,7",8\n"9\n9",10\n')
    rows = [tuple(r) for r in files.read_csv_tolerant(spark, root, multi_line=True).collect()]
    assert sorted(rows, key=str) == sorted([("1", "2"), ("x", "y"), ("3", None), ("7,7", "8"), ("9\n9", "10")], key=str)
    data_only = files.read_csv_tolerant(spark, root, header_line="x,y", multi_line=True).collect()
    assert [tuple(r) for r in data_only].count(("x", "y")) == 2


def test_missing_lists_are_misses(spark):
    df = spark.createDataFrame([(["a", "b"], "a"), (None, "a"), (["c"], None)], "p array<string>, t string")
    r = metrics.hit_rate(df, "p", "t").collect()[0]
    assert (round(r.hit_rate, 6), r.n) == (round(1 / 3, 6), 3)
    m = metrics.recall_ndcg(df, "p", "t", 2).collect()[0]
    assert round(m.recall_at_2, 6) == round(1 / 3, 6) and round(m.ndcg_at_2, 6) == round(1 / 3, 6)


def test_empty_tables_still_report(spark):
    empty = spark.createDataFrame([], "k string, v double, items array<string>, target string")
    checks = profile.contract_checks(empty, "m", "k").collect()
    assert sorted((r.test, r.failures, r.passed) for r in checks) == [("not_null", 0, True), ("unique", 0, True)]
    bins = profile.histogram(empty, "v", 4).collect()
    assert sorted((r.bin, r.lo, r.hi, r.n) for r in bins) == [(k, k / 4, (k + 1) / 4, 0) for k in range(4)]
    kv = recs.kv_records(empty, "k", 3).collect()
    assert [r.userId for r in kv] == ["no_user"]


def test_one_box_per_image_where_positions_repeat(spark):
    images = spark.createDataFrame([("i", "i.jpg", "left")], "image_key string, name string, leading_hand string")
    rows = [("i", 1, 0.1, 0.1, 0.1, 0.1, "call"), ("i", 1, 0.2, 0.1, 0.1, 0.1, "like"), ("i", 1, 0.2, 0.1, 0.1, 0.1, "call")]
    b = spark.createDataFrame(rows, "image_key string, box_pos int, x double, y double, w double, h double, label string")
    got = boxes.choose_box(images, b).collect()
    assert [(r.choice, r.gesture, r.x) for r in got] == [("gesture", "like", 0.2)]


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    from quiver.streaming.score_stream import stream_score

    src, sink = folder(), folder() + "/out"
    spark.range(5).write.mode("overwrite").parquet(f"{src}/a")
    schema = "id long"
    for _ in range(2):  # a second query without the first one's progress runs batch 0 again
        stream_score(spark, f"{src}/a", schema, lambda d: d, sink, folder())
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(5))


def test_queries_import_without_jars_or_files(monkeypatch):
    """queries() and oracle_sql() read no file: they work in a fresh interpreter, from another
    folder, with pyspark's jars out of sight."""
    import subprocess
    import sys

    code = ("import sys, os, glob, zipfile; sys.path.insert(0, sys.argv[1])\n"
            "zipfile.ZipFile = None; glob.glob = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, root], cwd="/", capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, m = map(int, out.stdout.split())
    assert n > 100 and m > 80


def test_workers_import_the_package(spark):
    def uses_package(batches):
        import pandas as pd

        from quiver.functions.text import english_stop_words

        for _ in batches:
            yield pd.DataFrame({"n": [len(english_stop_words())]})

    assert sum(r.n for r in spark.range(3).mapInPandas(uses_package, "n long").collect()) > 0
    assert any("quiver" in f for f in spark.sparkContext.listFiles)
