"""Records cut in byte ranges: JSON objects and CSV against Python's parsers, at range borders."""

import csv
import io
import json
import random

import pytest

from quiver.sources import files, ranges


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of ``n`` bytes for the test."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _object(seed, n):
    rng = random.Random(seed)
    odd = ['plain', 'with "quotes"', "brace } inside", "{ open", "back\\slash", 'end\\', "line\nend", "é日本", "", "], ["]
    return {f"key{i} {rng.choice(odd)}": {"bboxes": [[rng.random() for _ in range(4)] for _ in range(rng.randint(0, 3))],
                                         "labels": [rng.choice(odd) for _ in range(rng.randint(0, 3))],
                                         "leading_hand": rng.choice(odd), "user_id": rng.choice(odd) * rng.randint(1, 20)}
            for i in range(n)}


@pytest.mark.parametrize("size, indent", [(37, None), (200, None), (1000, 2), (10_000_000, None)])
def test_one_json_object_per_file(spark, small_ranges, tmp_path, size, indent):
    small_ranges(size)
    data = {"call": _object(1, 40), "rock": _object(2, 25), "none": {}}
    for name, value in data.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=indent, ensure_ascii=False) + "\n")
    got = files.read_annotation_json(spark, str(tmp_path), whole_file=True).collect()
    want = {(k + ".jpg", t): v for t, d in data.items() for k, v in d.items()}
    assert len(got) == len(want)
    for r in got:
        v = want[(r.name, r.target)]
        assert (r.labels, r.leading_hand, r.user_id) == (v["labels"], v["leading_hand"], v["user_id"])
        assert r.bboxes == v["bboxes"]


def _csv(seed, n):
    rng = random.Random(seed)
    odd = ["a", "", "x,y", 'say "hi"', "two\nlines", '"', ",\n,", "tail\n", "é\n\nü", 'in"side']
    return [[str(i), rng.choice(odd), rng.choice(odd) * rng.randint(1, 9)] for i in range(n)]


@pytest.mark.parametrize("size", [11, 64, 500, 10_000_000])
def test_quoted_line_ends_across_ranges(spark, small_ranges, tmp_path, size):
    small_ranges(size)
    rows = {}
    for k in range(2):
        rows[k] = _csv(k, 60)
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
        w.writerow(["id", "b", "c"])
        w.writerows(rows[k])
        (tmp_path / f"f{k}.csv").write_text(out.getvalue())
    (tmp_path / "f2.csv").write_text('id,b,c\n900,too,many,fields\n901,few\n\n902,"a ""b""\n c",d')
    got = files.read_csv_tolerant(spark, str(tmp_path), multi_line=True).collect()
    want = [tuple(v or None for v in r) for k in rows for r in rows[k]] + [("901", "few", None), ("902", 'a "b"\n c', "d")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_a_file_is_read_by_several_tasks(spark, small_ranges, tmp_path):
    small_ranges(500)
    (tmp_path / "call.json").write_text(json.dumps(_object(5, 60)))
    effects = ranges.range_effects(ranges._fragments(spark, str(tmp_path), ranges.JsonEntries()), ranges.JsonEntries())
    assert effects.rdd.getNumPartitions() > 5 and effects.count() > 5
    starts = ranges.range_starts(effects)
    assert starts[0][2:] == (False, 0) and any(inside for _, _, inside, _ in starts[1:])


def test_empty_folder_content(spark, tmp_path):
    (tmp_path / "none.json").write_text("{}")
    assert files.read_annotation_json(spark, str(tmp_path), whole_file=True).collect() == []
    (tmp_path / "none.json").write_text("")
    assert files.read_annotation_json(spark, str(tmp_path), whole_file=True).collect() == []
