"""The pipeline: columns, order, and each stage's decisions against plain versions."""

import corpus_pipeline
from quiver.llm.common import pin, read_table
from quiver.llm.decontaminate import contaminated
from quiver.llm.exact_dedup import SPACE
from quiver.llm.near_dedup import near_duplicates
from quiver.llm.quality import quality_scores

from tests.conftest import SF001


def test_stages_follow_the_operators(spark):
    docs = read_table(spark, SF001, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = pin(stage(spark, docs, SF001), "test-stage")
        assert docs.columns == columns
        rows = {r.doc_id: r.text for r in docs.collect()}
        was = {r.doc_id: r.text for r in before.collect()}
        assert rows.items() <= was.items()
        if name == "quality":
            good = {r.doc_id for r in quality_scores(before, read_table(spark, SF001, "labels")).where("predicted = 1").collect()}
            assert rows.keys() == good
        elif name == "exact_dedup":
            groups = {}
            for i, t in was.items():
                groups.setdefault(t.translate(str.maketrans("", "", SPACE)), []).append((-len(t), i))
            assert rows.keys() == {min(g)[1] for g in groups.values()}
        elif name == "near_dedup":
            found = near_duplicates(before, words=5, percent=80).collect()
            assert rows.keys() == {r.doc_id for r in found if r.doc_id == r.component_id}
        else:
            leaky = {r.doc_id for r in contaminated(before, read_table(spark, SF001, "benchmark")).collect()}
            assert leaky and rows.keys() == was.keys() - leaky
        kept[name] = len(rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {r.doc_id for r in pieces} == rows.keys()
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.length <= 1024
    assert all(total[r.doc_id] == r.doc_tokens for r in pieces)


def test_run_returns_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF001).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                         "sequence_id", "offset"]


def test_queries_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and {"op1_decontaminate", "op2_exact_dedup"} <= __spark_entry__.oracle_sql().keys()
