import corpus_pipeline as pipeline
import pytest

from pursefold.llm import lines, quality_rules
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage on what the one before has written."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name != "packing":
            assert docs.columns == names
        if name == "quality_rules":
            verdicts = {r.doc_id for r in quality_rules.verdicts(spark.read.parquet(f"{SF}/documents.parquet")).filter("kept").collect()}
            assert {r.doc_id for r in after} == verdicts and all(before[r.doc_id] == r for r in after)
        if name == "line_dedup":
            wanted = brute.kept_lines([(i, r.source, r.text) for i, r in before.items()], lines.MAX_RATIO, lines.MIN_PAGES)
            assert {(r.doc_id, r.text) for r in after} == {(i, t) for i, t, _ in wanted}
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "near_duplicates":
            wanted = {c for _, _, c in brute.simhash([(i, r.text) for i, r in before.items()])}
            assert sorted(r.doc_id for r in after) == sorted(wanted)
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            wanted = {x[0] for x in brute.decontamination([(i, r.text) for i, r in before.items()], items) if not x[-1]}
            assert {r.doc_id for r in after} == wanted
        if name == "packing":
            per = {}
            for r in after:
                per[r.doc_id] = per.get(r.doc_id, 0) + r.length
            assert per.keys() == before.keys() and all(per[r.doc_id] == r.doc_tokens for r in after)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows(spark, odd, k):
    name, stage = pipeline.STAGES[k]
    got = stage(spark, odd, SF)
    assert name == "packing" or got.columns == odd.columns
    got.count()
    assert stage(spark, odd.filter("false"), SF).count() == 0


def test_run(spark):
    assert pipeline.run(spark, SF).count() > 0
