"""The pipeline's stages on a small table, each judged on its own input."""
import __spark_entry__ as entry
import corpus_pipeline as cp
from bitext.llm.decontaminate import decontaminate
from bitext.llm.quality import score_quality
from bitext.llm.similarity_join import similar_components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF).cache()
        assert out.count() <= docs.count()
        if name == "tokens":
            assert out.columns[:5] == COLUMNS and out.count() == docs.count()
            break
        assert out.columns == COLUMNS and out.dtypes == docs.select(COLUMNS).dtypes
        before, after = ({r.doc_id: r for r in t.collect()} for t in (docs, out))
        if name == "quality":
            good = {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
                    if r.predicted}
            assert set(after) == good
        if name == "near_duplicates":
            assert set(after) == {r.component_id for r in similar_components(docs).collect()}
        if name == "repeated_passages":
            assert set(after) == set(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "decontamination":
            marked = decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            assert set(after) == {r.doc_id for r in marked if not r.contaminated}
        if name in ("quality", "near_duplicates", "decontamination"):
            assert all(after[i] == before[i] for i in after)
        docs = out


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(entry.oracle_sql()) <= set(names)
