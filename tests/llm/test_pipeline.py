import corpus_pipeline
import __spark_entry__ as entry_module
from stratafold.llm.decontamination import leaks
from stratafold.llm.quality_classifier import classify
from stratafold.llm.secret_scan import scan_secrets
from stratafold.llm.simhash_dedup import near_duplicates

SF = "/root/testdata/sf0.001"


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_take_effect(spark, tmp_path):
    """Each stage's rows against the decisions of its operator on the stage's own input."""
    benchmark, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or sorted(docs.dtypes) == sorted(first.dtypes)
    assert ids(inputs["near_duplicates"]) == ids(classify(first, labels).where("keep"))
    assert ids(inputs["decontamination"]) == ids(near_duplicates(inputs["near_duplicates"]).where("doc_id = component_id"))
    dirty = {r["doc_id"] for r in leaks(inputs["decontamination"], benchmark).collect()}
    assert ids(inputs["secrets"]) == [i for i in ids(inputs["decontamination"]) if i not in dirty]
    assert ids(inputs["packing"]) == ids(inputs["secrets"])
    assert scan_secrets(inputs["packing"]).where("spans <> ''").count() == 0
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(ids(inputs["packing"]))


def test_run_and_registry(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    names = set(entry_module.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(entry_module.oracle_sql()) <= names
