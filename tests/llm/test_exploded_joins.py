import pytest

from stratafold.llm import license_scan, word_model
from stratafold.llm.quality_classifier import classify
from stratafold.llm.shared import Stages
from stratafold.llm.simhash_dedup import near_duplicates


def broadcast_explodes(plan):
    """Broadcasts of rows that are exploded and not summed up since."""
    found, below = [], False
    for line in plan.splitlines():
        node = line.lstrip(" :+-*()0123456789")
        if below and node.startswith("Generate"):
            found.append(node)
        below = node.startswith("BroadcastExchange") or below and node.startswith(("Project", "Filter", "Sort"))
    return found


def test_exploded_keys_are_never_broadcast(spark, sample, monkeypatch):
    """Spark takes a table's exploded keys to be no larger than the table."""
    plans, write = [], Stages.at

    def noted(self, df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, label)

    monkeypatch.setattr(Stages, "at", noted)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("bB")) == 10 << 20
    out = near_duplicates(sample)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("Generate explode" in p for p in plans)
    assert not [node for p in plans for node in broadcast_explodes(p)]
    # nor the fingerprints of all documents, whose copies take next to nothing on disk
    assert "SortMergeJoin [fp" in next(line for line in plans[-1].splitlines() if "Join " in line)


@pytest.mark.parametrize("most", [4 << 20, 0])
def test_ancestors_are_never_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(license_scan, "BROADCAST_BYTES", most, raising=False)
    mit = "Released under the MIT License."
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.py", "words"), (3, "d/y.py", "words"), (4, "a/b/LICENSE", "Licensed under CC BY 4.0."), (5, "a/z.py", None)]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and not broadcast_explodes(plan)
    found = {r["file_id"]: (r["license"], r["origin"], r["license_dir"]) for r in out.collect()}
    assert found == {
        1: ("MIT", "own", None),
        2: ("CC-BY-4.0", "inherited", "a/b"),
        3: (None, "none", None),
        4: ("CC-BY-4.0", "own", None),
        5: ("MIT", "inherited", "a"),
    }


def test_tables_of_the_model_are_never_broadcast(spark, docs_of, monkeypatch):
    """Their size grows with the trusted text, and on disk they take a fraction of it."""
    plans, write = {}, Stages.at

    def noted(self, df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, label)

    monkeypatch.setattr(Stages, "at", noted)
    model = word_model.fit(docs_of(["the cat sat on the mat. The cat sat", "a dog sat on the mat, a dog!"]), Stages(spark), 2)
    plans["entries"] = [model.entries._jdf.queryExecution().executedPlan().toString()]
    assert len(plans["chances"]) == 3 and not [p for label in ("chances", "entries") for p in plans[label] if "BroadcastHashJoin" in p]


def test_trusted_text_is_counted_in_parts_of_its_own_size(spark, docs_of, monkeypatch):
    monkeypatch.setattr(word_model, "PART_BYTES", 1 << 10)
    monkeypatch.setattr(word_model, "PARTS", 4)
    asked, trigrams = [], word_model.trigrams
    monkeypatch.setattr(word_model, "trigrams", lambda texts, parts, part: asked.append((parts, part)) or trigrams(texts, parts, part))
    docs = docs_of([f"some plain words stand here and there w{i % 7} " * 3 for i in range(80)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(16)], "doc_id long, quality int, toxic int")
    few = {r["doc_id"]: (r["keep"], r["perplexity"]) for r in classify(docs, labels).collect()}
    assert asked == [(1, 0), *((4, i) for i in range(4))]
    monkeypatch.setattr(word_model, "PARTS", 1)
    one = {r["doc_id"]: (r["keep"], r["perplexity"]) for r in classify(docs, labels).collect()}
    assert {i: k for i, (k, _) in few.items()} == {i: k for i, (k, _) in one.items()}
    assert [few[i][1] for i in range(80)] == pytest.approx([one[i][1] for i in range(80)])
