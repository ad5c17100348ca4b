import hashlib
import zlib

import duckdb
import pytest

from stratafold.llm.merkle_manifest import manifest, sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, row string, part string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each leaf its siblings left and right, level by level."""
    steps, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, under = [], []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for j in range(len(run)):
                for i in below[k + j]:
                    steps[i].append((run[:j], run[j + 1 :]))
            above.append(digest(*run))
            under.append(sum(below[k : k + 3], []))
        nodes, below = above, under
    return nodes[0], steps


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [tree([leaf(r, r["text"]) for r in groups[s]]) for s in names]
    root, tops = tree([t[0] for t in trees]) if trees else ("", [])
    found = []
    for name, (subroot, below), top in zip(names, trees, tops):
        for row, own in zip(groups[name], below):
            text, steps = row["text"], own + top
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for left, right in steps:
                node = digest(*left, node, *right)
            proof = digest(*(d for left, right in steps for d in left + right))
            found.append((row["doc_id"], leaf(row, row["text"]), subroot, root, proof, node, node == root))
    return found


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def frame(spark, rows):
    wide = [(*r, "x", "y", "z", "p") for r in rows]
    return spark.createDataFrame(wide, DOCS)


def check(docs):
    got = manifest(docs).select(*COLUMNS).collect()
    assert ordered(got) == ordered(brute([r.asDict() for r in docs.collect()]))
    return got


def test_given_documents_as_brute_force_and_as_sql(sample):
    got = check(sample)
    assert {r["verified"] for r in got} == {True, False}
    assert len({r["root"] for r in got}) == 1
    con = duckdb.connect()
    con.register("documents", sample.toPandas())
    assert ordered(con.execute(sql()).fetchall()) == ordered(got)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1), (28, 1, 3, 9, 2), (1, 250)])
def test_trees_of_any_size(spark, sizes):
    rows = [(i, f"line\n{i}", "en", f"s{g}", i) for g, size in enumerate(sizes) for i in range(g * 1000, g * 1000 + size)]
    check(frame(spark, rows))


def test_nulls_repeats_long_texts_and_names_of_sources(spark):
    rows = [
        (None, None, None, None, None), (None, "a\nb", "en", None, 3), (1, "", "en", "", 0), (1, "", "en", "", 0),
        (1, "same id\n", "en", "", 8), (-5, "\n\n", "en", "é", 2), (7, "x\n" * 300_000, "en", "a", 600_000),
        (8, "only lines" * 3, None, "-", 30), (9, None, "fr", "=", None), (10, "z", "de", "￿", 1), (11, "z", "de", "𝒳", 1),
    ]
    check(frame(spark, rows * 2))


def test_no_documents(spark):
    assert manifest(frame(spark, [])).select(*COLUMNS).collect() == []


def test_proof_holds_the_siblings_and_nothing_else(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(5)]
    got = {r["doc_id"]: r["proof"] for r in manifest(frame(spark, rows)).collect()}
    assert [(len(s["l"]) // 32, len(s["r"]) // 32) for s in got[1]] == [(1, 1), (0, 1)]
    assert [(len(s["l"]) // 32, len(s["r"]) // 32) for s in got[4]] == [(1, 0), (1, 0)]
