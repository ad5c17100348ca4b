import random

import pytest
import xxhash
from pyspark.sql import functions as F

from stratafold.llm.components import components
from stratafold.llm.shared import Stages
from stratafold.llm.simhash_dedup import SimHashRule, _cross_links, _star_links, _labelled, fingerprint, keep_one_of_each, near_duplicates


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(prints):
    """prints: list of (id, fingerprint); the least id reachable of each."""
    parent = {f: f for _, f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    known = list(parent)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return sorted(((i, f"{f:016x}", least.get(root(f))) for i, f in prints), key=repr)


def found(docs):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(docs).collect()), key=repr)


def test_whole_table_against_brute_force(sample):
    prints = [(r["doc_id"], brute_print(r["text"])) for r in sample.collect()]
    assert found(sample) == brute_components(prints)


def test_crafted_texts(docs_of):
    pick = random.Random(3)
    words = [f"w{pick.randrange(300)}" for _ in range(400)]
    near = [" ".join(words[:i] + ["edit"] + words[i + 1 :]) for i in range(0, 400, 8)]
    texts = [(10, " \t\n"), (3, None), (7, ""), (None, "A b"), (4, "a  B"), (4, "a  B"), (9, "one two THREE\x0bfour fivé"), (None, "lone")]
    texts += [(100 + i, t) for i, t in enumerate(near)] + [(99, " ".join(words)), (98, " ".join(words * 3000))]
    assert found(docs_of(texts)) == brute_components([(i, brute_print(t)) for i, t in texts])


def test_blocks_give_the_same_print():
    import stratafold.llm.simhash_dedup as module

    text = (" ".join(f"w{i % 977}" for i in range(5000))).encode()
    whole, module.BLOCK = fingerprint(text, 4), 64
    try:
        assert fingerprint(text, 4) == whole == brute_print(text.decode())
    finally:
        module.BLOCK = 1 << 20


@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_no_pair(spark, seed):
    """Dense clusters and strangers: every pair within 4 bits ends in one component."""
    pick = random.Random(seed)
    values = {pick.getrandbits(64) for _ in range(100)}
    for centre in list(values)[:6]:
        for _ in range(60):
            value = centre
            for b in pick.sample(range(64), pick.choice([1, 2, 3, 4, 5, 8])):
                value ^= 1 << b
            values.add(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fp long")
    stages, rule = Stages(spark), SimHashRule()
    stars = stages.write(_labelled(distinct, _star_links(distinct, rule, stages), stages), "stars")
    joined = components(_cross_links(stars, rule, stages), stages).select(F.col("node").alias("comp"), "root")
    labels = {r["fp"] % (1 << 64): r["label"] for r in stars.join(joined, "comp", "left").select("fp", F.coalesce("root", "comp").alias("label")).collect()}
    expected = brute_components([(v, v) for v in values])
    groups = {i: c for i, _, c in expected}
    for a in values:
        for b in values:
            assert (labels[a] == labels[b]) == (groups[a] == groups[b])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, n) for n in range(1001, 1300)] + [(5, 5), (1000, 1001)]
    pick = random.Random(0)
    pick.shuffle(path)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a long, b long"), Stages(spark)).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert components(spark.createDataFrame([], "a long, b long"), Stages(spark)).count() == 0


def test_one_of_each_stays(docs_of):
    docs = docs_of([(5, "a b c d"), (3, "A b c d"), (3, "A b c d"), (9, "other words stand here"), (None, "a b c d")])
    kept = keep_one_of_each(docs)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 9]
    assert kept.columns == docs.columns
    assert near_duplicates(docs.limit(0)).count() == 0
