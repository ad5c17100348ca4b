import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratafold.llm.source_mixing import MixRule, mix, mixed_sizes, permuted, shard_counts, slot_texts, targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, row string, size string, block string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "a", "b", "c", "d", "e") for i, t, s in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def check(docs, rule=None):
    """Sizes, targets and words taken against a plain recount of the mix's pieces."""
    rule = rule or MixRule()
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, targets([sizes[s] for s in names], rule.weights, rule.most)))
    got = mixed_sizes(docs, rule).collect()
    want = Counter((r["doc_id"], len(words(r["text"])), sizes[r["source"]]) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in got) == want
    taken = Counter()
    source_of = {(r["doc_id"], len(words(r["text"]))): r["source"] for r in rows}
    for r in got:
        source = source_of[r["doc_id"], r["size"]]
        assert r["target"] == pytest.approx(goal[source])
        assert 0 <= r["taken"] <= rule.most * r["size"]
        taken[source] += r["taken"]
    for source in names:
        assert taken[source] == round(goal[source])
    return got


def test_given_documents(sample):
    got = check(sample)
    assert sorted(got) == sorted(mixed_sizes(sample).collect())


def test_targets_stop_at_the_limit_and_reshare():
    assert targets([100, 100, 100], (1, 2, 3), 3) == pytest.approx([50, 100, 150])
    # the second and the third stop, the first takes what is left
    assert targets([100, 1, 1], (1, 2, 3), 3) == pytest.approx([96, 3, 3])
    assert targets([0, 0], (1, 2, 3), 3) == [0, 0]
    assert sum(targets([5, 70, 1, 33, 900, 2, 0], (1, 2, 3), 3)) == pytest.approx(1011)


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000])
def test_permutation_and_its_inverse(size):
    found = permuted(np.arange(size), size, (42, 1, 0))
    assert sorted(found.tolist()) == list(range(size))
    assert permuted(found, size, (42, 1, 0), back=True).tolist() == list(range(size))


def test_shards_share_the_slots_out():
    slots, sizes = np.array([700, 0, 41, 259]), [100] * 10
    drawn = [shard_counts(slots, sizes, k, (1,)) for k in range(10)]
    assert (sum(here for here, _ in drawn) == slots).all()
    assert all(here.sum() == 100 for here, _ in drawn)
    assert all((drawn[k + 1][1] == drawn[k][0] + drawn[k][1]).all() for k in range(9))
    assert len({tuple(here) for here, _ in drawn}) > 1


@pytest.mark.parametrize("stratum", [1 << 29, 40])
def test_small_blocks_long_texts_and_hot_sources(spark, stratum):
    rows = [(i, f"w{i} " * (i % 7), "hot") for i in range(300)] + [(900, "long " * 5000, "big"), (901, "x", "tiny")]
    check(frame(spark, rows), MixRule(block=16, shard=8, stratum=stratum))


def test_nulls_repeats_and_empty_sources(spark):
    rows = [(None, "a b c", None), (None, None, None), (1, "a\tb\x0bc d", "s"), (1, "a\tb\x0bc d", "s"), (2, "", "none"), (3, None, "none"), (4, "é ü", "-")]
    check(frame(spark, rows), MixRule(block=2))


def test_no_documents_and_no_words(spark):
    assert mixed_sizes(frame(spark, [])).collect() == []
    assert [r["taken"] for r in mixed_sizes(frame(spark, [(1, " ", "s"), (2, None, None)])).collect()] == [0, 0]


def test_slots_hold_one_block_each_without_gaps(spark):
    docs = frame(spark, [(i, " ".join(f"{i}:{k}" for k in range(5 + i)), f"s{i % 3}") for i in range(30)])
    rule = MixRule(block=8, shard=5)
    found = mix(docs, rule)
    slots = defaultdict(list)
    for p in found.pieces.collect():
        slots[p["shard"], p["slot"]].append(p)
    full = 0
    for pieces in slots.values():
        pieces.sort(key=lambda p: p["at"])
        assert len({(p["tree"], p["block"]) for p in pieces}) == 1
        ends = [p["at"] + p["words"] for p in pieces]
        assert [p["at"] for p in pieces] == [0, *ends[:-1]]
        full += ends[-1] == rule.block
    assert len(slots) - full <= 9
    texts = {(r["shard"], r["slot"]): r["text"].split() for r in slot_texts(docs, found.pieces).collect()}
    for key, pieces in slots.items():
        assert texts[key] == [f"{p['doc_id']}:{k}" for p in pieces for k in range(p["start"], p["start"] + p["words"])]
