"""The upsert: against a plain model, and its rules one by one."""

import random

import pytest
from pyspark.errors import PySparkException

from stratafold.operators.merge import LATEST, MergeRule, merge, same_name

RULE = MergeRule(
    keys=("k", "d"), when="t.h <> s.h", update=same_name(["v", "h"]), insert=same_name(["k", "d", "v", "h", "fixed"])
)
SCHEMA = "k string, d int, v int, h string, fixed string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def model(target, source):
    """The same upsert over dicts; NULL keys never match."""
    out = []
    sources = {(s[0], s[1]): s for s in source if s[0] is not None and s[1] is not None}
    known = set()
    for t in target:
        s = sources.get((t[0], t[1])) if t[0] is not None and t[1] is not None else None
        if s is None:
            out.append((*t, "keep"))
            continue
        known.add((t[0], t[1]))
        if t[3] is not None and s[3] is not None and t[3] != s[3]:
            out.append((t[0], t[1], s[2], s[3], t[4], "update"))
        else:
            out.append((*t, "noop"))
    out += [(*s, "insert") for s in source if s[0] is None or s[1] is None or (s[0], s[1]) not in known]
    return sorted(out, key=repr)


def random_side(rng, tag, with_null_keys):
    keys = {(f"k{rng.randrange(30)}", rng.randrange(4)) for _ in range(60)}
    rows = [(k, d, rng.randrange(100), rng.choice(["a", "b", "c", None]), tag) for k, d in sorted(keys)]
    if with_null_keys:
        rows += [(None, 1, 5, "a", tag), ("k1", None, 6, "b", tag), (None, None, 7, None, tag)]
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small", [False, True])
def test_against_model(spark, seed, small):
    rng = random.Random(seed)
    target, source = random_side(rng, "t", True), random_side(rng, "s", True)
    merged = merge(frame(spark, target), frame(spark, source), RULE, null_keys=True, broadcast_source=small)
    assert result(merged) == model(target, source)


def test_idempotent_and_unique(spark):
    rng = random.Random(9)
    hashed = [(k, d, v, h or "a", f) for k, d, v, h, f in random_side(rng, "t", False)]
    source = [(k, d, v, h or "b", f) for k, d, v, h, f in random_side(rng, "s", False)]
    once = merge(frame(spark, hashed), frame(spark, source), RULE).drop("action").collect()
    assert len({(r["k"], r["d"]) for r in once}) == len(once)
    again = merge(spark.createDataFrame(once, SCHEMA), frame(spark, source), RULE)
    assert {r["action"] for r in again.collect()} <= {"keep", "noop"}


def test_value_returns(spark):
    state = frame(spark, [("k", 1, 1, "a", "t")])
    for h in ("b", "a"):
        state = merge(state, frame(spark, [("k", 1, ord(h), h, "s")]), RULE).drop("action")
    assert result(state) == [("k", 1, ord("a"), "a", "t")]


def test_duplicate_source_keys(spark):
    source = frame(spark, [("k", 1, 1, "a", "s"), ("k", 1, 2, "b", "s"), ("l", 1, 3, "c", "s")])
    with pytest.raises(PySparkException, match="more than one source row"):
        merge(frame(spark, []), source, RULE).collect()
    latest = MergeRule(RULE.keys, RULE.update, RULE.insert, RULE.when, LATEST, ("v",))
    assert result(merge(frame(spark, []), source, latest)) == [("k", 1, 2, "b", "s", "insert"), ("l", 1, 3, "c", "s", "insert")]


def test_unconditional_and_partial_rules(spark):
    target = frame(spark, [("k", 1, 1, None, "t")])
    source = frame(spark, [("k", 1, 2, "b", "s"), ("n", 1, 3, "c", "s")])
    always = MergeRule(RULE.keys, {"v": "s.v + t.v"}, {"k": "s.k", "d": "s.d"})
    assert result(merge(target, source, always)) == [("k", 1, 3, None, "t", "update"), ("n", 1, None, None, None, "insert")]
    no_insert = MergeRule(RULE.keys, {"v": "s.v"}, None)
    for small in (False, True):
        assert result(merge(target, source, no_insert, broadcast_source=small)) == [("k", 1, 2, None, "t", "update")]


def test_many_copies_of_one_key(spark):
    """A key with most of the rows: the newest wins, nothing is lost."""
    from pyspark.sql import functions as F

    hot = spark.range(200_000).select(
        F.lit("hot").alias("k"), F.lit(1).alias("d"), F.col("id").cast("int").alias("v"), F.lit("z").alias("h"), F.lit("s").alias("fixed")
    )
    cold = spark.range(1000).select(
        F.concat(F.lit("c"), "id").alias("k"), F.lit(1).alias("d"), F.col("id").cast("int").alias("v"), F.lit("y").alias("h"), F.lit("s").alias("fixed")
    )
    latest = MergeRule(RULE.keys, RULE.update, RULE.insert, RULE.when, LATEST, ("v",))
    out = merge(frame(spark, [("hot", 1, -1, "a", "t")]), hot.unionByName(cold), latest)
    assert out.count() == 1001
    assert result(out.where("k = 'hot'")) == [("hot", 1, 199_999, "z", "t", "update")]
