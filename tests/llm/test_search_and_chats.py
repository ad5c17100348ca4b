import math
import random

import duckdb
import pytest

from stratafold.llm import chat_format, exact_topk
from stratafold.llm.chat_format import ChatRule, format_chats
from stratafold.llm.exact_topk import SearchRule, top_k

SF = "/root/testdata/sf0.001"


def brute_top(rows, k=5):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = sorted({(i, tuple(v)) for i, v in usable if i % 50 == 0})
    out = []
    for i, q in queries:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def searched(frame, rule=None):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(frame, rule).collect())


SMALL = SearchRule(pivots=4, queries=2, candidates=16, sample=20)


def test_search_of_the_whole_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    expected = brute_top([(r["vec_id"], r["embedding"]) for r in frame.collect()])
    assert searched(frame) == expected == searched(frame, SMALL)


def test_search_of_hard_vectors(spark):
    pick = random.Random(1)
    nan, inf = float("nan"), float("inf")
    rows = [(50 * i, [pick.uniform(-2, 2) for _ in range(6)]) for i in range(4)]
    rows += [(i, [float(pick.randrange(-2, 3)) for _ in range(6)]) for i in range(1, 49)]
    rows += [(7, rows[9][1]), (60, [1.0, 2.0]), (61, []), (62, None), (63, [1.0, None]), (64, [nan] * 6), (65, [inf] + [0.0] * 5), (None, [9.0] * 6)]
    rows += [(200, [3.0e5] * 6), (201, [-3.0e5] * 6), rows[0], (100, [0.0] * 6)]
    frame = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, block int")
    expected = brute_top(rows)
    assert searched(frame, SMALL) == expected == searched(frame)
    huge = spark.createDataFrame([(0, [1.0e17, 1.0]), (1, [1.0e17, 0.0]), (2, [-1.0e17, 0.0])], "vec_id long, embedding array<double>")
    assert [r[2] for r in searched(huge)] == [1, 2]
    assert searched(frame.limit(0)) == [] and searched(frame.where("vec_id = 3")) == []


def test_search_sql(spark):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
        assert sorted(db.execute(exact_topk.SQL).fetchall()) == searched(spark.read.parquet(f"{SF}/embeddings.parquet"))


def brute_chats(rows):
    own = {}
    for c, t, role, text in set((c, t, r or "", x or "") for c, t, r, x in rows if c is not None and t is not None):
        own.setdefault(c, []).append((t, role, text))
    chats = {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in own.items()}
    out = []
    for c, turns in chats.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in chats.values()):
            continue
        same = sorted(d for d, o in chats.items() if o == turns)
        if same[0] == c:
            out.append((c, len(turns), len(same) - 1, "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)))
    return sorted(out)


def formatted(frame, rule=None):
    parts = {}
    for r in sorted(format_chats(frame, rule).collect(), key=lambda r: (r["conv_id"], r["part"])):
        parts.setdefault((r["conv_id"], r["n_turns"], r["n_collapsed"]), []).append(r["chat"])
    return sorted((*k, "".join(v)) for k, v in parts.items())


def test_chats_of_the_whole_table_and_sql(spark):
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    expected = brute_chats([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in frame.collect()])
    assert formatted(frame) == expected
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
        rows = db.execute(chat_format.SQL).fetchall()
    assert sorted((c, n, k, chat) for c, _, n, k, chat in rows) == expected


@pytest.mark.parametrize("rule", [ChatRule(), ChatRule(block=3, part=2)])
def test_snapshots_collapse(spark, rule):
    pick = random.Random(2)
    turns = [("user" if i % 2 == 0 else "assistant", pick.choice(["hi", "yes", "no"])) for i in range(20)]
    rows = []
    for conv in range(30):
        length = pick.randrange(1, 20)
        odd = pick.randrange(0, 25)
        for i in range(length):
            role, text = turns[i]
            rows.append((conv, i * 2 - 5, role, text if i != odd else "other"))
    rows += [(40, 0, None, None), (41, 0, "", ""), (41, 1, "user", None), (None, 0, "user", "x"), (42, None, "user", "x")]
    rows += [(43, 5, "user", "a"), (43, 5, "user", "a"), (43, 5, "user", "b"), rows[0]]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, position string")
    assert formatted(frame, rule) == brute_chats(rows)
    assert formatted(frame.limit(0), rule) == []
