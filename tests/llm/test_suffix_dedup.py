import hashlib
import random

import numpy as np
import pytest

from stratafold.llm.suffix_dedup import RepeatRule, repeated_strings, repeated_windows


def brute(texts, least=100):
    """texts: list of (id, bytes); rows with one id are one document."""
    first = {}
    for i, t in texts:
        for s in range(len(t) - least + 1):
            key = (-(1 << 63) if i is None else i, s)
            w = t[s : s + least]
            first[w] = min(first.get(w, key), key)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - least + 1):
            if (-(1 << 63) if i is None else i, s) > first[t[s : s + least]]:
                gone[s : s + least] = True
        runs = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs, rule=None):
    rows = repeated_strings(docs, rule).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=repr)


def test_whole_table_against_brute_force(sample):
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in sample.collect()]
    assert found(sample) == brute(texts)


def crafted():
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdé") for _ in range(pick.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), prose(17)
    long = prose(70_000)
    return [
        (3, None),
        (4, ""),
        (5, "a" * 1000),
        (2, "b" + "a" * 99),
        (7, "a" * 100 + "c"),
        (8, prose(5) + passage + prose(9)),
        (9, passage),
        (10, passage[1:101]),
        (11, prose(30) + passage[3:150] + prose(3) + passage[140:] + prose(1)),
        (None, passage[:180]),
        (6, prose(50)),
        (6, passage[50:] + "x"),
        (12, "\x00" * 150 + line),
        (13, "\x00" * 150 + line),
        (13, "\x00" * 150 + line),
        *[(20 + i, prose(8) + line[:99] + prose(8)) for i in range(30)],
        *[(60 + i, prose(8) + line[:101] + prose(8)) for i in range(10)],
        (80, long),
        (81, prose(100) + long[100_000:240_000] + prose(50)),
    ]


@pytest.mark.parametrize("rule", [RepeatRule(), RepeatRule(hot=2), RepeatRule(index_bytes=3000)])
def test_crafted_texts(docs_of, rule):
    texts = crafted()
    assert found(docs_of(texts), rule) == brute([(i, (t or "").encode()) for i, t in texts])


def test_empty_table(docs_of):
    assert found(docs_of(["x"]).limit(0)) == []


@pytest.mark.parametrize("seed", range(6))
def test_index_marks_the_same_windows_as_comparison(seed):
    pick = random.Random(seed)
    pieces = ["".join(pick.choice("ab") for _ in range(pick.randrange(1, 30))) for _ in range(6)]
    contexts = [("".join(pick.choice(pieces) for _ in range(pick.randrange(1, 9)))).encode() for _ in range(40)]
    contexts += contexts[:5] + [b"\x00" * 16, b"\x00" * 17, b"\x00" * 8]
    total = sum(map(len, contexts))
    keys = np.array(pick.sample(range(total), total))
    least = pick.choice([3, 8, 17])
    first, place = {}, 0
    spots = []
    for c in contexts:
        for s in range(len(c)):
            w = c[s : s + least] if s + least <= len(c) else None
            spots.append((w, keys[place]))
            if w is not None:
                first[w] = min(first.get(w, keys[place]), keys[place])
            place += 1
    expected = [w is not None and k > first[w] for w, k in spots]
    assert repeated_windows(contexts, keys, least).tolist() == expected
