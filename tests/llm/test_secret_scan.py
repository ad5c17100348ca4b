import hashlib
import math
import random
import re
from collections import Counter

from stratafold.llm.secret_scan import ALLOWED, KINDS, EntropyRule, redact_secrets, scan_secrets

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def brute(text, rule=EntropyRule()):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    more = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        s = m[0]
        if len(s) < rule.window or not re.search("[0-9]", s) or any(re.search(a, s) for a in ALLOWED):
            continue
        kind, bits = (3, rule.hex_bits) if re.fullmatch("[0-9a-fA-F]+", s) else (4, rule.mixed_bits)
        hot = [i for i in range(len(s) - rule.window + 1) if entropy(s[i : i + rule.window]) >= bits - 1e-9]
        for i in hot:
            a, b = m.start() + i, m.start() + i + rule.window
            if more and more[-1][1] == kind and more[-1][0] >= m.start() and more[-1][2] >= a:
                more[-1] = (more[-1][0], kind, b)
            else:
                more.append((a, kind, b))
    text_of = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return (*counts, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(base + more))


def found(docs):
    return {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in scan_secrets(docs).collect()}


def test_whole_table_against_brute_force(sample):
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    assert found(sample) == {i: brute(t) for i, t in texts.items()}


def test_crafted_texts(docs_of):
    pick = random.Random(7)
    mixed = "".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(300))
    texts = [
        None,
        "",
        "token=secret:longvalue123 and password: short",
        "é𝄞 API_key = 'abcdefgh.=-' passwd:\"x\" PASSWORD==abcdefgh",
        "AKIAABCDEFGHIJKL AKIAAKIA AKIA" + "Z9" * 40,
        "x" * 50 + "deadbeef" * 4 + "g" + "0" * 31 + " " + "a1" * 100,
        mixed + " " + "1" * 200 + mixed,
        "123e4567-e89b-12d3-a456-426614174000 EXAMPLE" + mixed[:40],
        "ſecret=abcdefghij toKen=abcdefghij",
        "token=" + "a" * 100_000 + "1",
        "token=abcdefgh " * 300,
    ]
    assert found(docs_of(texts)) == {i: brute(t) for i, t in enumerate(texts)}


def test_empty_table_null_ids_and_repeats(docs_of):
    assert found(docs_of(["x"]).limit(0)) == {}
    rows = scan_secrets(docs_of([(None, "token=abcdefgh"), (1, "a"), (1, "a")])).collect()
    assert sorted((r["doc_id"] is None, r["n_assign"]) for r in rows) == [(False, 0), (False, 0), (True, 1)]


def test_redaction(docs_of):
    docs = docs_of(["a token=abcdefgh b " + "0123456789abcdef" * 2, None, "clean", "token=" + "0a" * 20])
    rows = {r["doc_id"]: r for r in redact_secrets(docs).collect()}
    assert rows[0]["text"] == "a [SECRET] b [SECRET]" and rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[1]["text"] is None and rows[2]["text"] == "clean" and rows[3]["text"] == "[SECRET]"
    assert redact_secrets(docs).columns == docs.columns


def test_no_python_in_the_plan(sample):
    plan = scan_secrets(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def masked(text):
    out, at = "", 0
    for start, end in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in brute(text)[4].split(",") if s)):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def full_of_matches(seed, n):
    """Words beyond ASCII, and secrets of every kind, some within others."""
    pick = random.Random(seed)
    key = lambda letters, k: "".join(pick.choice(letters) for _ in range(k))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
    kinds = [
        lambda: "token=" + key(mixed, pick.randrange(4, 60)),
        lambda: "AKIA" + key("ABCDEFGH01234567", pick.randrange(10, 30)),
        lambda: key("0123456789abcdef", pick.randrange(30, 50)),
        lambda: key(mixed, pick.randrange(20, 90)),
        lambda: "é𝄞\n" * pick.randrange(1, 40),
    ]
    return " ".join(pick.choice(kinds)() for _ in range(n))


def test_texts_full_of_matches(docs_of):
    pick = random.Random(3)
    stripes = "".join(pick.choice("abcdefgh01234567XYZ+/_-JKLMN") if i // 40 % 2 else "a1"[i % 2] for i in range(9_000))
    texts = [full_of_matches(seed, n) for seed, n in ((1, 1), (2, 63), (3, 64), (4, 65), (5, 4_000))] + [stripes, "Q" * 63 + stripes[:2_000]]
    assert found(docs_of(texts)) == {i: brute(t) for i, t in enumerate(texts)}
    rows = {r["doc_id"]: r["text"] for r in redact_secrets(docs_of(texts)).collect()}
    assert rows == {i: masked(t) for i, t in enumerate(texts)}


def test_names_of_other_columns(spark):
    names = ["__spans", "spans", "secret_spans", "found", "at"]
    docs = spark.createDataFrame([(1, "token=abcdefgh", *names)], ["doc_id", "text", *names])
    row = redact_secrets(docs).first()
    assert row["text"] == "[SECRET]" and [row[n] for n in names] == names
    assert scan_secrets(docs).first()["n_assign"] == 1


def test_the_longest_window_a_count_holds(docs_of):
    texts = ["a1" * 40 + "".join(f"{i}bC/" for i in range(60)), "z0" + "z" * 200]
    for size in (8, 31, 32, 40):
        rule = EntropyRule(window=size, mixed_bits=2.5, allowed=())
        rows = {r["doc_id"]: r["spans"] for r in scan_secrets(docs_of(texts), rule).collect()}
        assert rows == {i: brute(t, rule)[4] for i, t in enumerate(texts)}
