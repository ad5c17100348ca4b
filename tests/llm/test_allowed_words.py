import random
import string

from stratafold.llm.secret_scan import redact_secrets, scan_secrets

KEY = "9fKq2LzX7vBn4TsWp0RyHc8MdJ1eUoG5AaQ"


def spans(docs):
    return {r["doc_id"]: r["spans"] for r in scan_secrets(docs).collect()}


def test_an_allowed_word_suppresses_only_itself(docs_of):
    pick = random.Random(3)
    blob = lambda n: "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(n))
    long = "/".join([blob(30), blob(40), f"{blob(5)}xxxx{blob(5)}", blob(40)])
    texts = [f"/samples/upload/{KEY}", f"your-{KEY}", f"key={KEY}/example", long, f"example{KEY}", "123e4567-e89b-12d3-a456-426614174000"]
    found = spans(docs_of(texts))
    for i, t in enumerate(texts[:3]):
        (span,) = found[i].split(",")
        kind, begin, end = span.split(":")
        assert kind == "entropy_mixed" and int(begin) <= t.index(KEY) and int(end) >= t.index(KEY) + len(KEY)
        assert "sample" not in t[int(begin) : int(end)] and "example" not in t[int(begin) : int(end)]
    parts = [s.split(":") for s in found[3].split(",")]
    assert len(parts) == 2 and not any(int(b) <= long.index("xxxx") < int(e) for _, b, e in parts)
    assert found[4] == "" and found[5] == ""


def test_the_key_is_masked(docs_of):
    (row,) = redact_secrets(docs_of([f"see /samples/upload/{KEY} there"])).collect()
    assert KEY not in row["text"] and row["text"].startswith("see /samples") and row["text"].endswith("[SECRET] there")
