import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratafold.llm.decontamination import LeakRule, _item_rows, drop_contaminated, fit, leaks, plain_lowered, read_item
from stratafold.llm.license_scan import TEMPLATES, LicenseRule, documents_as_files, own_licenses, scan_licenses
from stratafold.llm.words import lowered

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[a-z0-9\x80-￿]+", (text or "").lower())


def brute_licenses(files, rule=LicenseRule()):
    """(id, license, cosine, origin, dir) by comparing every line with every template."""
    df = Counter(w for _, _, t in files for w in set(words(t)))
    known = {w for _, t in rule.templates for w in words(t)}
    n = len(files)
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 0.1 if w in known else math.log(1 + n) + 0.1

    def cosine(a, b):
        a, b = Counter(a), Counter(b)
        norm = lambda c: math.sqrt(sum(k * idf(w) ** 2 for w, k in c.items()))
        return sum(math.sqrt(a[w] * b[w]) * idf(w) ** 2 for w in a if w in b) / (norm(a) * norm(b))

    own, stands = {}, {}
    for i, (_, path, text) in enumerate(files):
        best = None
        lines = [words(x) for x in (text or "").lower().split("\n")]
        lines = [x for x in lines if x]
        for line in [*lines, *([words(text)] if len(lines) > 1 else [])]:
            for name, template in rule.templates:
                c = cosine(line, words(template))
                if c >= rule.cosine - 1e-9 and (best is None or c > best[1] + 1e-9):
                    best = (name, c, len(line) / len(words(text)))
        own[i] = best
        path = path and path.strip("/")
        if best and path is not None and (best[2] >= rule.file_share or re.search(r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z0-9]+)?$", path)):
            folder = path.rpartition("/")[0]
            stands[folder] = min(stands.get(folder, (0, "~")), (-round(best[1], 9), best[0]))
    out = []
    for i, (key, path, _) in enumerate(files):
        folder, found = path and path.strip("/").rpartition("/")[0], None
        while path is not None and not own[i]:
            if folder in stands:
                found = (stands[folder][1], None, "inherited", folder)
                break
            if not folder:
                break
            folder = folder.rpartition("/")[0]
        out.append((key, *((own[i][0], round(own[i][1], 6), "own", None) if own[i] else found or (None, None, "none", None))))
    return sorted(out, key=repr)


def scanned(files):
    rows = scan_licenses(files).collect()
    return sorted(((r["file_id"], r["license"], r["cosine"] and round(r["cosine"], 6), r["origin"], r["license_dir"]) for r in rows), key=repr)


def test_licenses_of_the_whole_table(spark):
    files = documents_as_files(spark.read.parquet(f"{SF}/documents.parquet"))
    assert scanned(files) == brute_licenses([(r["file_id"], r["path"], r["text"]) for r in files.collect()])


def test_licenses_of_a_tree(spark):
    mit, apache, gpl = TEMPLATES[0][1], TEMPLATES[3][1], TEMPLATES[4][1]
    rows = [
        (1, "/LICENSE", "All of it.\n" + mit + "\n" + "word " * 100),
        (2, "a/b/COPYING.txt", apache),
        (3, "a/b/c/main.c", "int main"),
        (4, "a/other.c", None),
        (5, "a/b/c/d/e.c", f"// {gpl}\nint x"),
        (6, "a/b/c/d/f.c", ""),
        (7, None, "nothing"),
        (8, "a/b/tie.txt", gpl),
        (8, "a/b/tie.txt", gpl),
        (9, "zz/deep/er/x", "plain words here"),
        (None, "top.c", "x " * 50_000),
    ]
    files = spark.createDataFrame([(*r, 1, "q") for r in rows], "file_id long, path string, text string, cosine int, license string")
    assert scanned(files) == brute_licenses(rows)
    assert scanned(files.limit(0)) == []


def brute_share(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1] / len(a)


def found(docs, items):
    return {(r["doc_id"], r["item_id"]) for r in leaks(docs, items).collect()}


def test_leaks_of_the_whole_table(spark):
    """Every item whose words stand in order, near each other, is found, and nothing else."""
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = set()
    texts = [(r["item_id"], words(r["text"])) for r in items.collect()]
    for r in docs.collect():
        own = words(r["text"])
        for i, item in texts:
            size = len(item)
            steps = range(0, max(1, len(own) - size), max(1, size // 4))
            if len(set(own) & set(item)) >= 0.6 * len(set(item)) and any(brute_share(item, own[s : s + 2 * size]) >= 0.8 for s in steps):
                expected.add((r["doc_id"], i))
    assert found(docs, items) == expected and expected


def test_paraphrases_and_hard_rows(spark, docs_of):
    pick = random.Random(6)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randrange(3, 8)))
    body = [word() for _ in range(30)]
    item = " ".join(body) + ". Answer is forty two."
    edited = body[:]
    for i in range(0, 30, 3):
        edited[i] = word()
    noise = " ".join(word() for _ in range(500))
    texts = [
        (1, f"{noise} {item} {noise}"),
        (2, f"{noise} {' '.join(edited)}. Answer is FORTY two. {noise}"),
        (3, f"{noise} {' '.join(edited)}. Other it was. {noise}"),
        (4, noise),
        (5, None),
        (6, " \n"),
        (None, item),
        (7, f"{noise} " * 200 + item),
        (8, item),
        (8, item),
        (9, " ".join(sorted(body))),
    ]
    texts += [(100 + i, " ".join(word() for _ in range(60))) for i in range(80)]
    docs = docs_of(texts)
    items = spark.createDataFrame([(1, item, "k"), (1, item, "k"), (2, None, "k"), (3, "...", "k"), (None, noise, "k")], "item_id long, text string, key string")
    expected = {(1, 1), (2, 1), (None, 1), (7, 1), (8, 1)}
    assert found(docs, items) == expected
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 6, 9, *range(100, 180)]
    assert found(docs, items.limit(0)) == set() and found(docs.limit(0), items) == set()


def test_a_short_item_in_a_third_of_all_documents(spark, docs_of):
    pick = random.Random(8)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randrange(3, 8)))
    item = " ".join(word() for _ in range(12)) + "."
    noise = lambda: " ".join(word() for _ in range(40))
    docs = docs_of([f"{noise()} {item if i % 3 == 0 else noise()} {noise()}" for i in range(150)])
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert found(docs, items) == {(i, 5) for i in range(0, 150, 3)}


@pytest.mark.parametrize("block", [16, 256])
def test_latent_space_keeps_the_items(spark, block):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [read_item(r["item_id"], r["text"].lower().encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:block]
    rule = LeakRule(rank=4)
    index = fit(docs, items, rule)
    assert ((index.latent**2).sum(axis=1) >= rule.energy - 1e-6).all()
    rows = _item_rows(items, index.lookup, index.idf)
    dense = rows.pivot(index="item", columns="word", values="weight").fillna(0).to_numpy()
    # cosines between items in the latent space are those of the whole matrix, up to the lost energy
    assert abs(index.latent @ index.latent.T - dense @ dense.T).max() <= 0.06
    assert docs.select(F.col("doc_id")).count() > 0


def test_ascii_files_are_lowered_without_patterns(spark):
    """Both passes over the files; texts beyond ASCII take the patterns and match as before."""
    texts = ["Released under the MIT License.", "Released under the MIT。License．", "Réserved for others", "猫\nReleased under the MIT License.", None, ""]
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate(texts)], "file_id long, path string, text string")
    for frame in (own_licenses(files, LicenseRule()), files.select(plain_lowered(F.col("text")))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "octet_length" in plan, "the patterns run over ASCII texts too"
    both = files.select(plain_lowered(F.col("text")).alias("plain"), lowered(F.col("text")).alias("all")).collect()
    assert all(r["plain"] == r["all"] for r in both)
    assert {r["file_id"]: r["license"] for r in own_licenses(files, LicenseRule()).collect()} == {0: "MIT", 1: "MIT", 2: None, 3: "MIT", 4: None, 5: None}
