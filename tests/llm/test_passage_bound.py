"""What spares decontamination work must not change what it finds."""

import numpy as np
from pyspark.sql import functions as F

from stratafold.llm.decontamination import LeakRule, Index, Lookup, _item_rows, _passages, cut_items, plain_lowered, read_item
from stratafold.llm.words import lowered, word_hashes


def test_passages_are_those_of_all_products():
    """Against the cosine of every passage with every item, computed one by one."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: " ".join(rng.choice(vocabulary[:150], n))
    texts = [draw(n) for n in (6, 14, 30, 90)]
    rule = LeakRule()
    items = [read_item(i, t.encode()) for i, t in enumerate(texts)]
    known = np.unique(np.concatenate([i.words for i in items]))
    lookup, idf = Lookup(known, rule.tables), rng.uniform(0.1, 6.0, len(known))
    parts, owner = cut_items(items, rule)
    entries = _item_rows(parts, lookup, idf)
    matrix = np.zeros((len(parts), len(known)))
    matrix[entries["item"].to_numpy(int), entries["word"].to_numpy(int)] = entries["weight"]
    basis, _ = np.linalg.qr(matrix.T)
    index = Index(items, owner, lookup, idf, 6.5, basis, matrix @ basis)
    shares = idf[:, None] * (basis @ (matrix @ basis).T)
    for text in (draw(300), texts[2], " ".join([*rng.choice(vocabulary[150:], 40), texts[3], *rng.choice(vocabulary, 80)]), "w1"):
        words = word_hashes(text.encode())[0]
        rows = lookup.rows(words)
        wanted = set()
        for span in rule.spans:
            for at in range(0, max(1, len(words) - span + rule.step), rule.step):
                here = rows[at : at + span]
                if at + span > len(words) and at:
                    continue
                norm = np.sqrt(np.where(here >= 0, idf[here] ** 2, index.unknown**2).sum())
                cosines = shares[here[here >= 0]].sum(axis=0) / norm
                wanted |= {(at, at + span, int(owner[p])) for p in np.flatnonzero(cosines >= rule.cosine + 1e-4)}
        found = {(a, b, n) for a, b, n, _ in _passages(words, index, rule)}
        assert wanted <= found and (len(words) < 2 or wanted)


def test_bytes_of_plain_texts(spark):
    texts = ["", None, "Plain TEXT, no more.", "ÀB c", "İI", "K elvin", "日本語。Tokyo", "a b", "x\x00Y\x7f", "A" * 100_000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    same = rows.select((plain_lowered(F.col("text")) == lowered(F.col("text"))).alias("same")).collect()
    assert len(same) == len(texts) and all(r["same"] for r in same)
