import random

from stratafold.llm.decontamination import leaks


def test_exact_copies_of_long_items(spark, docs_of):
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdefghijkl") for _ in range(pick.randrange(4, 9)))
    items = [" ".join(word() for _ in range(n)) + "." for n in (1000, 1000, 3000, 65, 20)]
    noise = lambda: " ".join(word() for _ in range(300))
    docs = docs_of([(i, f"{noise()} {t} {noise()}") for i, t in enumerate(items)] + [(50 + i, noise()) for i in range(40)])
    rows = leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["in_order"]) for r in rows} == {(i, i, 1.0) for i in range(5)}


def test_half_of_a_long_item_is_no_copy(spark, docs_of):
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefghijkl") for _ in range(pick.randrange(4, 9)))
    words = [word() for _ in range(800)]
    docs = docs_of([(1, " ".join(words[:400])), (2, " ".join(words))])
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    assert {r["doc_id"] for r in leaks(docs, items).collect()} == {2}
