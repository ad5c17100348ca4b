"""Benchmark decontamination: latent semantic retrieval, then word order and answers.

Benchmark items are the queries, all passages of all documents the candidates.
Weights are sqrt(tf) * idf with document frequencies over the whole corpus. A
distributed randomised SVD of the items' rows gives the latent space in which
passages are compared; its rank grows until every item keeps most of its norm.
Only words of the items have a weight there, and all other words of a passage count
in its norm, so most passages are ruled out by a bound before any projection.
Items are worked on in blocks of bounded size, each a pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages, column, small_batches
from stratafold.llm.words import lowered, word_hashes

# Products of so many words with all items are held at once.
WORDS_AT_ONCE = 8192


@dataclass(frozen=True)
class LeakRule:
    """Passages are of each length in ``spans`` at steps of ``step`` words: long ones for paraphrases,
    and short ones because a leak that has become common in the corpus has little weight beside
    any other word, but always holds a short passage without one. An item is found when its words stand in order to ``sure`` of their number, or to ``likely`` with its answer.
    The answer is the item's last sentence. ``energy`` is the least share of an item's squared
    norm in the latent space. Items of more than ``part`` words are rows of overlapping parts, so that
    a passage of a long copy need not resemble the whole item."""

    spans: tuple[int, ...] = (32, 8)
    step: int = 4
    cosine: float = 0.3
    sure: float = 0.8
    likely: float = 0.6
    answer: float = 0.9
    energy: float = 0.95
    rank: int = 64
    oversample: int = 8
    block: int = 256
    part: int = 64
    tables: int = 1 << 18


@dataclass(frozen=True)
class Item:
    item_id: int
    words: np.ndarray
    answer: np.ndarray


def read_item(item_id: int, data: bytes) -> Item:
    """Words of an item, given in lower case, and of its last sentence."""
    words, starts, _ = word_hashes(data)
    body = data.rstrip(b" \t\r\n.!?")
    cut = max(body.rfind(c) for c in (b". ", b"? ", b"! ", b".\n", b"?\n", b"!\n", b"\n"))
    return Item(item_id, words, words[starts > cut])


def cut_items(items: list[Item], rule: LeakRule) -> tuple[list[Item], np.ndarray]:
    """Parts of ``part`` words at half their length, and the number of each part's item."""
    parts, owner = [], []
    for number, item in enumerate(items):
        last = max(0, len(item.words) - rule.part)
        for at in sorted({*range(0, last, rule.part // 2), last}):
            parts.append(Item(item.item_id, item.words[at : at + rule.part], item.answer))
            owner.append(number)
    return parts, np.array(owner, np.int64)


class Lookup:
    """Row numbers of known word hashes, -1 for others, through one probe of a table."""

    def __init__(self, known: np.ndarray, size: int):
        self.known = np.sort(known)
        self.size = max(size, 1 << (4 * max(len(known), 1)).bit_length())
        slot = (self.known & np.uint64(self.size - 1)).astype(np.int64)
        self.first = np.full(self.size, -1, np.int32)
        self.first[slot] = np.arange(len(self.known))
        # words whose slot another one has taken are looked up by search
        self.crowded = np.zeros(self.size, bool)
        counts = np.bincount(slot, minlength=self.size)
        self.crowded[counts > 1] = True

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), -1, np.int32)
        slot = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        rows = self.first[slot]
        wrong = (rows >= 0) & (self.known[rows] != hashes)
        rows[wrong] = -1
        hard = np.flatnonzero(self.crowded[slot])
        if len(hard):
            at = np.minimum(np.searchsorted(self.known, hashes[hard]), len(self.known) - 1)
            rows[hard] = np.where(self.known[at] == hashes[hard], at, -1)
        return rows


def plain_lowered(text: Column) -> Column:
    """What ``lowered`` gives; texts of ASCII alone hold nothing that it sets apart."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole).cast("binary")).otherwise(lowered(whole))


def word_rows(docs: DataFrame) -> DataFrame:
    """doc_id and the hashes of all words of each text, in their order, eight bytes a word."""
    small_batches(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([word_hashes(t)[0].tobytes() for t in column(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), words], ["doc_id", "words"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_lowered(F.col("text")).alias("text"))
    return texts.mapInArrow(split, "doc_id long, words binary")


def document_frequencies(docs: DataFrame, known: np.ndarray, rule: LeakRule) -> tuple[np.ndarray, int]:
    """In how many documents each known word stands, over all documents, and their number."""
    small_batches(docs.sparkSession)
    texts = docs.select(plain_lowered(F.col("text")).alias("text"))
    return _frequencies(texts, lambda text: word_hashes(text)[0], known, rule)


def hashed_frequencies(words: DataFrame, known: np.ndarray, rule: LeakRule) -> tuple[np.ndarray, int]:
    """The same from ``word_rows``."""
    return _frequencies(words.select("words"), lambda data: np.frombuffer(data, np.uint64), known, rule)


def _frequencies(frame: DataFrame, read: Callable[[bytes], np.ndarray], known: np.ndarray, rule: LeakRule) -> tuple[np.ndarray, int]:
    spark = frame.sparkSession
    name = frame.columns[0]
    lookup = spark.sparkContext.broadcast(Lookup(known, rule.tables))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = lookup.value, 0
        counts = np.zeros(len(own.known), np.int64)
        for batch in batches:
            for data in column(batch, name):
                rows = own.rows(read(data))
                counts[np.unique(rows[rows >= 0])] += 1
                total += 1
        some = np.flatnonzero(counts)
        numbers = np.append(counts[some], total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int64()), pa.array(numbers, pa.int64())], ["word", "n"])

    rows = frame.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(len(known), np.int64), 0
    for r in rows:  # one per word of the items' block
        if r["word"] < 0:
            total = r["n"]
        else:
            out[r["word"]] = r["n"]
    return out, total


def _item_rows(items: list[Item], lookup: Lookup, idf: np.ndarray) -> pd.DataFrame:
    """The TF-IDF matrix of the items, one row per entry; rows have norm one."""
    parts = []
    for number, item in enumerate(items):
        rows, tf = np.unique(lookup.rows(item.words), return_counts=True)
        weights = np.sqrt(tf) * idf[rows]
        norm = np.sqrt((weights**2).sum())
        if norm > 0:
            parts.append(pd.DataFrame({"item": number, "word": rows, "weight": weights / norm}))
    return pd.concat(parts) if parts else pd.DataFrame({"item": [], "word": [], "weight": []})


def randomised_svd(entries: DataFrame, words: int, rank: int, seed: int = 11) -> np.ndarray:
    """A basis (words x rank) of the leading right singular space of a sparse matrix.

    ``entries`` has (item, word, weight). Each partition multiplies its rows with the
    same random matrix (A Omega), the small Gram matrix of the results makes them
    orthonormal, and the partitions' shares of Q^T A are summed by word.
    """
    spark = entries.sparkSession
    names = [f"c{i}" for i in range(rank)]
    whole = entries.repartition("item")

    def sketch(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        omega = np.random.default_rng(seed).standard_normal((words, rank))
        labels, rows = np.unique(part["item"].to_numpy(), return_inverse=True)
        out = np.zeros((len(labels), rank))
        np.add.at(out, rows, part["weight"].to_numpy()[:, None] * omega[part["word"].to_numpy(np.int64)])
        return labels, rows, out

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            y = sketch(pd.concat(parts))[2]
            square = pd.DataFrame(y.T @ y, columns=names)
            yield square.assign(row=range(rank))

    schema = ", ".join(f"{n} double" for n in names)
    squares = whole.mapInPandas(gram, f"{schema}, row int").groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    total = squares.toPandas().sort_values("row")[names].to_numpy()  # rank x rank
    values, vectors = np.linalg.eigh(total)
    good = values > values.max() * 1e-10
    turn = spark.sparkContext.broadcast(vectors[:, good] / np.sqrt(values[good]))
    width = int(good.sum())

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            part = pd.concat(parts)
            _, rows, y = sketch(part)
            shares = part["weight"].to_numpy()[:, None] * (y @ turn.value)[rows]
            yield pd.DataFrame(shares, columns=names[:width]).assign(word=part["word"].to_numpy()).groupby("word", as_index=False).sum()

    cut = ", ".join(f"{n} double" for n in names[:width])
    summed = whole.mapInPandas(project, f"{cut}, word long").groupBy("word").agg(*[F.sum(n).alias(n) for n in names[:width]])
    found = summed.toPandas()  # words of one block of items x rank
    b = np.zeros((words, width))
    b[found["word"].to_numpy(np.int64)] = found[names[:width]].to_numpy()
    basis, _ = np.linalg.qr(b)
    return basis


@dataclass(frozen=True)
class Index:
    """What a task needs to search its documents for a block of items."""

    items: list[Item]
    owner: np.ndarray
    lookup: Lookup
    idf: np.ndarray
    unknown: float
    basis: np.ndarray
    latent: np.ndarray

    @cached_property
    def shares(self) -> np.ndarray:
        """What one occurrence of each word adds to the product with each item's part, through the latent space."""
        return (self.idf[:, None] * self.basis @ self.latent.T).astype(np.float32)

    @cached_property
    def most(self) -> np.ndarray:
        """The largest of a word's shares, 0 if it adds to no product; a little more, against rounding."""
        return self.shares.max(axis=1, initial=0.0).astype(float) * (1 + 1e-5)


def fit(docs: DataFrame, items: list[Item], rule: LeakRule, words: DataFrame | None = None) -> Index:
    """``words``: the documents' ``word_rows``, if they have been written."""
    spark = docs.sparkSession
    known = np.unique(np.concatenate([i.words for i in items])) if items else np.empty(0, np.uint64)
    lookup = Lookup(known, rule.tables)
    seen, total = hashed_frequencies(word_rows(docs) if words is None else words, known, rule)
    idf = np.log((1 + total) / (1 + seen)) + 0.1
    unknown = math.log(1 + total) + 0.1
    parts, owner = cut_items(items, rule)
    rows = _item_rows(parts, lookup, idf)
    matrix = np.zeros((len(parts), len(known)), np.float32)
    matrix[rows["item"].to_numpy(int), rows["word"].to_numpy(int)] = rows["weight"]
    entries = spark.createDataFrame(rows.astype({"item": "int64", "word": "int64", "weight": "float64"}), "item long, word long, weight double")
    rank = rule.rank
    while True:
        width = min(rank + rule.oversample, len(parts), len(known))
        basis = randomised_svd(entries, len(known), width).astype(np.float32)
        latent = matrix @ basis
        kept = (latent**2).sum(axis=1)
        if width == min(len(parts), len(known)) or kept[matrix.any(axis=1)].min(initial=1) >= rule.energy:
            return Index(items, owner, lookup, idf, unknown, basis, latent)
        rank *= 2


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit for each word of ``a``."""
    masks: dict[int, int] = {}
    for i, word in enumerate(a):
        masks[word] = masks.get(word, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for word in b:
        match = row & masks.get(word, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def _passages(words: np.ndarray, index: Index, rule: LeakRule) -> Iterator[tuple[int, int, int, float]]:
    """(first word, end, item number, cosine with one of its parts) of the passages that reach the cosine, in blocks of words.

    A word that a passage repeats counts each time.
    """
    rows = index.lookup.rows(words)
    inside = rows >= 0
    square = np.where(inside, index.idf[np.where(inside, rows, 0)] ** 2, 0.0)
    whole = np.where(inside, square, index.unknown**2)
    bound = np.where(inside, index.most[np.where(inside, rows, 0)], 0.0)
    cells = np.arange(0, len(words), rule.step)
    sums = [np.concatenate([[0.0], np.cumsum(np.add.reduceat(v, cells))]) for v in (square, whole, bound)]
    block, margin = WORDS_AT_ONCE // rule.step, max(rule.spans) // rule.step
    for low in range(0, len(cells), block):
        high = min(len(cells), low + block)
        chosen = []
        for span in rule.spans:
            per = span // rule.step
            first = np.arange(low, min(high, max(1, len(cells) - per + 1)))
            last = np.minimum(first + per, len(cells))
            inner, total, most = (s[last] - s[first] for s in sums)
            # by Cauchy and Schwarz no cosine exceeds the share of the norm that lies in known words,
            # and no product with one item the sum of every word's largest share
            good = (inner >= rule.cosine**2 * total) & (most + 1e-6 >= rule.cosine * np.sqrt(total))
            chosen.append((span, first[good], last[good], total[good]))
        if not any(len(first) for _, first, _, _ in chosen):
            continue
        end = min(len(cells), high + margin)
        wanted = np.zeros(end - low + 1, np.int32)
        for _, first, last, _ in chosen:
            np.add.at(wanted, first - low, 1)
            np.add.at(wanted, last - low, -1)
        needed = np.cumsum(wanted[:-1]) > 0
        at = np.arange(low * rule.step, min(len(words), end * rule.step))
        cell = at // rule.step - low
        used = inside[at] & needed[cell]
        at, cell = at[used], cell[used]
        heads = np.flatnonzero(np.diff(cell, prepend=-1))
        # running sums of the cells' products with every item, so a passage is a difference of two
        products = np.zeros((len(needed) + 1, len(index.owner)))
        if len(heads):
            products[cell[heads] + 1] = np.add.reduceat(index.shares[rows[at]], heads, axis=0)
        np.cumsum(products, axis=0, out=products)
        for span, first, last, total in chosen:
            cosines = (products[last - low] - products[first - low]) / np.sqrt(total)[:, None]
            for place, number in zip(*np.nonzero(cosines >= rule.cosine)):
                start = int(cells[first[place]])
                yield start, start + span, int(index.owner[number]), float(cosines[place, number])


def find_leaks(data: bytes, index: Index, rule: LeakRule) -> list[tuple[int, float, float, float]]:
    """(item_id, cosine, share of the item in order, share of the answer) of items found in a lower-cased text."""
    return find_in_words(word_hashes(data)[0], index, rule)


def find_in_words(words: np.ndarray, index: Index, rule: LeakRule) -> list[tuple[int, float, float, float]]:
    """The same for a text's word hashes."""
    if not len(words):
        return []
    candidates: dict[int, list[tuple[int, int, float]]] = {}
    for at, end, number, cosine in _passages(words, index, rule):
        candidates.setdefault(number, []).append((at, end, cosine))
    found = []
    for number, places in candidates.items():
        item = index.items[number]
        size = len(item.words)
        best = (0.0, 0.0, 0.0)
        done = -1
        for at, end, _ in sorted(places):
            if at < done:
                continue
            low, high = max(0, at - size), end + size + size // 2
            here = words[low:high].tolist()
            present = set(here)
            # no subsequence is longer than the words of the item that are there at all
            share = answer = 0.0
            if sum(w in present for w in item.words.tolist()) >= rule.likely * size:
                share = common_subsequence(item.words.tolist(), here) / size
            if share >= rule.likely:
                answer = common_subsequence(item.answer.tolist(), here) / max(1, len(item.answer))
                best = max(best, (share, answer, max(c for a, _, c in places if low <= a < high)))
            # the words up to there have been looked at with a whole item around them
            done = at + max(rule.step, size // 2) if share < rule.likely else end
        share, answer, cosine = best
        if share >= rule.sure or share >= rule.likely and answer >= rule.answer:
            found.append((item.item_id, cosine, share, answer))
    return sorted(found)


def _blocks(benchmark: DataFrame, rule: LeakRule, stages: Stages) -> Iterator[list[Item]]:
    """The items with any word, in blocks; each block alone comes to the driver."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), lowered(F.col("text")).alias("text")).distinct()
    rows = stages.write(rows, "items")
    # long items weigh as many as the parts they are cut into, some six bytes a word
    weight = F.greatest(F.lit(1.0), F.octet_length("text") / F.lit(3.0 * rule.part))
    count = max(-(-rows.count() // rule.block), math.ceil((rows.agg(F.sum(weight).alias("n")).first()["n"] or 0) / (4 * rule.block)))
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, count))))
    for block in range(count):
        items = [read_item(r["item_id"], r["text"]) for r in numbered.where(F.col("block") == block).collect()]
        items = [i for i in items if len(i.words)]
        if items:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame, rule: LeakRule | None = None) -> DataFrame:
    """doc_id, item_id, cosine, in_order and answer of every item found in a document.

    Empty and null texts hold nothing; items without a word or an id are not looked
    for, and an empty benchmark finds nothing. Repeated documents are each searched;
    a repeated item counts once, items of equal text are all reported. Rows of
    documents without an id are reported with a null. Texts are split once, into a
    written table of word hashes that every block of items reads.
    """
    rule = rule or LeakRule()
    spark = docs.sparkSession
    stages = Stages(spark)
    schema = "doc_id long, item_id long, cosine double, in_order double, answer double"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = ["doc_id", "item_id", "cosine", "in_order", "answer"]
    out = spark.createDataFrame([], schema)
    small_batches(spark)
    words = None
    for items in _blocks(benchmark, rule, stages):
        words = stages.write(word_rows(docs), "words") if words is None else words
        index = spark.sparkContext.broadcast(fit(docs, items, rule, words))

        def searched(batches: Iterator[pa.RecordBatch], index: Broadcast = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [np.frombuffer(w, np.uint64) for w in column(batch, "words")]
                rows = [(d, *hit) for d, t in zip(column(batch, "doc_id"), texts) for hit in find_in_words(t, index.value, rule)]
                arrays = zip(*rows) if rows else ([] for _ in names)
                yield pa.RecordBatch.from_arrays([pa.array(list(a), k) for a, k in zip(arrays, kinds)], names)

        out = out.unionByName(words.mapInArrow(searched, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rule: LeakRule | None = None) -> DataFrame:
    """The documents in which no benchmark item is found; texts are searched where they lie."""
    rule = rule or LeakRule()
    spark = docs.sparkSession
    stages = Stages(spark)
    small_batches(spark)
    kept = docs
    for items in _blocks(benchmark, rule, stages):
        index = spark.sparkContext.broadcast(fit(docs, items, rule))

        @F.pandas_udf("boolean")
        def clean(texts: pd.Series) -> pd.Series:
            return pd.Series([not find_leaks(t, index.value, rule) for t in texts], dtype=bool)

        kept = kept.where(clean(plain_lowered(F.col("text"))))
    return kept
