"""Exact removal of repeated byte strings with a run-length compressed BWT.

A string of ``least`` bytes that also starts earlier in the corpus is marked, and all
marked bytes go. Equal strings are brought together by anchors: the least hash of a
32-byte gram in every window of ``least`` bytes, so equal windows share an anchor at
the same place. Around an anchor lies its context, all windows that hold it. Where a
whole context occurs earlier nothing more has to be looked at. Contexts that share
their anchor only in part are indexed: the run-compressed Burrows-Wheeler transform
of the contexts of a batch of anchors, with suffix samples at the run ends. The
longest common prefix with the suffix before is computed at run ends alone; between
them it falls by one with each position, so that matching statistics stream over the
text. Stretches of at least ``least`` in suffix order are equal windows, of which all
but the earliest are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratafold.llm.shared import Stages, column, small_batches

BLOCK = 1 << 17
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class RepeatRule:
    """``hot``: anchors with more contexts are compared window by window through the shuffle.
    ``index_bytes``: contexts of several anchors are indexed together up to this size,
    which keeps the arrays of an index within a core's cache."""

    least: int = 100
    gram: int = 32
    hot: int = 20_000
    index_bytes: int = 1 << 16

    @property
    def reach(self) -> int:
        """How far before its anchor a window may start."""
        return self.least - self.gram


class _Hash:
    """Hashes of any substrings of a block from running sums of a polynomial."""

    def __init__(self, multiplier: int, size: int):
        inverse = pow(multiplier, -1, 1 << 64)
        self.powers, self.inverses = (self._series(b, size + 1) for b in (multiplier, inverse))

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        out = np.full(size, np.uint64(base), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        return _mixed((sums[ends] - sums[starts]) * self.inverses[starts])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_HASHES: list[_Hash] = []


def _hashes() -> list[_Hash]:
    """The two hash families of a worker, made at first use."""
    if not _HASHES:
        size = 2 * BLOCK + 4096
        _HASHES.extend(_Hash(m, size) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
    return _HASHES


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return best(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def anchors(data: np.ndarray, ends: np.ndarray, rule: RepeatRule) -> np.ndarray:
    """Starts of the grams that are least in some window of one of the texts in ``data``.

    ``ends`` has for each position where its text ends. Ties are all anchors.
    """
    first = _hashes()[0]
    size = len(data)
    if size < rule.least:
        return np.empty(0, np.int64)
    grams = first.of(first.sums(data), slice(0, size - rule.gram + 1), slice(rule.gram, size + 1))
    short = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    width = rule.reach + 1
    least = _sliding(short, width, np.minimum)
    starts = np.arange(len(least))
    least[ends[: len(least)] - starts < rule.least] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    return np.flatnonzero(_sliding(padded, width, np.maximum)[: len(short)] == short)


@dataclass(frozen=True)
class _Found:
    """Anchors of a group of texts in order of (document, place): hashes, place, context."""

    anchor: np.ndarray
    context: np.ndarray
    text: np.ndarray
    place: np.ndarray
    left: np.ndarray
    length: np.ndarray


def _find(texts: list[np.ndarray], rule: RepeatRule) -> _Found:
    data = np.concatenate(texts)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = anchors(data, ends[owner], rule)
    text = owner[at]
    begins, stops = np.maximum((ends - sizes)[text], at - rule.reach), np.minimum(ends[text], at + rule.least)
    first, second = _hashes()
    grams = first.of(first.sums(data), at, at + rule.gram)
    shape = ((at - begins) << 16 | (stops - begins)).astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    contexts = _mixed(second.of(second.sums(data), begins, stops) ^ shape)
    return _Found(grams, contexts, text, at - (ends - sizes)[text], at - begins, stops - begins)


def _groups(texts: list[bytes], rule: RepeatRule) -> Iterator[tuple[int, int, _Found]]:
    """Anchors of texts, a block's worth at a time: (first text, offset there, what was found).

    Texts longer than a block are cut into blocks that overlap by a context, so each
    window lies whole in one of them.
    """
    group: list[np.ndarray] = []
    start = size = 0
    for number, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        if size + len(data) > BLOCK and group:
            yield start, 0, _find(group, rule)
            group, size = [], 0
        if not group:
            start = number
        if len(data) <= BLOCK:
            group.append(data)
            size += len(data)
            continue
        margin = 2 * rule.least
        for at in range(0, len(data), BLOCK):
            begin, end = max(0, at - margin), min(len(data), at + BLOCK + margin)
            found = _find([data[begin:end]], rule)
            # contexts cut by the block are whole in its neighbour, where the text goes on
            place = found.place + begin
            whole = (place - found.left > begin) | (begin == 0)
            whole &= (place - found.left + found.length < end) | (end == len(data))
            yield number, begin, _Found(*(v[whole] for v in (found.anchor, found.context, found.text, found.place, found.left, found.length)))
    if group:
        yield start, 0, _find(group, rule)


ROW = "anchor long, context long, doc long, at long, shape int"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _anchor_rows(docs: DataFrame, rule: RepeatRule) -> DataFrame:
    """A row per anchor of a batch's first occurrence of a context, and the stretches of the others.

    ``at`` is place << 32 | text hash. An anchor's ``shape`` is -(left << 16 | length) of
    its context, that of a stretch which occurs earlier in the batch its length.
    """

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        order = sorted(range(batch.num_rows), key=batch.column("doc").to_pylist().__getitem__)
        ids = np.array(batch.column("doc").to_pylist(), np.int64)[order]
        marks = np.array(batch.column("mark").to_pylist(), np.int64)[order]
        data = column(batch, "data")
        parts = [(start, offset, f) for start, offset, f in _groups([data[i] for i in order], rule)]
        if not parts:
            return
        joined = lambda pick: np.concatenate([pick(*p) for p in parts])
        text = joined(lambda start, _, f: f.text + start)
        place = joined(lambda _, offset, f: f.place + offset)
        anchor, context, left, length = (joined(lambda _, __, f, n=n: getattr(f, n)) for n in ("anchor", "context", "left", "length"))
        if not len(text):
            return
        doc, mark = ids[text], marks[text]
        by = np.lexsort((place, doc, context, anchor))
        same = np.zeros(len(by), bool)
        same[1:] = (anchor[by[1:]] == anchor[by[:-1]]) & (context[by[1:]] == context[by[:-1]])
        head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
        later = np.zeros(len(by), bool)
        later[by] = same & ((doc[by] != doc[head]) | (place[by] != place[head]))
        kept = ~later
        shape = -(left << 16 | length)
        at = place << 32 | mark
        yield _batch(anchor[kept], context[kept], doc[kept], at[kept], shape[kept])
        if later.any():
            begin, end = (place - left)[later], (place - left + length)[later]
            whose = text[later]
            fresh = np.ones(len(whose), bool)
            fresh[1:] = (whose[1:] != whose[:-1]) | (begin[1:] > end[:-1]) | (begin[1:] < begin[:-1])
            heads = np.flatnonzero(fresh)
            width = np.maximum.reduceat(end, heads) - begin[heads]
            at = begin[heads] << 32 | mark[later][heads]
            spread = _mixed((at ^ doc[later][heads]).view(np.uint64))
            yield _batch(spread, spread, doc[later][heads], at, width)

    def _batch(anchor, context, doc, at, shape) -> pa.RecordBatch:
        arrays = [_signed(anchor), _signed(context), pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(shape.astype(np.int32), pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "context", "doc", "at", "shape"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows_of(batch)

    return docs.mapInArrow(found, ROW)


def suffix_order(data: np.ndarray, left: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes of all contexts in order, and the ranks of prefixes of 8, 16, .. bytes.

    A suffix ends with its context, of which ``left`` bytes remain; ends are ordered
    by the context's ``number``, as if each had a sign of its own.
    """
    size = len(data)
    words = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        words = words[:-width] << np.uint64(8 * width) | words[width:]
    short = np.flatnonzero(left < 8)
    beyond = (8 * (8 - left[short])).astype(np.uint64)
    words[short] = words[short] >> beyond << beyond
    # an end sorts before any byte, ends of equal rests by number
    ends = int(number.max(initial=0)) + 1
    tail = np.where(left < 8, left * ends + number, 8 * ends)
    order = np.argsort(words)
    # of equal words only those near an end have an order yet
    alike = words[order[1:]] == words[order[:-1]]
    group = np.cumsum(np.concatenate([[True], ~alike])) - 1
    near = np.bincount(group, weights=left[order] < 8) > 0
    again = np.flatnonzero(near[group])
    some = order[again]
    order[again] = some[np.lexsort((tail[some], words[some]))]
    new = np.ones(size, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (tail[order[1:]] != tail[order[:-1]])
    order = order.astype(np.int32)
    rank = np.empty(size, np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    ranks, width = [(8, rank)], 8
    while rank[order[-1]] < size:
        # suffixes that are alone with their rank have found their place
        alone = new & np.append(new[1:], True)
        open_at = np.flatnonzero(~alone)
        some = order[open_at]
        further = np.where(left[some] > width, rank[np.minimum(some + width, size - 1)], number[some] - ends)
        key = rank[some].astype(np.int64) * (size + ends + 1) + further
        by = np.argsort(key)
        order[open_at], key = some[by], key[by]
        new[open_at[1:]] = key[1:] != key[:-1]
        rank = np.empty(size, np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        width *= 2
        ranks.append((width, rank))
    return order, ranks


def _common(a: np.ndarray, b: np.ndarray, ranks: list[tuple[int, np.ndarray]], data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Longest common prefixes of pairs of suffixes, from the ranks of their prefixes."""
    room = np.minimum(left[a], left[b])
    out, last = np.zeros(len(a), np.int64), len(data) - 1
    for width, rank in reversed(ranks):
        same = rank[np.minimum(a + out, last)] == rank[np.minimum(b + out, last)]
        out += width * (same & (room - out >= width))
    for _ in range(8):
        same = data[np.minimum(a + out, last)] == data[np.minimum(b + out, last)]
        going = same & (room > out)
        out += going
    return out


def repeated_windows(contexts: list[bytes], keys: np.ndarray, least: int) -> np.ndarray:
    """For each byte of the contexts, one after the other: does a window start here that also starts earlier?

    ``keys`` has the order number of the window at each byte; equal numbers are the
    same window of the same text.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes)
    number = np.repeat(np.arange(len(contexts)), sizes)
    left = ends[number] - np.arange(len(data))
    order, ranks = suffix_order(data, left, number)
    # run-compressed transform: a context's first suffix has a sign of its own before it
    before = np.where(left == sizes[number], -1 - number, data[np.maximum(np.arange(len(data)) - 1, 0)].astype(np.int64))[order]
    heads = np.ones(len(order), bool)
    heads[1:] = before[1:] != before[:-1]
    samples = np.flatnonzero(heads)
    matched = np.full(len(data), -(1 << 40), np.int64)
    matched[order[samples]] = 0
    inner = samples[samples > 0]
    matched[order[inner]] = _common(order[inner - 1], order[inner], ranks, data, left)
    # matching statistics in text order: from a sample on they fall by one with each byte
    place = np.arange(len(data))
    statistics = np.maximum.accumulate(matched + place) - place
    long = statistics[order] >= least
    starts = np.flatnonzero(~long)
    if not len(starts) or starts[0] != 0:
        starts = np.concatenate([[0], starts])
    earliest = np.minimum.reduceat(keys[order], starts)
    out = np.zeros(len(data), bool)
    valid = left[order] >= least
    out[order] = valid & (keys[order] > np.repeat(earliest, np.diff(starts, append=len(order))))
    return out


def _stretches(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(marked, prepend=False, append=False))
    return edges[::2], edges[1::2]


def _resolve(contexts: DataFrame, rule: RepeatRule) -> DataFrame:
    """Stretches (doc, at, length) of the contexts' windows that also start earlier, anchor by anchor."""

    def indexed(parts: list[bytes], docs: np.ndarray, ats: np.ndarray) -> pa.RecordBatch:
        # one collection for all anchors: equal windows of different anchors are equal too
        sizes = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doc, place = docs[owner], (ats >> 32)[owner] + inner
        # the order of (document, place): numbers of the documents, which leave room for every place
        keys = np.unique(docs, return_inverse=True)[1][owner] * (int(place.max(initial=0)) + 1) + place
        begins, stops = _stretches(repeated_windows(parts, keys, rule.least))
        # the last windows of a context start before its end, so no stretch runs into the next
        at = place[begins] << 32 | (ats & 0xFFFFFFFF)[owner[begins]]
        return _interval_batch(doc[begins], at, stops - begins + rule.least - 1)

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts in lots of whole anchors; an anchor's rows stand together."""
        parts, docs, ats, size, last = [], [], [], 0, None
        for batch in batches:
            anchor, doc, at = (batch.column(n).to_numpy() for n in ("anchor", "doc", "at"))
            data = column(batch, "data")
            if not data:
                continue
            begin = 0
            for end in [*(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(data)]:
                if size >= rule.index_bytes and anchor[begin] != last:
                    yield indexed(parts, np.concatenate(docs), np.concatenate(ats))
                    parts, docs, ats, size = [], [], [], 0
                last = anchor[begin]
                parts += data[begin:end]
                docs.append(doc[begin:end])
                ats.append(at[begin:end])
                size += sum(map(len, data[begin:end]))
                begin = end
        if parts:
            yield indexed(parts, np.concatenate(docs), np.concatenate(ats))

    rows = contexts.select("anchor", "doc", "at", "data").repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(resolved, "doc long, at long, length int")


def _interval_batch(doc: np.ndarray, at: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(length.astype(np.int32), pa.int32())], ["doc", "at", "length"])


def _resolve_hot(contexts: DataFrame, rule: RepeatRule) -> DataFrame:
    """The same for anchors with very many contexts: a digest per window, shuffled by it."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = range(len(row["data"]) - rule.least + 1)
                windows = [hashlib.md5(row["data"][i : i + rule.least]).digest() for i in starts]
                at = [row["at"] + (i << 32) for i in starts]
                yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array([row["doc"]] * len(at), pa.int64()), pa.array(at, pa.int64())], ["window", "doc", "at"])

    rows = contexts.select("doc", "at", "data").mapInArrow(digests, "window binary, doc long, at long").distinct()
    place = F.shiftright("at", 32).alias("place")
    first = rows.groupBy("window").agg(F.min(F.struct("doc", place)).alias("first"))
    later = rows.join(first, "window").where(F.struct("doc", place) > F.col("first"))
    return later.select("doc", "at", F.lit(rule.least).alias("length"))


def _contexts(docs: DataFrame, open_anchors: DataFrame, rule: RepeatRule) -> DataFrame:
    """(anchor, hot, doc, at, data) of the contexts to look into; texts move once."""
    listed = open_anchors.withColumn("mark", F.col("at").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    listed = listed.groupBy("doc", "mark").agg(F.collect_list(F.struct("anchor", "hot", F.shiftright("at", 32).alias("place"))).alias("places"))
    joined = docs.join(listed.hint("shuffle_hash"), ["doc", "mark"]).select("doc", "mark", "data", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "hot", "doc", "at", "data"]
        for batch in batches:
            lists = batch.column("places")
            ends = np.cumsum(lists.value_lengths().to_numpy())
            flat = lists.flatten()
            anchor, hot, place = (flat.field(n) for n in ("anchor", "hot", "place"))
            begins = np.maximum(0, place.to_numpy() - rule.reach)
            stops = (place.to_numpy() + rule.least).tolist()
            first = 0
            # a document at a time, so that a batch of long ones stays small
            for doc, mark, data, last in zip(column(batch, "doc"), column(batch, "mark"), column(batch, "data"), ends.tolist()):
                some = begins[first:last]
                parts = [data[low:high] for low, high in zip(some.tolist(), stops[first:last])]
                arrays = [
                    anchor.slice(first, last - first), hot.slice(first, last - first), pa.array(np.full(len(some), doc), pa.int64()),
                    pa.array(some << 32 | mark, pa.int64()), pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)
                first = last

    return joined.mapInArrow(cut, "anchor long, hot boolean, doc long, at long, data binary")


def _merged(intervals: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted((i["place"], min(size, i["place"] + i["length"])) for i in intervals):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def repeated_strings(docs: DataFrame, rule: RepeatRule | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, and the removed spans.

    Strings are bytes of the UTF-8 text; none crosses documents. "Earlier" is a smaller
    doc_id, or the same one and an earlier start; a null id comes before all others.
    Rows that share an id are the same document: copies of a row get the same result,
    and neither marks the other. Null texts are empty; texts below ``least`` bytes lose
    nothing; an empty table gives no rows.
    """
    rule = rule or RepeatRule()
    spark = docs.sparkSession
    stages = Stages(spark)
    small_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).alias("mark")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")).alias("doc")
    bytes_of = docs.select(doc, mark, text.cast("binary").alias("data"))

    rows = _anchor_rows(bytes_of, rule).withColumn("stretch", F.col("shape") > 0)
    group = W.partitionBy("anchor", "stretch")
    place = F.shiftright("at", 32)
    rows = rows.withColumn("first", F.first(F.struct("doc", place.alias("place"))).over(W.partitionBy("anchor", "stretch", "context").orderBy("doc", "at")))
    rows = rows.withColumn("several", F.min("context").over(group) < F.max("context").over(group)).withColumn("n", F.count("*").over(group))
    later = ~F.col("stretch") & (F.struct("doc", place.alias("place")) > F.col("first"))
    left, length = F.shiftright(-F.col("shape"), 16), (-F.col("shape")).bitwiseAND(0xFFFF)
    known = rows.withColumn("later", later).where("stretch OR later OR several").select(
        F.when(F.col("stretch") | F.col("later"), F.lit(None)).otherwise(F.col("anchor")).alias("anchor"),
        (F.col("n") > rule.hot).alias("hot"),
        "doc",
        F.when(F.col("later"), F.col("at") - F.shiftleft(left.cast("long"), 32)).otherwise(F.col("at")).alias("at"),
        F.when(F.col("stretch"), F.col("shape")).when(F.col("later"), length).alias("length"),
    )
    known = stages.write(known, "anchors")
    contexts = _contexts(bytes_of, known.where("anchor IS NOT NULL").select("anchor", "hot", "doc", "at"), rule)
    contexts = stages.write(contexts, "contexts")
    marked = known.where("anchor IS NULL").select("doc", "at", "length")
    marked = marked.unionByName(_resolve(contexts.where("NOT hot"), rule)).unionByName(_resolve_hot(contexts.where("hot"), rule))
    spans = marked.groupBy("doc", F.col("at").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("mark"))
    spans = spans.agg(F.collect_list(F.struct(place.alias("place"), "length")).alias("intervals"))
    joined = bytes_of.join(spans.hint("shuffle_hash"), ["doc", "mark"], "left").select("doc", "data", "intervals")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, data, intervals in zip(column(batch, "doc"), column(batch, "data"), column(batch, "intervals")):
                gone = _merged(intervals or [], len(data))
                digest, at = hashlib.sha256(), 0
                for begin, end in gone:
                    digest.update(data[at:begin])
                    at = end
                digest.update(data[at:])
                out.append((None if doc == NO_ID else doc, len(data), sum(b - a for a, b in gone), len(gone), digest.hexdigest(), gone))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            arrays = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(a), k) for a, k in zip(arrays, kinds)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return joined.mapInArrow(removed, schema)
