"""Secret scans: fixed patterns, and character windows of high entropy.

All of it is DataFrame code. Positions come from the texts between the matches
(``split``) and the matches themselves (``regexp_extract_all``): their lengths
in code points add up to the starts, block by block, so that the work is in
proportion to the text however many matches it has.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.shared import id_and_text, literal_array

# The patterns of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
BASE = KINDS[:3]

# Strings that look random but are none of a secret. A word takes the letters and digits around it along.
ALLOWED = (
    r"(?i)example|sample|placeholder|changeme|dummy|xxxx|your[_-]",
    r"(?i)0123456789|abcdefghij",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
MICRO = 1_000_000
# The characters of candidates.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Arrays and texts are gone through in blocks of so many entries, candidates in blocks of so many windows.
RUN = 64
WINDOWS = 1024


@dataclass(frozen=True)
class EntropyRule:
    """A window of ``window`` characters is hot from so many bits a character on.

    The threshold depends on the class of the candidate's characters: hex digits
    reach 4 bits at most, mixed text more.
    """

    window: int = 24
    hex_bits: float = 3.0
    mixed_bits: float = 4.0
    allowed: tuple[str, ...] = ALLOWED

    def weights(self) -> list[int]:
        """c log2 c in millionths of a bit for every count c of a window."""
        return [0] + [round(c * math.log2(c) * MICRO) for c in range(1, self.window + 1)]

    def most(self, bits: float) -> int:
        """The largest sum of the weights at which a window's entropy reaches ``bits``."""
        return round(self.window * (math.log2(self.window) - bits) * MICRO)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` makes of 0 and all values before each one.

    An array that grows by one value is copied each time, so it grows within short
    blocks, and once more over the blocks.
    """
    empty = F.expr("CAST(array() AS array<int>)")

    def listed(some: Column, start: Column) -> Column:
        step = lambda s, x: F.struct(join(s["at"], x).alias("at"), F.concat(s["found"], F.array(s["at"])).alias("found"))
        return F.aggregate(some, F.struct(start.alias("at"), empty.alias("found")), step, lambda s: s["found"])

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), join))
        return F.flatten(F.zip_with(blocks, listed(totals, F.lit(0)), listed))

    return _let(_let(values, lambda v: _blocks(v, RUN, RUN)), whole)


def _blocks(values: Column, step: int, width: int) -> Column:
    """``width`` values from every ``step``-th on; the last block may be empty."""
    numbers = F.sequence(F.lit(0), (F.size(values) / step).cast("int"))
    return F.transform(numbers, lambda b: F.slice(values, b * step + 1, width))


def _matches(text: Column, pattern: str, group: int, possible: Column | None) -> Column:
    """Start, end, match and group of each match, leftmost first."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
    paired = F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("match"), part.alias("part")), lambda x: x["match"].isNotNull())

    def placed(x: Column, at: Column) -> Column:
        start = at + x["gap"]
        end = start + F.length(x["match"])
        return F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["part"].alias("part"))

    steps = lambda found: F.transform(found, lambda x: x["gap"] + F.length(x["match"]))
    listed = _let(paired, lambda found: F.zip_with(found, _running(steps(found), add), placed))
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int,match:string,part:string>>)")
    some = F.regexp_like(text, F.lit(pattern))
    return F.when(some if possible is None else possible & some, listed).otherwise(empty)


def _spans(matches: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), number.alias("kind"), m["end"].alias("end")))


def _hot_windows(block: Column, rule: EntropyRule) -> Column:
    """Merged spans of a block's hot windows, by counts that follow the window.

    One character enters and one leaves at each step; only their two counts change,
    and with them the sum of c log2 c, from which the entropy follows. The counts
    lie side by side in a few integers, so that a change is one addition.
    """
    size = rule.window
    bits = size.bit_length()
    each = 63 // bits
    words = [f"counts{i}" for i in range(-(-len(ALPHABET) // each))]
    weight = literal_array(rule.weights())
    slots, is_hex = block["slots"], block["is_hex"]
    limit = F.when(is_hex, F.lit(rule.most(rule.hex_bits))).otherwise(F.lit(rule.most(rule.mixed_bits)))
    kind = F.when(is_hex, F.lit(KINDS.index("entropy_hex"))).otherwise(F.lit(KINDS.index("entropy_mixed")))
    steps = F.transform(
        slots,
        lambda c, i: F.struct(i.alias("i"), c.alias("new"), F.when(i >= size, F.get(slots, i - size)).otherwise(-1).alias("old")),
    )
    shift = lambda slot: slot % each * bits
    one = lambda slot: F.call_function("shiftleft", F.lit(1).cast("long"), shift(slot))

    def seen(s: Column, upto: Column) -> list[Column]:
        """The open stretch and the closed ones after the window that ends before ``upto``."""
        start = block["start"] + upto - size
        hot = (upto >= size) & (s["total"] <= limit)
        joins = s["end"] >= start
        begin = F.when(hot & ~joins, start).otherwise(s["begin"])
        end = F.when(hot, start + size).otherwise(s["end"])
        done = F.when(hot & ~joins & (s["end"] >= 0), F.concat(s["done"], F.array(_span(s["begin"], kind, s["end"])))).otherwise(s["done"])
        return [begin.alias("begin"), end.alias("end"), done.alias("done")]

    def count(s: Column, slot: Column) -> Column:
        word = reduce(lambda other, i: F.when(F.floor(slot / each) == i, s[words[i]]).otherwise(other), range(len(words)), F.lit(0).cast("long"))
        return F.call_function("shiftright", word, shift(slot)).bitwiseAND((1 << bits) - 1).cast("int")

    def step(s: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        into, out = count(s, new), count(s, old)
        grown = F.get(weight, into + 1) - F.get(weight, into)
        shrunk = F.when(old >= 0, F.get(weight, out - 1) - F.get(weight, out)).otherwise(0)
        total = s["total"] + F.when(new == old, 0).otherwise(grown + shrunk)
        change = lambda slot, i: F.when((slot >= i * each) & (slot < (i + 1) * each), one(slot)).otherwise(F.lit(0).cast("long"))
        counts = [(s[word] + change(new, i) - change(old, i)).alias(word) for i, word in enumerate(words)]
        return F.struct(*counts, total.alias("total"), *seen(s, x["i"]))

    empty = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")
    first = F.struct(
        *[F.lit(0).cast("long").alias(word) for word in words], F.lit(0).alias("total"),
        F.lit(-1).alias("begin"), F.lit(-1).alias("end"), empty.alias("done"),
    )

    def finish(s: Column) -> Column:
        begin, end, done = seen(s, F.size(slots))
        return F.when(end >= 0, F.concat(done, F.array(_span(begin, kind, end)))).otherwise(done)

    return F.aggregate(steps, first, step, finish)


def _span(start: Column, kind: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"))


def _not_allowed(m: Column, rule: EntropyRule) -> Column:
    """(start, match) of what is left of a candidate between allowed words, where a window fits."""
    part = lambda start, match: F.struct(start.alias("start"), match.alias("match"))
    whole = F.array(part(m["start"], m["match"]))
    if not rule.allowed:
        return whole
    word = "|".join(f"[A-Za-z0-9]*(?:{pattern})(?:(?<=[A-Za-z0-9])[A-Za-z0-9]*)?" for pattern in rule.allowed)
    taken = F.transform(F.regexp_extract_all(m["match"], F.lit(word), F.lit(0)), lambda s: F.length(s))
    pieces = F.split(m["match"], word, -1)

    sized = F.zip_with(pieces, taken, lambda s, n: F.struct(s.alias("piece"), (F.length(s) + F.coalesce(n, F.lit(0))).alias("size")))

    def placed(parts: Column) -> Column:
        before = _running(F.transform(parts, lambda x: x["size"]), add)
        return F.zip_with(parts, before, lambda x, at: part(m["start"] + at, x["piece"]))

    cut = F.filter(_let(sized, placed), lambda x: F.length(x["match"]) >= rule.window)
    some = reduce(lambda a, b: a | b, [F.regexp_like(m["match"], F.lit(pattern)) for pattern in rule.allowed])
    return F.when(some, cut).otherwise(whole)


def _entropy_spans(text: Column, rule: EntropyRule) -> Column:
    pattern = f"[{ALPHABET}]{{{rule.window},}}"
    found = _matches(text, pattern, 0, F.regexp_like(text, F.lit("[0-9]")))
    digit = lambda m: F.regexp_like(m["match"], F.lit("[0-9]"))
    candidates = F.filter(F.flatten(F.transform(F.filter(found, digit), lambda m: _not_allowed(m, rule))), digit)
    alphabet = literal_array([ALPHABET.find(chr(c)) for c in range(128)])

    def opened(m: Column) -> Column:
        """A candidate in blocks; the windows of a block start in it and end in the next one at most."""
        is_hex = F.regexp_like(m["match"], F.lit("^[0-9a-fA-F]+$"))
        slots = F.transform(F.split(m["match"], ""), lambda c: F.get(alphabet, F.ascii(c)))
        of = lambda block, b: F.struct((m["start"] + b * WINDOWS).alias("start"), block.alias("slots"), is_hex.alias("is_hex"))
        return _let(slots, lambda s: F.transform(_blocks(s, WINDOWS, WINDOWS + rule.window - 1), of))

    # what the windows look at again and again is computed once per block
    blocks = F.flatten(F.transform(candidates, opened))
    return _let(F.flatten(F.transform(blocks, lambda block: _hot_windows(block, rule))), _touching)


def _touching(spans: Column) -> Column:
    """Spans in order, those that the ends of blocks have parted in one piece again."""
    first = F.filter(spans, lambda x, i: F.coalesce(x["start"] > F.get(spans, i - 1)["end"], F.lit(True)))
    last = F.filter(spans, lambda x, i: F.coalesce(F.get(spans, i + 1)["start"] > x["end"], F.lit(True)))
    return F.zip_with(first, last, lambda a, b: _span(a["start"], a["kind"], b["end"]))


def _all_spans(text: Column, rule: EntropyRule) -> Column:
    assigned = F.filter(
        _matches(text, ASSIGN, 1, F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))),
        lambda m: F.length(m["part"]) >= ASSIGN_LEAST,
    )
    everything = F.concat(
        _spans(assigned, "assign"),
        _spans(_matches(text, ACCESS, 0, F.contains(text, F.lit("AKIA"))), "access"),
        _spans(_matches(text, HEX, 0, None), "hex"),
        _entropy_spans(text, rule),
    )
    return F.array_sort(everything)


def with_spans(docs: DataFrame, rule: EntropyRule | None = None, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """Add the array of (start, kind number, end) of all secrets, in order, to each row.

    Code points, end exclusive. A null text counts as empty and has none. Values
    of fewer than 8 characters after a keyword are dropped after matching, so they
    still use up their text.
    """
    return docs.withColumn(into, _all_spans(F.coalesce(F.col(text), F.lit("")), rule or EntropyRule()))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_secrets(docs: DataFrame, rule: EntropyRule | None = None) -> DataFrame:
    """One row per document: counts of each kind, a digest of the base spans, all spans as text.

    Rows are independent of each other: repeated rows give repeated results, a
    null id stays null, an empty table gives no rows. Columns other than
    ``doc_id`` and ``text`` are ignored, whatever their names.
    """
    found = with_spans(id_and_text(docs), rule, into="spans")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        *[of(k).alias(f"n_{k}") for k in KINDS[len(BASE) :]],
    )


def redact_secrets(docs: DataFrame, rule: EntropyRule | None = None, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mask`` and ``n_chars`` counted anew.

    Overlapping spans are masked once. A null text stays null. No column is added on
    the way, so other columns may have any names.
    """
    text = F.col("text")

    def masked(spans: Column, pieces: Column) -> Column:
        before = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        # a span that starts inside the ones before only moves their end
        gaps = F.zip_with(spans, before, lambda s, at: F.struct(at.alias("begin"), s["start"].alias("end")))
        kept = F.transform(F.filter(gaps, lambda g: g["end"] >= g["begin"]), lambda g: _cut(pieces, g["begin"], g["end"]))
        rest = _cut(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.array_join(F.concat(kept, F.array(rest)), mask)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{RUN}}}"), F.lit(0))
    spans = _all_spans(F.coalesce(text, F.lit("")), rule or EntropyRule())
    changed = _let(spans, lambda s: F.when(F.size(s) > 0, _let(pieces, lambda p: masked(s, p))).otherwise(text))
    out = docs.withColumn("text", changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def _cut(pieces: Column, begin: Column, end: Column) -> Column:
    """The characters from ``begin`` to before ``end`` of a text in pieces of equal length."""
    first, last = (F.floor(at / RUN).cast("int") for at in (begin, end))
    piece = lambda i: F.coalesce(F.get(pieces, i), F.lit(""))
    across = F.concat(
        F.substring(piece(first), begin % RUN + 1, F.lit(RUN)),
        F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(piece(last), F.lit(1), end % RUN),
    )
    return F.when(first == last, F.substring(piece(first), begin % RUN + 1, end - begin)).otherwise(across)
