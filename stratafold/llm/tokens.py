"""Token ids of whole texts: encoding with overlap resynchronisation, and counts.

A long text is encoded in overlapping chunks. Two neighbours are joined at a
boundary that is proven stable: in byte-level pre-tokenization a blank after a
character that is no white space starts a new piece whatever stands around it,
merges never cross pieces, and special strings hold no blank. The boundary must
also be a token boundary of both encodings, by their byte offsets. If an overlap
has none, it is widened, at last to the whole chunk, which then grows instead.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratafold.llm.shared import column, id_and_text, small_batches


@dataclass(frozen=True)
class Vocabulary:
    """Names of one vocabulary's two files and the string that stands for a special id.

    The tokenizers library defines the ids. Its encoding takes about 940 CPU seconds
    a GB of compressed documents; the same vocabulary as ranks takes 260. Both give
    the same ids if every token encodes to itself under the library's merges, since a
    pair that only the ranks would merge leaves its token unreachable there, and if
    both split texts alike. Tests check both for this vocabulary. Texts on which the
    faster library gives up are encoded by the slower one.
    """

    library_file: str = "byte_bpe_50k.json"
    ranks_file: str = "byte_bpe_50k.tiktoken"
    special: str = "<|endoftext|>"
    special_id: int = 50256


class Encoder:
    """Ids of texts; holds at most a few chunks' encodings at a time."""

    def __init__(self, vocabulary: Vocabulary, chunk: int = 32_768, overlap: int = 512, margin: int = 32):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(vocabulary.ranks_file), "rb") as f:
            pairs = (line.split() for line in f)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary.library_file))
        self.library.no_padding()
        self.library.no_truncation()
        self.special, self.special_id = vocabulary.special, vocabulary.special_id
        self.widths = np.zeros(max(max(ranks.values()), self.special_id) + 1, np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)
        self.widths[self.special_id] = len(self.special.encode())
        self.chunk, self.overlap, self.margin = chunk, overlap, margin

    def _ordinary(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:  # its panics are no Exceptions
            if type(error).__name__ != "PanicException":
                raise
            return self.library.encode(text, add_special_tokens=False).ids

    def at_once(self, text: str) -> list[int]:
        """The ids of a text in one go; special strings inside become their id."""
        if self.special not in text:
            return self._ordinary(text)
        ids: list[int] = []
        for i, part in enumerate(text.split(self.special)):
            ids += [self.special_id] * (i > 0) + self._ordinary(part)
        return ids

    def _stable(self, text: str, start: int, end: int) -> int | None:
        """The first boundary after ``start`` that holds in any encoding, ``end`` excluded."""
        at = text.find(" ", start + 1, end)
        while at >= 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1, end)
        return at if at >= 0 else None

    def _cut(self, ids: list[int], before: str) -> int | None:
        """How many of the ids make up ``before``, if a token ends there."""
        goal = len(before.encode("utf-8", "surrogatepass"))
        ends = np.concatenate([[0], np.cumsum(self.widths[ids])])
        at = int(np.searchsorted(ends, goal))
        return at if at < len(ends) and ends[at] == goal else None

    def parts(self, text: str) -> Iterator[list[int]]:
        """The ids of the whole text, in consecutive parts."""
        start, end = 0, min(len(text), self.chunk)
        ids = self.at_once(text[:end])
        while end < len(text):
            overlap = self.overlap
            while True:
                if overlap >= end - start:
                    end = min(len(text), end + max(self.chunk, end - start))
                    ids = self.at_once(text[start:end])
                    break
                begin = end - overlap
                at = self._stable(text, begin, end - self.margin)
                if at is not None:
                    further = min(len(text), end + self.chunk)
                    following = self.at_once(text[begin:further])
                    left, right = self._cut(ids, text[start:at]), self._cut(following, text[begin:at])
                    if left is not None and right is not None:
                        yield ids[:left]
                        ids, start, end = following[right:], at, further
                        break
                overlap *= 2
        yield ids

    def count(self, text: str) -> int:
        return sum(map(len, self.parts(text)))


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(vocabulary)


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row.

    A null text counts as empty: no bytes, no tokens. Rows are independent, so
    repeated rows and null ids are kept as they are; an empty table gives no rows.
    """
    vocabulary = vocabulary or Vocabulary()
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = encoder(vocabulary)
            texts = column(batch, "text")
            tokens = pa.array([own.count(t) for t in texts], pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, tokens], ["doc_id", "n_bytes", "n_tokens"])

    found = id_and_text(docs).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", found["n_tokens"] > limit)
