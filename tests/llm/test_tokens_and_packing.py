import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratafold.llm.packing import pack, place, plan_packing
from stratafold.llm.tokens import Encoder, Vocabulary, token_counts

HARD = [
    None,
    "",
    " ",
    "  a  b \n c\n\n d <|endoftext|> x<|endoftext|>y   z  q\x1c r\x85 s",
    "᠎ b​ c \t d　 e﻿",
    "日本語のテキスト" * 40 + " 𝄞 é",
    "<|endoftext|>" * 50,
    "<|endof" + "text|> " * 3,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_every_token_encodes_to_itself(library):
    """What makes merges by rank and by the list of merges agree; see tokens.Vocabulary."""
    special = Vocabulary().special_id
    assert all([t.id for t in library.model.tokenize(s)] == [i] for s, i in library.get_vocab().items() if i != special)


def test_code_points_are_split_alike(library):
    own = Encoder(Vocabulary())
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF][::7]
    texts = [f"a{chr(c)}b1{chr(c)}2{chr(c)}{chr(c)} {chr(c)}z" for c in points]
    assert [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)] == [own.at_once(t) for t in texts]


def test_counts_of_the_whole_table(sample, library):
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts(sample).collect()}
    expected = {i: (len((t or "").encode()), len(ids_of(library, t)), len(ids_of(library, t)) > 512) for i, t in texts.items()}
    assert got == expected


def test_counts_of_hard_texts(docs_of, library):
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs_of(HARD)).collect()}
    assert got == {i: len(ids_of(library, t)) for i, t in enumerate(HARD)}
    assert token_counts(docs_of(["x"]).limit(0)).count() == 0
    assert token_counts(docs_of([(None, "x"), (1, "x"), (1, "x")])).count() == 3


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (100, 40), (1000, 64)])
def test_resynchronised_chunks_equal_the_whole(library, chunk, overlap):
    pick = random.Random(chunk)
    own = Encoder(Vocabulary(), chunk=chunk, overlap=overlap, margin=16)
    pieces = ["word", " and", "  ", "\n", "\t ", "日本", " <|endoftext|>", "<|endoftext|>", "1234", "'s", "é", "     ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for _ in range(40):
        text = "".join(pick.choice(pieces) for _ in range(pick.randrange(1, 700)))
        assert [i for part in own.parts(text) for i in part] == ids_of(library, text)
    assert own.count("b" * 3000) == len(ids_of(library, "b" * 3000))


def test_a_text_the_faster_library_gives_up_on(library):
    own = Encoder(Vocabulary(), chunk=4_000_000)
    assert own.count(" " * 3_000_000) == len(ids_of(library, " " * 3_000_000))


def check_pieces(rows, texts, library, window=1024):
    """Exact round trip; returns the share of padding."""
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array([*ids_of(library, text), 0], "<u4")
        at = 0
        for r in sorted(own[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padded = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padded += window - at
    return padded, len(sequences)


def test_packing_is_exact_and_tight(sample, library):
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    padded, _ = check_pieces(pack(sample).collect(), texts, library)
    assert padded < 1024


def test_packing_of_hard_texts(docs_of, library):
    texts = dict(enumerate([*HARD, "a b c " * 4000, *["same tail"] * 50]))
    padded, _ = check_pieces(pack(docs_of(list(texts.values()))).collect(), texts, library)
    assert padded < 1024
    assert pack(docs_of(["x"]).limit(0)).count() == 0
    rows = pack(docs_of([(None, "x"), (1, "y z"), (1, "y z")])).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "None"]


def test_plan_places_every_tail_once():
    pick = np.random.default_rng(5)
    histogram = np.bincount(pick.integers(1, 64, 500), minlength=64)
    histogram[40] += 400  # a hot length without enough partners
    plan = plan_packing(histogram, 64)
    taken = {}
    for length in range(1, 64):
        for rank in range(histogram[length]):
            for _, n, sequence, offset in place(plan, length, rank, 64):
                cells = taken.setdefault(sequence, set())
                new = set(range(offset, offset + n))
                assert not cells & new
                cells |= new
    assert set(taken) == set(range(plan.total))
    assert sum(len(c) != 64 for c in taken.values()) <= 1 and all(len(c) == max(c) + 1 for c in taken.values())
    assert plan.combined > 0.5 * (plan.total - 400 * 40 // 64)
