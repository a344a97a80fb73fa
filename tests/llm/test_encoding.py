"""Byte-level BPE and token files against the public libraries, and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from evenhand.llm import bpe, token_files
from evenhand.session import shared_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return bpe.encoder(file.read(), public_tokenizers.PATTERN)


def random_texts(n, letters="ab' \n\t.,1é日 \x85s\x1c"):
    rnd = random.Random(1)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_ids_are_those_of_the_library(encoder, library):
    texts = ["", "it's we'll  ", "ß日本語 テキスト", " " * 3000, "a" * 5000, "\n\n x", "<|endoftext|>", *random_texts(2000)]
    for text in texts:
        assert encoder.encode(text) == np.array(library.encode_ordinary(text), dtype="<u4").tobytes()
        assert encoder.decode(encoder.encode(text)) == text.encode()


def test_appends_change_no_entry(encoder):
    data = b"the quick retitioning of thousand brown foxes jumping " * 3
    table = bpe.PrefixTable(encoder.vocabulary)
    for start in range(0, len(data), 7):
        before = list(table.last)
        table.append(data[start : start + 7])
        assert table.last[: len(before)] == before
    assert table.encode() == encoder.vocabulary.merged(data)
    for end in range(0, len(data), 11):
        assert table.encode(end) == encoder.vocabulary.merged(data[:end])


def test_edits_are_encoded_anew_near_them(encoder):
    rnd = random.Random(2)
    data = bytes(rnd.choice(b"abcdefgh ") for _ in range(2000))
    table = bpe.PrefixTable(encoder.vocabulary, data)
    for _ in range(20):
        start = rnd.randrange(1500)
        end, new = start + rnd.randint(0, 9), bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(0, 9)))
        made = table.replace(start, end, new)
        data = data[:start] + new + data[end:]
        assert bytes(table.data) == data
        assert table.last == bpe.PrefixTable(encoder.vocabulary, data).last
        assert made < 400


def test_round_trip_of_all_rows(spark, odd, odd_rows, nothing, library):
    found = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text, *_ in odd_rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).collect() == []


def test_word_encoder_is_the_library():
    with open(WORDS) as file:
        text = file.read()
    own, theirs = token_files.WordEncoder(text, 2), Tokenizer.from_str(text)
    assert np.frombuffer(own.encode("see <|endoftext|> here"), "<u2").tolist() == [862, 49407, 763]
    assert np.frombuffer(own.encode("<|startoftext|>"), "<u2").tolist() == [49406]
    for case in ["WE'LL see <|endoftext|>", "a<|endoftext|><|startoftext|>́", "<|ENDOFTEXT|>", *random_texts(2000, "ab'sSTÀé \n\t.,1Σİ日́ \x85\xa0ß×ªµ\x1c<|>")]:
        assert own.encode(case) == np.array(theirs.encode(case, add_special_tokens=False).ids, dtype="<u2").tobytes()


@pytest.mark.parametrize("group", [1, 40, 4_000_000])
@pytest.mark.parametrize("width", [2, 4])
def test_groups_of_texts_are_the_library(monkeypatch, group, width):
    monkeypatch.setattr(token_files, "GROUP", group)
    with open(WORDS) as file:
        text = file.read()
    own, theirs = token_files.WordEncoder(text, width), Tokenizer.from_str(text)
    cases = ["", " \n", "WE'LL see <|endoftext|>", "'STop ''s a's 5's '5 '' ' !'s 's'", "y" * 3000, "ÀÞß÷×ÿ don't", "日本 it's", "x\x0b'll"]
    cases += random_texts(1000, "ab'sStTdMrevl \n.,12ÀéßÿÞ×'!") + random_texts(1000, "ab'sSTÀé \n\t.,1Σİ日́ \x85\xa0ß×ªµ\x1c<|>")
    expected = [np.array(e.ids, dtype=f"<u{width}").tobytes() for e in theirs.encode_batch(cases, add_special_tokens=False)]
    assert list(own.encode_all(cases)) == expected == [own.encode(c) for c in cases]
    assert list(own.encode_all([])) == [] and list(own.encode_all([None, "", "\n", "a"])) == [b"", b"", b"", own.encode("a")]


def test_spellings_of_a_word_are_one_part():
    """Case and marks around a word make no new entries, and a part of a group is looked up once, however often it stands there."""
    with open(WORDS) as file:
        own = token_files.WordEncoder(file.read(), 2)
    words = ["".join(random.Random(n).choices("abcdefgh", k=8)) for n in range(50)]
    text = " ".join(f"{a}{spelled}{b}" for w in words for spelled in (w, w.upper(), w.title()) for a in ("", "(") for b in ("", ",", ".", "!!"))

    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

    own.parts = Counted()
    assert list(own.encode_all([text] * 20)) == [own.encode(text)] * 20
    own.clear()
    own.parts = Counted()
    Counted.asked = 0
    list(own.encode_all([text] * 20))
    assert len(own) == 0 and len(own.parts) == len(words) + 4
    assert Counted.asked == 2 * len(own.parts)  # once for the group, once more as all are new


def test_other_tokenizer_files_go_through_the_library(spark):
    multi = public_tokenizers.path("byte_bpe_50k.json")
    with open(multi) as file:
        own = token_files.WordEncoder(file.read(), 2)
    theirs = Tokenizer.from_file(multi)
    assert not own.plain
    for case in ["Two  Words \n\nhere<|endoftext|> ", *random_texts(300)]:
        assert own.encode(case) == np.array(theirs.encode(case, add_special_tokens=False).ids, dtype="<u2").tobytes()


def test_the_least_id_is_no_null(spark):
    docs = spark.createDataFrame([(-(2**63), "one"), (None, "two"), (0, None)], "doc_id long, text string")
    assert [(r.doc_id, r.n_tokens) for r in token_files.round_trip(docs, WORDS).orderBy("start").collect()] == [(None, 2), (-(2**63), 2), (0, 1)]


def test_token_files_read_back(spark, odd, odd_rows, nothing):
    theirs = Tokenizer.from_file(WORDS)
    folder = shared_path(spark, "test-tokens")
    manifest = token_files.write(odd, folder, WORDS)
    rows = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in token_files.read(manifest, folder, with_ids=True).collect())
    assert len(rows) == len(odd_rows)
    start = 0
    for row in rows:
        assert row[0] == start and zlib.crc32(np.array(row[4], dtype="<u4").tobytes()) == row[3] and len(row[4]) == row[2]
        start += row[2]
    ids = [r[1] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    expected = sorted(repr((d, [*theirs.encode(t or "", add_special_tokens=False).ids, 1])) for d, t, *_ in odd_rows)
    assert sorted(repr((r[1], r[4])) for r in rows) == expected
    # One document alone, by its index record.
    file = manifest.first()["file"]
    store, top = token_files._filesystem(folder)
    tokens = token_files.TokenFile(store, f"{top}/{file}", token_files.read_dictionary(folder, file))
    doc_id = int(tokens.index[0]["doc_id"]) if tokens.index[0]["has_id"] else None
    assert any(r[4] == tokens.ids(0).tolist() for r in rows if r[1] == doc_id)
    with pytest.raises(ValueError):
        token_files.TokenFile(store, f"{top}/{file}", b"another dictionary")
    assert token_files.round_trip(nothing, WORDS).collect() == []
