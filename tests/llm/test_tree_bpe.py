"""BPE by tree concatenation against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import string
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from evenhand.llm import tree_bpe

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    with open(FILE) as file:
        return tree_bpe.words(file.read())


def ids_of(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def texts() -> list[str]:
    rnd = random.Random(5)
    found = ["", " ", "see <|endoftext|> here", "<|startoftext|>", "<|ENDOFTEXT|>x", "a<|endoftext|>́<|endoftext|>", "y" * 5000, "a" * 9001]
    found += ["the" * 3001, "日本語" * 1500, "<|" * 500, "1" * 300, "ha" * 2501, "." * 5001, "\U0001f600" * 700]
    for letters in ("ab'sSTÀé \n\t.,1Σİд日́ \x85\xa0ß×ªµ\x1c<|>", "ey", "thein", "aAaaabc", "日本語テキ"):
        found += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
        found.append("".join(rnd.choice(letters) for _ in range(3000)))
    return found + ["".join(rnd.choice(string.ascii_lowercase) for _ in range(4000)) for _ in range(5)]


def test_ids_and_decoded_text_are_those_of_the_library(own, library):
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own.encode(text)) == ids
        assert own.decode(own.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_slices_encoded_apart_join_to_the_same_ids(own, library, size):
    for text in texts():
        parts = [*own.slices(text, size)]
        before = [False, *[goes_on for _, goes_on in parts[:-1]]]
        found = [own.slice(piece, goes_on, b) for (piece, goes_on), b in zip(parts, before)]
        assert own.joined(found) == library.encode(text, add_special_tokens=False).ids


def test_any_two_halves_join(own):
    rnd = random.Random(6)
    for letters in ("ey", "thein", string.ascii_lowercase):
        for _ in range(200):
            word = "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 200)))
            at = rnd.randint(0, len(word) - 1)
            halves = own.merges.merged(own.merges.symbols(word[:at], False)), own.merges.merged(own.merges.symbols(word[at:], True))
            assert own.merges.join(*halves) == own.merges.merged(own.merges.symbols(word, True))


def test_long_windows_merge_alike_by_arrays(own, monkeypatch):
    rnd = random.Random(7)
    words = ["".join(rnd.choice(letters) for _ in range(400)) for letters in ("a", "ey", "thein", string.ascii_lowercase) for _ in range(10)]
    by_arrays = [own.merges.merged(own.merges.symbols(word, True)) for word in words]
    monkeypatch.setattr(tree_bpe, "BY_ARRAYS", 1 << 30)
    assert by_arrays == [own.merges.merged(own.merges.symbols(word, True)) for word in words]


def test_merges_that_are_not_in_order_are_refused():
    model = {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2, "aab": 3}, "merges": ["a ab", "a b"]}
    with pytest.raises(ValueError):
        tree_bpe.Merges(model)
    with pytest.raises(ValueError):
        tree_bpe.Merges({"type": "WordPiece", "vocab": {}, "merges": []})


def expected_rows(rows, library):
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        out.append((doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("long_text, slice_size", [(tree_bpe.LONG_TEXT, tree_bpe.SLICE), (100, 64), (0, 5000)])
def test_round_trip_of_all_rows(odd, odd_rows, nothing, library, long_text, slice_size):
    found = tree_bpe.round_trip(odd, FILE, long_text=long_text, slice_size=slice_size).collect()
    assert sorted(repr(tuple(r)) for r in found) == expected_rows(odd_rows, library)
    assert tree_bpe.round_trip(nothing, FILE, long_text=long_text).collect() == []


def test_very_long_texts_and_their_copies(spark, library):
    rnd = random.Random(8)
    unsplit = "".join(rnd.choice("abcdefghijklmnop") for _ in range(400_000))
    rows = [(1, unsplit), (1, unsplit), (None, unsplit), (2, "word <|endoftext|> " * 30_000), (3, "z" * 300_001), (4, "\n" * 70_000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = tree_bpe.round_trip(docs, FILE).collect()
    assert sorted(repr(tuple(r)) for r in found) == expected_rows(rows, library)
    ids = {r.doc_id: ids_of(bytes(r.ids)) for r in tree_bpe.encode(docs, FILE).collect()}
    assert ids[3] == library.encode(rows[4][1], add_special_tokens=False).ids
