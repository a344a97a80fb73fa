"""BPE by tree concatenation, for a tokenizer file of the tokenizers library.

A piece is what the tokenizer's normalizer and split leave together. Its symbols are the spelled bytes, the last one
with the end-of-word mark. A long piece is cut into leaves that are encoded apart, in parallel for long documents; then
neighbours are joined in pairs, level by level. At a join a window of the last tokens on the left and the first on the
right is encoded anew and doubled until both sides agree: its first token is the left's and its last the right's.

That is exact. Ids are the BPE encoding of their symbols just when every two neighbours are the encoding of their own
symbols, as each merge makes a token of its own and ranks above the merges that made its parts (``Merges`` checks it).
Pairs inside the window are such because it was encoded, pairs outside because their side was, and the two pairs on
its edges because they are pairs of one side.

Texts up to ``long_text`` characters are encoded where they are read. Longer ones become slices of pieces, one row
each, which are encoded by all tasks and joined per document.

Defined results: a null text is encoded as an empty one (no ids, empty decoded text); added tokens spelled out in a
text are their ids, as the library has them by default; very long texts and pieces without a break take time in
proportion to their length (times its logarithm where a join moves all tokens of one side); repeated rows, also with a
null doc_id, repeat; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evenhand.llm.common import only, ship
from evenhand.llm.token_files import PLAIN, _byte_alphabet, is_plain

#: Symbols of a leaf within a task, of a slice between tasks, and characters from which a text is sliced.
LEAF = 16
SLICE = 16_384
LONG_TEXT = 65_536
#: From so many symbols a window is merged by arrays.
BY_ARRAYS = 96
NO_MERGE = 1 << 40
CACHED_WORDS = 600_000
CACHED_PIECES = 400_000
CACHED_SYMBOLS = 64

#: The split of plain words, in lower case.
PLAIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

#: White space on which no normalizer, split or added token of the supported files reaches over.
SPLIT = re.compile(r"[^ \n\t\r]+")


class Merges:
    """Merges of a BPE model by the ids of symbols and tokens."""

    def __init__(self, model: dict):
        vocabulary, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"tree concatenation needs a plain BPE model, not one with {odd or model['type']}")
        self.end = model.get("end_of_word_suffix") or ""
        self.vocabulary = vocabulary
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}
        for left, right in pairs:
            token = vocabulary[left + right]
            pair = vocabulary[left], vocabulary[right]
            if token in self.parts or any(p not in self.parts and len(t.removesuffix(self.end)) > 1 for p, t in zip(pair, (left, right))):
                raise ValueError("a merge repeats a token or comes before the merges of its parts")
            self.parts[token] = pair
            self.rank[pair] = len(self.made)
            self.made.append(token)
        size = max(vocabulary.values(), default=-1) + 1
        self.size = size
        order = sorted(self.rank, key=lambda p: p[0] * size + p[1])
        self.keys = np.array([a * size + b for a, b in order], dtype=np.int64)
        self.ranks = np.array([self.rank[p] for p in order], dtype=np.int64)
        self.spelled: dict[int, tuple[int, ...]] = {}

    def symbols(self, piece: str, ends: bool) -> list[int]:
        """Ids of a piece's symbols; ``ends`` says that the word ends with it."""
        known = self.vocabulary
        if not ends or not self.end:
            return [known[c] for c in piece]
        return [*[known[c] for c in piece[:-1]], known[piece[-1] + self.end]]

    def expand(self, tokens: Sequence[int]) -> list[int]:
        out: list[int] = []
        for token in tokens:
            known = self.spelled.get(token)
            if known is None:
                pair = self.parts.get(token)
                known = self.spelled[token] = (token,) if pair is None else (*self.expand(pair[:1]), *self.expand(pair[1:]))
            out += known
        return out

    def merged(self, symbols: list[int]) -> list[int]:
        """BPE by its definition: the neighbours whose merge ranks lowest are merged, from the left."""
        if len(symbols) > BY_ARRAYS:
            return self._merged_by_arrays(symbols)
        rank, made, ids = self.rank, self.made, list(symbols)
        ranks = list(map(rank.get, zip(ids, ids[1:]), repeat(NO_MERGE)))
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            at = ranks.index(least)
            token = ids[at] = made[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank.get((ids[at - 1], token), NO_MERGE)
            if at < len(ranks):
                ranks[at] = rank.get((token, ids[at + 1]), NO_MERGE)
        return ids

    def _merged_by_arrays(self, symbols: list[int]) -> list[int]:
        """The same, one merge of all its places a round: long windows arise where few merges return all the time."""
        ids = np.array(symbols, dtype=np.int64)
        none = len(self.made)
        if not none:
            return symbols
        while len(ids) > BY_ARRAYS:
            keys = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ranks = np.where(self.keys[at] == keys, self.ranks[at], none)
            least = int(ranks.min())
            if least == none:
                return ids.tolist()
            hit = ranks == least
            # Of a run of overlapping places every other one is merged, from its first.
            starts = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            places = np.flatnonzero(hit)
            places = places[(places - starts[np.searchsorted(starts, places, side="right") - 1]) % 2 == 0]
            ids[places] = self.made[least]
            ids = np.delete(ids, places + 1)
        return self.merged(ids.tolist())

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded halves of one piece."""
        if not left or not right:
            return left or right
        width = 1
        while True:
            head, tail = left[-width:], right[:width]
            window = self.merged(self.expand(head) + self.expand(tail))
            left_agrees = width >= len(left) or window[0] == head[0]
            if left_agrees and (width >= len(right) or window[-1] == tail[-1]):
                return left[:-width] + window + right[width:]
            width *= 2

    def tree(self, halves: list[list[int]]) -> list[int]:
        """Encoded neighbours joined in pairs until one is left."""
        while len(halves) > 1:
            pairs = [self.join(*halves[i : i + 2]) for i in range(0, len(halves) - 1, 2)]
            halves = pairs + halves[len(pairs) * 2 :]
        return halves[0] if halves else []

    def encode(self, piece: str, ends: bool = True) -> list[int]:
        symbols = self.symbols(piece, ends)
        return self.tree([self.merged(symbols[i : i + LEAF]) for i in range(0, len(symbols), LEAF)])


class Words(dict):
    """Texts to ids. Ids of words between white space are remembered up to a bound, as most words return."""

    def __init__(self, tokenizer: str):
        super().__init__()
        data = json.loads(tokenizer)
        self.library = Tokenizer.from_str(tokenizer)
        self.merges = Merges(data["model"])
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or SPLIT.fullmatch(t["content"]) is None for t in data["added_tokens"]):
            raise ValueError("added tokens must be literal and without white space")
        if data.get("post_processor") or data.get("decoder"):
            raise ValueError("only files without post-processor and decoder are supported")
        self.known_pieces: dict[str, list[int]] = {}
        self.plain = is_plain(data)
        self.spelling = _byte_alphabet()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.literal = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        spelled = {i: t for t, i in (self.merges.vocabulary | self.added).items()}
        self.by_id = [spelled.get(i, "").encode() for i in range(max(spelled, default=-1) + 1)]

    def pieces(self, text: str) -> Iterator[str]:
        """Spelled pieces; an added token is a piece of its own, which no other piece can be spelled like."""
        if self.plain and PLAIN.fullmatch(text) and not (self.literal and self.literal.search(text)):
            for piece in PLAIN_PIECE.findall(text.lower()):
                yield piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
            return
        for part in self.literal.split(text) if self.literal else [text]:
            if part in self.added:
                yield part
            elif part:
                normal = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    if piece:
                        yield piece

    def piece(self, piece: str) -> list[int]:
        if piece in self.added:
            return [self.added[piece]]
        known = self.known_pieces.get(piece)
        if known is None:
            known = self.merges.encode(piece)
            if len(piece) <= CACHED_SYMBOLS:
                if len(self.known_pieces) >= CACHED_PIECES:
                    self.known_pieces.clear()
                self.known_pieces[piece] = known
        return known

    def __missing__(self, word: str) -> bytes:
        ids = [token for piece in self.pieces(word) for token in self.piece(piece)]
        out = np.array(ids, dtype="<u4").tobytes()
        if len(word) <= CACHED_SYMBOLS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, SPLIT.findall(text))) if text else b""

    def decode(self, ids: bytes) -> bytes:
        """As the library decodes without a decoder: spelled tokens with a blank between them, in UTF-8."""
        return b" ".join(map(self.by_id.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def slices(self, text: str, size: int) -> Iterator[tuple[str, bool]]:
        """Pieces with blanks between them, up to ``size`` symbols; whether the last one goes on in the next slice."""
        held, room = [], size
        for word in SPLIT.findall(text):
            for piece in self.pieces(word):
                while len(piece) > room and piece not in self.added:
                    if room == size or len(piece) > size:  # pieces longer than a slice fill the one before
                        yield " ".join([*held, piece[:room]]), True
                        piece = piece[room:]
                    else:
                        yield " ".join(held), False
                    held, room = [], size
                held.append(piece)
                room = max(1, room - len(piece))
        if held:
            yield " ".join(held), False

    def slice(self, text: str, goes_on: bool, from_before: bool) -> tuple[list[int], int, int]:
        """Ids of a slice; how many of them are of the piece that came from before, and of the one that goes on."""
        pieces = text.split(" ")
        found = [self.merges.encode(p, ends=False) if goes_on and n == len(pieces) - 1 else self.piece(p) for n, p in enumerate(pieces)]
        return [t for ids in found for t in ids], len(found[0]) * from_before, len(found[-1]) * goes_on

    def joined(self, slices: Sequence[tuple[list[int], int, int]]) -> list[int]:
        """Ids of a document from those of its slices, in order."""
        out, open_parts = [], []
        for ids, first, last in slices:
            if first and last and first == len(ids):  # all of the slice is the inside of one piece
                open_parts.append(ids)
                continue
            if first:
                out += self.merges.tree([*open_parts, ids[:first]])
                open_parts = []
            out += ids[first : len(ids) - last]
            if last:
                open_parts = [ids[len(ids) - last :]]
        return out


#: One encoder per Python worker and tokenizer: workers are reused, and so are the words they know.
WORDS: dict[str, Words] = {}


def words(tokenizer: str) -> Words:
    key = hashlib.sha256(tokenizer.encode()).hexdigest()
    if key not in WORDS:
        WORDS.clear()
        WORDS[key] = Words(tokenizer)
    return WORDS[key]


def _result(own: Words, ids: bytes) -> tuple:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest(), ids


def round_trip(docs: DataFrame, tokenizer_file: str, with_ids: bool = False, long_text: int = LONG_TEXT, slice_size: int = SLICE) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids (little-endian 32-bit) and of the decoded text; if asked for, the ids.

    The tokenizer file is read by the driver. ``long_text`` and ``slice_size`` say how work is dealt, not what comes out.
    """
    spark = docs.sparkSession
    ship(spark)
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_file).read_text())
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 if with_ids else 3]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
    rows = only(docs, doc_id="doc_id", text="text")
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def table(doc_ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([f[n] for f in found], kinds[n]) for n in range(len(names))]
        return pa.record_batch([doc_ids, *columns], names=["doc_id", *names])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(tokenizer.value)
        for batch in batches:
            yield table(batch.column("doc_id"), [_result(own, own.encode(t)) for t in batch.column("text").to_pylist()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(tokenizer.value)
        for batch in batches:
            for n, text in enumerate(batch.column("text").to_pylist()):
                parts = [*own.slices(text, slice_size)] or [("", False)]
                doc_ids = pa.concat_arrays([batch.column("doc_id").slice(n, 1)] * len(parts))
                digest = hashlib.sha256(text.encode()).digest()
                yield pa.record_batch(
                    [doc_ids, pa.array([digest] * len(parts)), pa.array(range(len(parts)), pa.int64()), pa.array([p for p, _ in parts]),
                     pa.array([on for _, on in parts]), pa.array([False, *[on for _, on in parts[:-1]]])],
                    names=["doc_id", "digest", "place", "pieces", "goes_on", "from_before"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(tokenizer.value)
        for batch in batches:
            asked = zip(*[batch.column(c).to_pylist() for c in ("pieces", "goes_on", "from_before")])
            found = [own.slice(*a) if a[0] else ([], 0, 0) for a in asked]
            made = [pa.array([np.array(ids, dtype="<u4").tobytes() for ids, _, _ in found], pa.binary())]
            made += [pa.array([f[n] for f in found], pa.int64()) for n in (1, 2)]
            yield pa.record_batch([*[batch.column(c) for c in ("doc_id", "digest", "place")], *made], names=["doc_id", "digest", "place", "ids", "first", "last"])

    def join(group: pa.Table) -> pa.Table:
        own = words(tokenizer.value)
        found, copies = {}, 0
        for place, ids, first, last in zip(*[group.column(c).to_pylist() for c in ("place", "ids", "first", "last")]):
            copies += place == 0
            found.setdefault(place, (np.frombuffer(ids, dtype="<u4").tolist(), first, last))
        ids = np.array(own.joined([found[place] for place in sorted(found)]), dtype="<u4").tobytes()
        doc_ids = pa.concat_arrays([group.column("doc_id").combine_chunks().slice(0, 1)] * copies)
        return pa.Table.from_batches([table(doc_ids, [_result(own, ids)] * copies)])

    long = F.coalesce(F.char_length("text") > long_text, F.lit(False))
    slices = rows.filter(long).mapInArrow(
        cut, f"doc_id {id_kind}, digest binary, place long, pieces string, goes_on boolean, from_before boolean"
    ).repartition("digest", "place")
    encoded = slices.mapInArrow(encode, f"doc_id {id_kind}, digest binary, place long, ids binary, first long, last long")
    of_long = encoded.groupBy("doc_id", "digest").applyInArrow(join, schema)
    return rows.filter(~long).mapInArrow(whole, schema).unionByName(of_long)


def encode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit) of every whole text."""
    return round_trip(docs, tokenizer_file, with_ids=True).select("doc_id", "ids")
