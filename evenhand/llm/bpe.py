"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece the table keeps the length of the one token that can end a valid encoding of that
prefix. A token ends prefix i if the prefix before it has an entry and the pair (its last token, this token) stays as
it is when the bytes of both are merged by rank; exactly one token does. Appending bytes therefore never changes an
entry, the encoding of any prefix is read off backwards, and after an edit only entries near it are made anew: as
soon as as many entries in a row as the longest token are the old ones, all later ones are too.

Texts are split by the pattern, and pieces are independent. Encodings of chunks between white space are remembered up
to a bound, as most words return.

Defined results: a null text is encoded as an empty one (no ids); a piece that is itself a token is that token, as
the public library has it; very long texts and pieces take time in proportion to their length; an empty table gives
an empty table; repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from evenhand.llm.common import only, ship

CACHED_PAIRS = 1_000_000
CACHED_PREFIXES = 600_000
SHARED_PREFIX = 9
CACHED_CHUNKS = 600_000
CACHED_PIECES = 300_000
#: A run of blanks and the run of other characters after it. No piece starts left and ends right of such a chunk's
#: edge as long as blank and line feed are the only white space.
CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")


class Vocabulary:
    """Token bytes and ranks, with the test for pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # Lengths of the tokens that end with three (or, where no such token is, two) given bytes.
        by_end: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                by_end.setdefault(token[-3:], {2} if token[-2:] in ranks else set()).add(len(token))
            elif len(token) == 2:
                by_end[token] = {2}
        self.lengths = {end: tuple(sorted(found, reverse=True)) for end, found in by_end.items()}
        self.prefixes: dict[bytes, int] = {}
        self.longest = max(map(len, ranks), default=0)
        self.stable: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        """From lines of a base64 token and its rank."""
        pairs = (line.split() for line in data.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition, for short byte strings: the adjacent pair of lowest rank is merged first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[part] for part in parts]

    def is_stable(self, token: int) -> bool:
        """Whether the token's own bytes merge to it."""
        known = self.stable.get(token)
        if known is None:
            known = self.stable[token] = self.merged(self.tokens[token]) == [token]
        return known

    def can_follow(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHED_PAIRS:
                self.pairs.clear()
            both = self.is_stable(left) and self.is_stable(right)
            known = both and self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[left, right] = known
        return known


class PrefixTable:
    """The bytes of one piece and, for each prefix, the last token of its encoding."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data)
        self.data += data
        whole = bytes(self.data) if start == 0 else None
        self._extend(start, whole)

    def _extend(self, start: int, whole: bytes | None = None) -> None:
        data = bytes(self.data) if whole is None else whole
        add, find, known = self.last.append, self._last, self.vocabulary.prefixes
        if len(known) > CACHED_PREFIXES:
            known.clear()
        for end in range(start + 1, len(data) + 1):
            if end <= SHARED_PREFIX:  # words share their beginnings, and an entry depends on its prefix alone
                prefix = data[:end]
                token = known.get(prefix)
                if token is None:
                    token = known[prefix] = find(data, end)
                add(token)
            else:
                add(find(data, end))

    def _last(self, data: bytes, end: int) -> int:
        """The last token of the first ``end`` bytes, from the entries of shorter prefixes."""
        vocabulary, last = self.vocabulary, self.last
        ranks, pairs, stable = vocabulary.ranks, vocabulary.pairs, vocabulary.stable
        sizes = vocabulary.lengths.get(data[end - 3 : end]) if end > 2 else None
        for size in sizes or (vocabulary.lengths.get(data[end - 2 : end], ()) if end > 1 else ()):
            if size > end:
                continue
            token = ranks.get(data[end - size : end])
            if token is None:
                continue
            if size == end:
                if stable[token] if token in stable else vocabulary.is_stable(token):
                    return token
                continue
            pair = last[end - size - 1], token
            if pairs[pair] if pair in pairs else vocabulary.can_follow(*pair):
                return token
        # No token of two or more bytes ends here.
        return ranks[data[end - 1 : end]]

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of the bytes from ``start`` to ``end``; the number of entries made anew."""
        old, tail = self.last, end
        shift = len(data) - (end - start)
        self.data[start:end] = data
        self.last = old[:start]
        whole, same = bytes(self.data), 0
        for place in range(start + 1, len(whole) + 1):
            entry = self._last(whole, place)
            self.last.append(entry)
            before = place - 1 - shift
            same = same + 1 if place > start + len(data) and before >= tail and old[before] == entry else 0
            if same >= self.vocabulary.longest:
                self.last += old[before + 1 :]
                return place - start
        return len(whole) - start

    def encode(self, end: int | None = None) -> list[int]:
        """The ids of the bytes before ``end``, by default of all."""
        place, out = len(self.data) if end is None else end, []
        while place:
            token = self.last[place - 1]
            out.append(token)
            place -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Encoder:
    """Texts to ids, as little-endian 32-bit integers, and back."""

    def __init__(self, ranks: bytes, pattern: str):
        self.vocabulary = Vocabulary.parse(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.chunks = _Chunks(self)
        size = max(self.vocabulary.tokens, default=-1) + 1
        self.by_id = [self.vocabulary.tokens.get(i, b"") for i in range(size)]

    def piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            data = piece.encode()
            rank = self.vocabulary.ranks.get(data)
            ids = [rank] if rank is not None else PrefixTable(self.vocabulary, data).encode()
            if len(self.pieces) > CACHED_PIECES:
                self.pieces.clear()
            known = np.array(ids, dtype="<u4").tobytes()
            if len(piece) < 64:
                self.pieces[piece] = known
        return known

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if OTHER_SPACE.search(text):
            return b"".join(map(self.piece, self.pattern.findall(text)))
        if len(self.chunks) > CACHED_CHUNKS:
            self.chunks.clear()
        return b"".join(map(self.chunks.__getitem__, CHUNK.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.by_id.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class _Chunks(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = b"".join(map(self.encoder.piece, self.encoder.pattern.findall(chunk)))
        if len(chunk) < 64:
            self[chunk] = ids
        return ids


#: One encoder per Python worker and vocabulary: workers are reused, and so are the words they know.
ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(ranks: bytes, pattern: str) -> Encoder:
    key = hashlib.sha256(ranks).hexdigest(), pattern
    if key not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[key] = Encoder(ranks, pattern)
    return ENCODERS[key]


def _over_texts(docs: DataFrame, ranks_file: str, pattern: str, make, columns: str) -> DataFrame:
    """Rows (doc_id, ...) that ``make`` gives from an encoder and a text. The vocabulary file is read by the driver."""
    spark = docs.sparkSession
    ship(spark)
    ranks = spark.sparkContext.broadcast(Path(ranks_file).read_bytes())
    arrow = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    kinds = {name: arrow[kind] for name, kind in (column.split() for column in columns.split(", "))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks.value, pattern)
        for batch in batches:
            made = [make(own, text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), *[pa.array([m[n] for m in made], kind) for n, kind in kinds.items()]], names=["doc_id", *kinds]
            )

    rows = only(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {columns}")


def encode(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit) of every whole text."""
    return _over_texts(docs, ranks_file, pattern, lambda own, text: {"ids": own.encode(text)}, "ids binary")


def _digests(own: Encoder, text: str | None) -> dict:
    ids = own.encode(text)
    return {
        "n_tokens": len(ids) // 4,
        "ids_sha256": hashlib.sha256(ids).hexdigest(),
        "decoded_sha256": hashlib.sha256(own.decode(ids)).hexdigest(),
        "ids": ids,
    }



def round_trip(docs: DataFrame, ranks_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them; if asked for, the ids too."""
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else "")
    return _over_texts(docs, ranks_file, pattern, _digests, columns)
