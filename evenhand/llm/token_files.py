"""Token ids in binary files with a shared zstandard dictionary and an offset index.

A file holds the documents of one range of doc_id in ascending order:

    magic b"EHTOK1\\0\\0", id width (1 byte), SHA-256 of the dictionary (32 bytes)
    one zstandard frame per document, over its ids as little-endian integers of that width
    index, one record per document: doc_id int64, offset uint64, frame length uint32, tokens uint64, whether it has an id uint8
    footer: offset of the index uint64, documents uint64, magic

A document is read by its index record alone: one frame, one shared dictionary. The dictionary is trained on the
serialized ids of a bounded, documented sample (``sample`` documents by a hash of their id, of each the first
SAMPLE_CHARS characters); it changes the size of the files and nothing else. Files have names of their own per task
attempt, and the manifest, a Parquet table that Spark commits, lists those that count: a lost executor or a repeated
attempt leaves at most a file that nobody reads.

Defined results: a null or empty text is one document of the end id alone; a null doc_id comes first and is read back
as null; added tokens spelled out in a text are their ids, as the library has them by default; repeated rows are
repeated, ordered by a hash of their text; an empty table gives no file and no row; very long texts are encoded in
pieces at white space and compressed as one frame; further columns are ignored.

The pieces at white space are exact for a tokenizer file with the normalizer and split that ``PLAIN_NORMALIZER`` and
``PLAIN_SPLIT`` state; with any other file whole texts go through the library. Texts of plain characters are taken in
groups: arrays tell their parts apart, and each different part of a group is looked up once.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from evenhand.llm.common import only, ship
from evenhand.session import shared_path

MAGIC = b"EHTOK1\0\0"
HEADER = "<8sB32s"
RECORD = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("tokens", "<u8"), ("has_id", "u1")])
FOOTER = "<QQ8s"
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 112_640
#: Words and parts that a Python worker remembers, and characters of texts that are taken together.
CACHED = 1_000_000
GROUP = 4_000_000

#: White space that ends a word for the tokenizer's normalizer, whatever stands beside it.
SPLIT = re.compile(r"[^ \n\t\r]+")
#: Words of which lower case and composed form are beyond doubt; others take the library's whole path.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PLAIN_TEXT = re.compile(r"[!-~À-ÖØ-öø-ÿ \n\t\r]*")
#: What a byte of a plain lower-case text in Latin-1 is.
SPACE, LETTER, DIGIT, OTHER = range(4)
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[ord("!") : ord("~") + 1] = OTHER
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[[*range(ord("a"), ord("z") + 1), *range(ord("ß"), ord("ö") + 1), *range(ord("ø"), ord("ÿ") + 1)]] = LETTER
#: The normalizer and the split that words of a text take apart from each other.
PLAIN_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PLAIN_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def is_plain(tokenizer: dict) -> bool:
    """Whether a tokenizer file has that normalizer and split, and added tokens that are literal and without white space."""
    literal = all(
        not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) and SPLIT.fullmatch(t["content"]) for t in tokenizer["added_tokens"]
    )
    return literal and tokenizer["normalizer"] == PLAIN_NORMALIZER and tokenizer["pre_tokenizer"] == PLAIN_SPLIT


class WordEncoder(dict):
    """Words to serialized ids by the tokenizers library, remembered up to a bound.

    The tokenizer's normalizer turns white space into blanks and its pattern never joins across them, so a text is
    encoded word by word. For plain words the normalizer and the pattern are applied here and the library's model
    gets each part once; all other words, and those with an added token, go through the library as they are.
    """

    def __init__(self, tokenizer: str, width: int):
        super().__init__()
        data = json.loads(tokenizer)
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.plain = is_plain(data)
        self.added = re.compile("|".join(re.escape(t["content"]) for t in data["added_tokens"]) or "(?!)")
        self.kind = f"<u{width}"
        self.parts: dict[bytes, bytes] = {}
        # The pattern of this tokenizer, for plain lower-case words in Latin-1.
        self.pattern = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9]+")
        self.bytes_as_text = _byte_alphabet()

    def _part(self, part: bytes) -> bytes:
        known = self.parts.get(part)
        if known is None:
            spelled = part.decode() if part.isascii() else part.decode("latin-1").encode().decode("latin-1").translate(self.bytes_as_text)
            known = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], dtype=self.kind).tobytes()
            if len(part) < 64:
                self.parts[part] = known
        return known

    def _parts(self, word: bytes) -> bytes:
        return b"".join(map(self._part, self.pattern.findall(word)))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def __missing__(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and not self.added.search(word):
            ids = self._parts(word.lower().encode("latin-1"))
        else:
            ids = self._whole(word)
        if len(word) < 64:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain:
            return self._whole(text)
        self._bound()
        return b"".join(map(self.__getitem__, SPLIT.findall(text)))

    def _bound(self) -> None:
        if len(self) + len(self.parts) > CACHED:
            self.clear()
            self.parts.clear()

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """What ``encode`` gives for every text, in order. Only the ids of one group are held at a time."""
        group, size = [], 0
        for text in texts:
            if size + len(text or "") > GROUP:
                yield from self._group(group)
                group, size = [], 0
            group.append(text or "")
            size += len(text or "")
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self.plain and len(t) <= GROUP and PLAIN_TEXT.fullmatch(t) is not None and not self.added.search(t) for t in texts]
        by_arrays = iter(self._plain([t for t, p in zip(texts, plain) if p]))
        return (next(by_arrays) if p else self.encode(t) for t, p in zip(texts, plain))

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts. Parts lie between changes of kind; an apostrophe alone keeps the letters after it for the pattern."""
        self._bound()
        data = np.frombuffer("\n".join([*texts, ""]).lower().encode("latin-1"), dtype=np.uint8)
        if not len(data):
            return []
        kinds = KINDS[data]
        begins = np.ones(len(data) + 1, dtype=bool)
        begins[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        at = np.flatnonzero(data == ord("'"))
        begins[at[begins[at] & begins[at + 1] & (kinds[at + 1] == LETTER)] + 1] = False
        bounds = np.flatnonzero(begins).astype(np.int32)
        shown = kinds[bounds[:-1]] != SPACE
        parts = pa.Array.from_buffers(pa.binary(), len(shown), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        found = parts.filter(pa.array(shown)).dictionary_encode()
        known = self.parts
        ids = [known.get(part) or self._parts(part) for part in found.dictionary.to_numpy(zero_copy_only=False)]
        # Ids of the different parts side by side, and from them those of all parts in their order.
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join([*ids, bytes(8)]), dtype=self.kind)
        sizes //= flat.itemsize
        places = found.indices.to_numpy()
        n = sizes[places]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat((np.cumsum(sizes) - sizes)[places] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        # A text ends before its line feed.
        after = np.cumsum([len(t) + 1 for t in texts])
        upto = ends[np.searchsorted(bounds[:-1][shown], after)] * flat.itemsize
        return [out[start:end] for start, end in zip([0, *upto[:-1].tolist()], upto.tolist())]


def _byte_alphabet() -> dict[int, str]:
    """Byte-level spelling: printable Latin-1 stands for itself, all other bytes take the letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: One encoder per Python worker and tokenizer: workers are reused, and so are the words they know.
ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(tokenizer: str, width: int) -> WordEncoder:
    key = hashlib.sha256(tokenizer.encode()).hexdigest(), width
    if key not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[key] = WordEncoder(tokenizer, width)
    return ENCODERS[key]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else Path(path).absolute().as_uri())


def train_dictionary(docs: DataFrame, tokenizer: str, width: int, end_id: int, sample: int = 1_000) -> bytes:
    """A zstandard dictionary over serialized ids of a bounded sample; empty where the sample is too small for one."""
    ship(docs.sparkSession)
    some = (
        only(docs, doc_id="doc_id", text="text").filter(F.col("text") != "")
        .select(F.xxhash64("doc_id", F.lit("dictionary")).alias("place"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .orderBy("place", F.xxhash64("text")).limit(sample)
    )

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_encoder(tokenizer, width)
        for batch in batches:
            yield pa.record_batch([pa.array(list(words.encode_all(batch.column("text").to_pylist())), pa.binary())], names=["ids"])

    samples = [bytes(row.ids) for row in some.select("text").mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=1, dict_data=shared, write_checksum=False, write_dict_id=False)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = 1, sample: int = 1_000) -> DataFrame:
    """Write the files, the dictionary and the manifest (shard, file, n_docs, n_tokens) under ``folder``; the manifest."""
    spark = docs.sparkSession
    ship(spark)
    tokenizer = Path(tokenizer_file).read_text()
    width = 2 if Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, width, end_id, sample)
    name = hashlib.sha256(dictionary).digest()
    store, top = _filesystem(folder)
    store.create_dir(top, recursive=True)
    with store.open_output_stream(f"{top}/dictionary-{name.hex()}.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast((tokenizer, dictionary))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_tokenizer, own_dictionary = shared.value
        words, compressor = word_encoder(own_tokenizer, width), _compressor(own_dictionary)
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        out, index, offset, file = None, [], 0, ""
        own_store, own_top = _filesystem(folder)
        for batch in batches:
            for doc_id, own_ids in zip(batch.column("doc_id").to_pylist(), words.encode_all(batch.column("text").to_pylist())):
                if out is None:
                    file = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                    out = own_store.open_output_stream(f"{own_top}/{file}")
                    out.write(struct.pack(HEADER, MAGIC, width, name))
                    offset = struct.calcsize(HEADER)
                ids = own_ids + end
                frame = compressor.compress(ids)
                out.write(frame)
                index.append((doc_id or 0, offset, len(frame), len(ids) // width, doc_id is not None))
                offset += len(frame)
        if out is not None:
            records = np.array(index, dtype=RECORD)
            out.write(records.tobytes())
            out.write(struct.pack(FOOTER, offset, len(records), MAGIC))
            out.close()
            yield pa.record_batch(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([file]),
                    pa.array([len(records)], pa.int64()), pa.array([int(records["tokens"].sum())], pa.int64()),
                ],
                names=["shard", "file", "n_docs", "n_tokens"],
            )

    rows = only(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    ranges = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ranges.mapInArrow(put, "shard int, file string, n_docs long, n_tokens long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class TokenFile:
    """One file: its index, and documents by their place in it."""

    def __init__(self, store: pafs.FileSystem, path: str, dictionary: bytes):
        self.source = store.open_input_file(path)
        size = self.source.size()
        start, n, magic = struct.unpack(FOOTER, self.source.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        first, self.width, name = struct.unpack(HEADER, self.source.read_at(struct.calcsize(HEADER), 0))
        if magic != MAGIC or first != MAGIC or name != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no token file of this dictionary")
        self.index = np.frombuffer(self.source.read_at(n * RECORD.itemsize, start), dtype=RECORD)
        self.decompressor = _decompressor(dictionary)

    def ids(self, place: int) -> np.ndarray:
        record = self.index[place]
        frame = self.source.read_at(int(record["length"]), int(record["offset"]))
        size = int(record["tokens"]) * self.width
        return np.frombuffer(self.decompressor.decompress(frame, max_output_size=size), dtype=f"<u{self.width}")


def read_dictionary(folder: str, file: str) -> bytes:
    """The dictionary that a file of the folder names in its header."""
    store, top = _filesystem(folder)
    with store.open_input_file(f"{top}/{file}") as source:
        name = struct.unpack(HEADER, source.read_at(struct.calcsize(HEADER), 0))[2]
    with store.open_input_file(f"{top}/dictionary-{name.hex()}.zdict") as source:
        return source.read()


def read(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids from the files.

    The running sum has one part because it runs over files, one row each.
    """
    spark = manifest.sparkSession
    ship(spark)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("start"))
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _filesystem(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                tokens = TokenFile(store, f"{top}/{file}", read_dictionary(folder, file))
                for first in range(0, len(tokens.index), 2_000):
                    part = tokens.index[first : first + 2_000]
                    all_ids = [tokens.ids(place) for place in range(first, first + len(part))]
                    n = np.array([len(ids) for ids in all_ids], dtype=np.int64)
                    doc_id = part["doc_id"].astype(np.int64)
                    made = [
                        pa.array(doc_id, mask=part["has_id"] == 0), pa.array(start + np.cumsum(n) - n), pa.array(n),
                        pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in all_ids], pa.int64()),
                    ]
                    if with_ids:
                        made.append(pa.array([ids.astype(np.int64) for ids in all_ids], pa.list_(pa.int64())))
                    start += int(n.sum())
                    yield pa.record_batch(made, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(made)])

    count = max(1, manifest.count())
    return files.repartition(count).mapInArrow(get, columns)


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int = 1) -> DataFrame:
    """Write all documents to a fresh folder of the shared store and read them back."""
    folder = shared_path(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer_file, end_id), folder)
