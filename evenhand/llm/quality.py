"""Quality rules by tokeniser fertility, after a few counts that need no tokeniser.

Words are encoded one by one with a public sentencepiece vocabulary. Three measures per document: code points in
words per token, the share of tokens that are single fallback bytes, and the entropy of the tokens in bits. A fourth
tells shouted text: tokens divided by the tokens of the same words in lower case. Each has a band per language, or per
script where the language has none; a document outside a band is rejected, unless it has too few tokens for the
measure to mean anything.

Bands come from all documents that pass the base rules, exact copies counted once: FENCE times the spread of the
middle half beyond its lower end (characters per token, entropy) or upper end (case). The middle half stands where it
is until a quarter of a language is junk, which a small percentile would not, and the tail beyond is not a fixed share:
a corpus of prose alone loses next to nothing. The fixed values hold for languages with fewer than LEAST_DOCUMENTS
documents and are never widened by the corpus, so one that is mostly junk does not let it in. The most characters per token and the
most bytes are fixed: beyond them lies text that the vocabulary knows better or a few foreign symbols, not junk that
this corpus could tell. Quartiles are exact, of values in steps of a thousandth, so a large group is a short table.
Texts are encoded once; their measures are written and read twice.

Defined results: a null or empty text has no words, which fails the base rules; an unknown or null language takes the
band of the script that most of its letters are in; ties go to the script that comes first; repeated rows repeat; an
empty table gives an empty table; very long texts are encoded word by word as all others; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import only, ship, written

CACHED_WORDS = 500_000
WINDOW = 5
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

#: Fixed values: (least, most) characters per token, most byte share, least entropy for 100 tokens and more. Least
#: values of the four languages lie below the prose of documents at sf0.1 (all but 7 of 5,508 texts in en, 5 of 1,360 in
#: de, 2 of 858 in es and 2 of 1,371 in fr) and far below a sentence of real text (2.8 to 4.1), above random letters (1.58).
BANDS_BY_LANGUAGE = {
    "en": ((1.85, 7.0), 0.20, 4.0),
    "de": ((1.85, 7.0), 0.20, 4.0),
    "es": ((1.6, 7.0), 0.20, 4.0),
    "fr": ((1.6, 7.0), 0.20, 4.0),
}
BANDS_BY_SCRIPT = {
    "Latin": ((1.3, 8.0), 0.30, 3.5),
    "Cyrillic": ((1.0, 6.0), 0.30, 2.0),
    "Greek": ((0.7, 5.0), 0.40, 2.0),
    "Arabic": ((0.7, 5.0), 0.40, 2.0),
    "Hebrew": ((0.7, 5.0), 0.40, 2.0),
    "Devanagari": ((0.2, 4.0), 0.90, 2.0),
    "Han": ((0.2, 3.0), 0.90, 2.0),
    "Hiragana": ((0.2, 3.0), 0.90, 2.0),
    "Hangul": ((0.2, 3.0), 0.90, 2.0),
}
OTHER = "other"
OTHER_BAND = ((0.2, 8.0), 1.0, 2.0)
BANDS = {**BANDS_BY_LANGUAGE, **BANDS_BY_SCRIPT, OTHER: OTHER_BAND}
#: Most tokens for each token of the text in lower case. Prose of documents has up to 1.03, shouted prose 1.04 and more.
MOST_CASE = 1.25
FENCE = 5
#: Least spread of the middle half, as a share of its lower end: near copies alone would make it nothing.
LEAST_SPREAD = {"chars_per_token": 0.025, "entropy": 0.025, "case": 0.008}
LEAST_DOCUMENTS = 50
LEAST_TOKENS = 30
LEAST_TOKENS_ENTROPY = 100
SCRIPTS = {name: regex.compile(rf"\p{{Script={name}}}") for name in BANDS_BY_SCRIPT}


class Words(dict):
    """Place of a word in the tables of what is known about its tokens."""

    def __init__(self, model: bytes):
        super().__init__()
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.processor.get_piece_size()
        self.is_byte = np.array([self.processor.is_byte(i) for i in range(n)], dtype=bool)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.tokens: list[bytes] = []
        self.lower: list[int] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.tokens)
        text = word.decode()
        ids = self.processor.encode(text)
        small = text.lower()
        self.tokens.append(np.array(ids, dtype="<u4").tobytes())
        self.lower.append(len(ids) if small == text else len(self.processor.encode(small)))
        return place


#: One table per Python worker and model: workers are reused, and so are the words they know.
TABLES: dict[str, Words] = {}


def words_table(model: bytes) -> Words:
    key = hashlib.sha256(model).hexdigest()
    if key not in TABLES:
        TABLES.clear()
        TABLES[key] = Words(model)
    return TABLES[key]


def repeated_words(places: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more; ``places`` are equal where the words are."""
    n = len(places) - window + 1
    if n < 2:
        return 0
    # Windows are numbered exactly: pairs of numbers are renumbered until a number stands for a window.
    number = np.unique(places, return_inverse=True)[1].astype(np.int64)
    key = number[:n]
    for step in range(1, window):
        key = np.unique(key * np.int64(len(places)) + number[step : step + n], return_inverse=True)[1].astype(np.int64)
    often = np.bincount(key)[key] > 1
    covered = np.zeros(len(places) + 1, dtype=np.int64)
    starts = np.flatnonzero(often)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.translate(None, SPACE)]
    return len(lines) - len(set(lines))


def band_of(lang: str | None, text: str) -> str:
    if lang in BANDS_BY_LANGUAGE:
        return lang
    letters = {name: len(pattern.findall(text)) for name, pattern in SCRIPTS.items()}
    best = max(letters, key=letters.get)
    return best if letters[best] else OTHER


def measure(table: Words, text: str | None, lang: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_tokens, chars_per_token, byte_share,
    entropy, case, band. The last is the name of the band, none if no band applies."""
    data = (text or "").encode()
    words = data.split()
    if len(table) > CACHED_WORDS:
        table.reset()
    places = np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))
    blanks = len(data) - len(data.translate(None, SPACE))
    word_chars = len(text or "") - blanks
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeats = repeated_words(places)
    failed = len(words) < 10 or 100 * repeats > 20 * len(words)
    ids = np.frombuffer(b"".join(map(table.tokens.__getitem__, places.tolist())), dtype="<u4")
    n = len(ids)
    per_token = byte_share = entropy = case = band = None
    if n:
        shares = np.unique(ids, return_counts=True)[1] / n
        per_token = round(word_chars / n, 6)
        byte_share = round(float(table.is_byte[ids].sum()) / n, 6)
        entropy = round(abs(float((shares * np.log2(shares)).sum())), 6)
        small = sum(map(table.lower.__getitem__, places.tolist()))
        case = round(n / small, 6) if small else None
    if not failed and n >= LEAST_TOKENS:
        band = band_of(lang, text or "")
    return len(words), word_chars, symbols, duplicate_lines(data), repeats, failed, n, per_token, byte_share, entropy, case, band


COLUMNS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "n_tokens": pa.int64(), "chars_per_token": pa.float64(),
    "byte_share": pa.float64(), "entropy": pa.float64(), "case": pa.float64(), "band": pa.string(),
}


def fences(measures: DataFrame) -> dict[tuple[str, str], float]:
    """The lower fence of characters per token and of entropy and the upper one of case, by band and measure, where
    enough documents have them."""
    long_enough = F.when(F.col("n_tokens") >= LEAST_TOKENS_ENTROPY, F.col("entropy"))
    values = [F.col("chars_per_token"), long_enough, F.col("case")]
    single = measures.filter("band IS NOT NULL").select("band", "n_words", "word_chars", "n_tokens", "entropy", *values[::2])
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), F.round(v, 3).alias("value")) for k, v in zip(LEAST_SPREAD, values)])
    steps = single.distinct().select("band", F.inline(pairs)).filter("value IS NOT NULL").groupBy("band", "measure", "value").count()
    found = steps.groupBy("band", "measure").agg(
        F.sum("count").alias("n"), F.percentile("value", [0.25, 0.75], F.col("count")).alias("middle")
    )
    out = {}
    for r in found.filter(F.col("n") >= LEAST_DOCUMENTS).collect():
        low, high = r.middle
        reach = FENCE * max(high - low, LEAST_SPREAD[r.measure] * low)
        out[r.band, r.measure] = high + reach if r.measure == "case" else low - reach
    return out


def within(found: dict[tuple[str, str], float]) -> Column:
    """Whether a row of measures lies in all bands that apply to it."""
    inside = F.when(F.col("band").isNull(), True)
    for name, ((least, most), most_bytes, least_entropy) in BANDS.items():
        least = max(least, found.get((name, "chars_per_token"), least))
        least_entropy = max(least_entropy, found.get((name, "entropy"), least_entropy))
        most_case = min(MOST_CASE, found.get((name, "case"), MOST_CASE))
        inside = inside.when(
            F.col("band") == name,
            F.col("chars_per_token").between(least, most) & (F.col("byte_share") <= most_bytes) & (F.col("case") <= most_case)
            & ((F.col("n_tokens") < LEAST_TOKENS_ENTROPY) | (F.col("entropy") >= least_entropy)),
        )
    return ~F.col("base_failed") & inside


def judge(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the measures of every row. The model file is read by the driver."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(Path(model_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words_table(model.value)
        for batch in batches:
            rows = [measure(table, *row) for row in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist())]
            made = [pa.array(values, kind) for values, kind in zip(zip(*rows), COLUMNS.values())] if rows else []
            if rows:
                yield pa.record_batch([batch.column("doc_id"), *made], names=["doc_id", *COLUMNS])

    rows = only(docs, doc_id="doc_id", text="text", lang="lang").withColumn("lang", F.col("lang").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double", pa.string(): "string"}
    columns = f"doc_id {kind}, " + ", ".join(f"`{name}` {names[kind]}" for name, kind in COLUMNS.items())
    measures = written(rows.mapInArrow(run, columns), "fertility")
    return measures.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        within(fences(measures)).alias("kept"), "n_tokens", "chars_per_token", "byte_share", "entropy",
    )
