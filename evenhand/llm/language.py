r"""Language of whole texts: known words by log frequency, unseen words by ever shorter character n-grams.

The model is fitted on a bounded, documented sample of labelled rows (``max_docs`` documents by a hash of their id: all
of a language that has few, as many as of any other of one that has more). Of those it keeps ``max_words`` words and ``max_grams``
n-grams, the most frequent of each language in turn, with one log frequency per language; None keeps all. So a rare
language keeps its documents and its share of the words, however large the corpus is. The sample bounds the model, so
it is broadcast; prediction is one pass without a shuffle. Spark counts words first and cuts each distinct word into
n-grams once, with its count as weight.

Words are runs of letters (``\p{L}``), so digits of any kind, as superscripts and Roman numerals of one character, are none.

A known word scores its log frequency in each language. An unseen word scores the mean over its longest n-grams of
which at least one is known, n from 4 down to 1; a word without any known n-gram scores the same in all languages.
A text's languages are compared by the mean over its words; ``score`` is the share of the best one after a softmax
of that mean times at most EVIDENCE words.

Defined results: null texts, texts without letters and all texts of a model without languages are "und" with score
0; ties go to the language that is first by name; rows with the same id or text are told apart by nothing and answer
alike; an empty table gives an empty table; further columns are ignored by ``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evenhand.llm.common import only, ship, written

UNKNOWN = "und"
LONGEST = 4
EVIDENCE = 8
CACHED_WORDS = 250_000
ASCII_LETTERS = re.compile(r"[a-z]+")
LETTERS = regex.compile(r"\p{L}+")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the quarter that nothing is learned from; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    lower = text.lower()
    return ASCII_LETTERS.findall(lower) if lower.isascii() else LETTERS.findall(lower)


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(max(1, len(marked) - n + 1))]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[tuple, int] = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, n in Counter(words_of(text)).items():
                seen[word, lang] += n
        if seen:
            words, langs = zip(*seen)
            yield pa.record_batch([pa.array(words), pa.array(langs), pa.array(list(seen.values()), pa.int64())], names=["word", "lang", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (size 0) and their n-grams, from words with their counts."""
    for batch in batches:
        seen: dict[tuple, int] = Counter()
        for word, lang, n in zip(*[batch.column(c).to_pylist() for c in ("word", "lang", "n")]):
            seen[0, word, lang] += n
            for size in range(1, LONGEST + 1):
                for gram in grams_of(word, size):
                    seen[size, gram, lang] += n
        if seen:
            size, gram, lang = zip(*seen)
            yield pa.record_batch(
                [pa.array(size, pa.int32()), pa.array(gram, pa.string()), pa.array(lang, pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["size", "gram", "lang", "n"],
            )


class Model:
    """Log frequencies by size (0: words) and gram, one per language: places of grams in a matrix per size."""

    def __init__(self, languages: list[str], rows: list[tuple[int, str, dict[str, int]]]):
        self.languages = languages
        self.tables: list[dict[str, int]] = []
        self.logs: list[np.ndarray] = []
        for size in range(LONGEST + 1):
            own = [(gram, by) for s, gram, by in rows if s == size]
            counts = np.array([[by.get(lang, 0) for lang in languages] for _, by in own], dtype=float).reshape(len(own), len(languages))
            self.tables.append({gram: place for place, (gram, _) in enumerate(own)})
            self.logs.append(np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(own))) if own else counts)

    def vector(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        if known is not None:
            return self.logs[0][known]
        for size in range(LONGEST, 0, -1):
            table = self.tables[size]
            found = [table[gram] for gram in grams_of(word, size) if gram in table]
            if found:
                return self.logs[size][found].mean(axis=0)
        return np.zeros(len(self.languages))


class Reader(dict):
    """Rows of word scores, kept by word up to a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.zeros((4096, max(1, len(model.languages))))

    def __missing__(self, word: str) -> int:
        place = len(self)
        if place == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[place] = self.model.vector(word)
        self[word] = place
        return place

    def read(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        if len(self) > CACHED_WORDS:
            self.clear()
        total = np.zeros(len(self.model.languages))
        for start in range(0, len(words), 100_000):  # a very long text is added up in pieces
            places = np.fromiter(map(self.__getitem__, words[start : start + 100_000]), dtype=np.int64)
            total += self.rows[places].sum(axis=0)
        mean = total / len(words)
        best = int(np.argmax(mean))
        share = 1.0 / np.exp((mean - mean[best]) * min(len(words), EVIDENCE)).sum()
        return self.model.languages[best], round(float(share), 6)


def sample_level(sizes: list[int], most: int) -> float:
    """The number of documents a language at which all of them together give ``most``, or all they have."""
    left = float(most)
    for place, n in enumerate(sorted(sizes)):
        fair = left / (len(sizes) - place)
        if n > fair:
            return fair
        left -= n
    return float(max(sizes, default=0))


def fit(docs: DataFrame, max_docs: int = 8_000, max_words: int | None = 60_000, max_grams: int | None = 120_000) -> Model:
    """Fit on at most about ``max_docs`` labelled documents that are not held out; word counts are summed by Spark.

    Shares are sent as a table of languages, so that their number is not limited by the plan.
    """
    ship(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text", lang="lang").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    level = sample_level(list(sizes.values()), max_docs)
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, level / n)) for k, n in sizes.items()], "lang string, share double")
    rows = rows.join(F.broadcast(shares), "lang")
    rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    words = rows.select("lang", "text").mapInArrow(_count_words, "word string, lang string, n long")
    words = words.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    counted = words.mapInArrow(_count_grams, "size int, gram string, lang string, n long")
    counted = counted.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    in_turn = Window.partitionBy(F.col("size") == 0, "lang").orderBy(F.desc("n"), "size", "gram")
    counted = (
        counted.withColumn("turn", F.row_number().over(in_turn)).groupBy("size", "gram")
        .agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("n"), F.min("turn").alias("turn"))
    )
    counted = written(counted, "language-counts")  # read twice
    kinds = [(counted.filter(F.col("size") == 0), max_words), (counted.filter(F.col("size") > 0), max_grams)]
    top = [kind if most is None else kind.orderBy("turn", F.desc("n"), "size", "gram").limit(most) for kind, most in kinds]
    learned = [(r.size, r.gram, r.by) for r in top[0].union(top[1]).select("size", "gram", "by").toLocalIterator()]
    return Model(sorted({lang for _, _, by in learned for lang in by}), sorted(learned, key=lambda r: (r[0], r[1])))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Reader(shared.value)  # goes with its task: later stages in this worker need the memory
        for batch in batches:
            answers = [own.read(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = only(docs, doc_id="doc_id", text="text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """The rows whose text has a language with at least this score, with all their columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Reader(shared.value)  # goes with its task: later stages in this worker need the memory
        for batch in batches:
            answers = [own.read(text) for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in answers], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
