"""Repeated passages by column-wise construction of suffix order and common prefixes over many documents.

Every window of LENGTH bytes is filed under its anchor, the k-mer in it with the smallest hash. Equal windows have equal
anchors at equal places, so the stretches around equal anchors, laid on top of each other at the anchor, are a
collection in which equal windows stand in the same column. The collection is built column by column from the right:
each round inserts one symbol per stretch, sorts stably by it (the column of the Burrows-Wheeler transform) and renews
the common prefixes of neighbours. Neighbours with LENGTH common symbols are equal windows, and all of a run but the
smallest doc_id's are marked.

1. A pass over all texts counts anchors exactly by packed hash ranges and keeps one bit per range of hashes: in two
   documents or not (a bitmap of fixed size; a wrong bit costs work and no mark).
2. A second pass sends stretches around repeated anchors to their range. Stretches that are equal within a batch are
   settled there: all but the smallest doc_id's are marked at once, so a text that a third of all documents share
   costs one stretch per batch.
3. Anchors around which very many different stretches stand, such as a phrase shorter than LENGTH in a third of all
   documents, are no group: a third pass files each window of theirs apart under its own LENGTH bytes, takes the
   smallest doc_id by partial aggregation and joins it back. Windows equal within a batch are settled there, too.
4. Each range of the other stretches is built on its own. Its columns lie in a file that rounds read in sequence where
   they outgrow memory.
5. Marks are gathered per document; only texts that may have some are shuffled to them.

Defined results: null and empty texts and those shorter than LENGTH lose nothing; a null doc_id is neither smaller nor
larger than others, so its row loses nothing and takes nothing away; rows with equal doc_id take nothing from each
other; repeats within one text stay; an empty table gives an empty table; further columns are ignored by ``removed``
and kept by ``cleaned``. Very long texts are read in slices that overlap by a window.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import discard, only, passing_shuffles, ship, written
from evenhand.llm.ranges import frequency_bitmap, lookup_bitmap, lookup_place, marked, packed_rows, prefixes, range_bits, split_ranges
from evenhand.llm.shingles import BYTE_VALUES, INVERSE_POWERS, PLACES, POWERS, mixed

LENGTH = 50
ANCHOR = 24
COLUMNS = 2 * LENGTH - ANCHOR  # of a stretch, from LENGTH - ANCHOR before its anchor
LEFT = LENGTH - ANCHOR
BITMAP_BITS = 27
SLICE = 1 << 18
AT_ONCE = 4 << 20  # bytes of text whose rows are made at once
IN_MEMORY = 256 << 20
STEP = 16  # different stretches around an anchor in a batch that count as one more occurrence of it
HEAVY = 4096  # occurrences above which an anchor is no group; at most STEP times as many stretches are one
WINDOWS_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 1 << 14
NAMED = 1000  # ids of which several rows are told apart by name
DOCS_PER_RANGE = 2000  # their stretches, about 80 a document, are built together
POSITION = np.uint64(0xFFFFFF)


class Stretches:
    """Anchors of a run of documents: where their stretches begin and end, by document and place in it."""

    def __init__(self, texts: list[bytes]):
        pieces, docs, bases = [], [], []
        for doc, data in enumerate(texts):
            for base in range(0, max(1, len(data) - LENGTH + 1), SLICE):
                piece = data[base : base + SLICE + LENGTH - 1]
                if len(piece) >= LENGTH:
                    pieces.append(piece)
                    docs.append(doc)
                    bases.append(base)
        self.letters = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        n = len(self.letters)
        if n == 0:
            self.begin = self.end = self.anchor = self.doc = self.base = np.zeros(0, np.int64)
            self.hash = self.same = np.zeros(0, np.uint64)
            return
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[self.letters] * POWERS[:n], out=sums[1:])
        hashes = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * INVERSE_POWERS[: n - ANCHOR + 1])
        # The smallest hash of each window, the leftmost where equal, with its place in the lowest bits.
        least = (hashes & ~POSITION) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while span * 2 <= LENGTH - ANCHOR + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = LENGTH - ANCHOR + 1 - span
        least = (np.minimum(least[:-rest], least[rest:]) if rest else least) & POSITION
        inside = np.ones(len(least) + 2, dtype=bool)
        inside[[0, -1]] = False
        for edge in edges[1:-1]:
            inside[edge - LENGTH + 2 : edge + 1] = False
        change = np.concatenate([[True], least[1:] != least[:-1], [True]])
        here = inside[1:-1]
        self.begin = np.flatnonzero(here & (change[:-1] | ~inside[:-2]))
        self.end = np.flatnonzero(here & (change[1:] | ~inside[2:])) + LENGTH
        self.anchor = least[self.begin].astype(np.int64)
        # An anchor is the least of many, so its hash is small; mixed once more, it fills ranges and bitmap evenly.
        self.hash = mixed(hashes[self.anchor])
        piece = np.searchsorted(edges, self.begin, side="right") - 1
        self.doc = np.array(docs, dtype=np.int64)[piece]
        self.base = np.array(bases, dtype=np.int64)[piece] - edges[piece]
        whole = (sums[self.end] - sums[self.begin]) * INVERSE_POWERS[self.begin]
        shape = ((self.end - self.begin) * 256 + self.anchor - self.begin).astype(np.uint64)
        self.same = mixed(whole + shape * PLACES[12])  # equal for equal stretches around equal anchors


def _runs(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Documents in runs of about a slice: first place and texts. A longer text is a run of its own, cut inside."""
    first, size, run = 0, 0, []
    for place, data in enumerate(texts):
        if run and size + len(data) > SLICE:
            yield first, run
            first, size, run = place, 0, []
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def _long_safe(texts: list[bytes]) -> Iterator[tuple[int, int, Stretches]]:
    """(first document, offset, stretches); texts longer than a slice come slice by slice, so that memory is bounded."""
    for first, run in _runs(texts):
        if len(run) == 1 and len(run[0]) > SLICE:
            for base in range(0, len(run[0]) - LENGTH + 1, SLICE):
                yield first, base, Stretches([run[0][base : base + SLICE + LENGTH - 1]])
        else:
            yield first, 0, Stretches(run)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about AT_ONCE bytes of text, at least a row each, and few enough rows for short numbers."""
    sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column("text")).to_pylist()], dtype=np.int64)
    start, size = 0, 0
    for at, n in enumerate(sizes):
        if at > start and (size + n > AT_ONCE or at - start >= 1 << 16):
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += n
    if start < len(sizes):
        yield batch.slice(start)


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if text is None else text.encode() for text in column.to_pylist()]


def _anchor_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                found, alike, docs = [], [], []
                for first, _, stretches in _long_safe(_bytes(part.column("text"))):
                    found.append(stretches.hash)
                    alike.append(stretches.same)
                    docs.append(stretches.doc + first)
                if not found:
                    continue
                hashes, same, docs = np.concatenate(found), np.concatenate(alike), np.concatenate(docs)
                order = np.lexsort((docs, same, hashes))
                hashes, same, docs = hashes[order], same[order], docs[order]
                new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
                # One entry per hash, a second one where the batch alone has it in two documents, and more where it
                # has many different stretches.
                group = np.cumsum(new) - 1
                many = np.zeros(int(new.sum()), dtype=bool)
                np.logical_or.at(many, group[1:], ~new[1:] & (docs[1:] != docs[:-1]))
                other = new.copy()
                other[1:] |= same[1:] != same[:-1]
                copies = 1 + many + np.bincount(group[other], minlength=len(many)) // STEP
                yield packed_rows(np.repeat(hashes[new], copies), bits)
            pa.default_memory_pool().release_unused()

    return run


STRETCHES = (
    "kind int, range int, doc_id long, tie long, spans binary, docs binary, ties binary, doc binary, low binary, size binary, "
    "before binary, positions binary, begins binary, letters binary"
)
NAMES = [c.split()[0] for c in STRETCHES.split(", ")]
KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 10


def merged_spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal runs covered by the spans, as rows (begin, end); spans that touch are one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]]) if len(begin) else np.zeros(0, bool)
    last = np.concatenate([new[1:], [True]]) if len(begin) else new
    return np.stack([begin[new], end[last]], axis=1)


def _spans_by_document(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(doc, kind="stable")
    edges = np.flatnonzero(np.diff(doc[order], prepend=-1))
    for start, stop in zip(edges, [*edges[1:], len(order)]):
        own = order[start:stop]
        yield int(doc[own[0]]), merged_spans(begin[own], end[own]).astype("<i8").tobytes()


def _among(hashes: np.ndarray, heavy: np.ndarray, bits: int) -> np.ndarray:
    """Whether the hashes' prefixes are in the sorted ones."""
    if not len(heavy):
        return np.zeros(len(hashes), dtype=bool)
    own = prefixes(hashes, bits)
    return heavy[np.minimum(np.searchsorted(heavy, own), len(heavy) - 1)] == own


def _stretch_rows(bitmap, heavy, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = _batch_stretches(part, bitmap.value, heavy.value, bits)
                if rows:
                    yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), KINDS)], names=NAMES)
            pa.default_memory_pool().release_unused()

    return run


def _batch_stretches(part: pa.RecordBatch, bitmap: np.ndarray, heavy: np.ndarray, bits: int) -> list[tuple]:
    ids = part.column("doc_id").to_numpy()
    ties = part.column("tie").to_numpy()
    texts = _bytes(part.column("text"))
    found = []
    for first, base, s in _long_safe(texts):
        keep = marked(bitmap, s.hash >> np.uint64(64 - BITMAP_BITS)) & ~_among(s.hash, heavy, bits)
        found.append((s.hash[keep], s.same[keep], s.doc[keep] + first, s.begin[keep] + s.base[keep] + base, s.end[keep] + s.base[keep] + base, s.anchor[keep] - s.begin[keep]))
    if not found:
        return []
    hashes, same, doc, begin, end, before = (np.concatenate(x) for x in zip(*found))
    if not len(hashes):
        return []
    order = np.lexsort((begin, doc, ids[doc], same, hashes))
    hashes, same, doc, begin, end, before = (x[order] for x in (hashes, same, doc, begin, end, before))
    own = ids[doc]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (same[1:] != same[:-1])])
    smallest = own[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
    rows = []
    beaten = own > smallest
    for at, spans in _spans_by_document(doc[beaten], begin[beaten], end[beaten]):
        # Marks that are settled pass through a range like any other row; which one does not matter.
        rows.append((0, int(ids[at]) % (1 << bits), int(ids[at]), int(ties[at]), spans, *[None] * 9))
    # What is left: per stretch and document one entry with all its positions.
    hashes, same, doc, begin, end, before, new = (x[~beaten] for x in (hashes, same, doc, begin, end, before, new))
    entry = new | np.concatenate([[True], doc[1:] != doc[:-1]])
    heads = np.flatnonzero(entry)
    positions = np.diff(np.append(heads, len(entry)))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    letters = np.frombuffer(b"".join(texts), dtype=np.uint8)
    packer = zstandard.ZstdCompressor(level=3)
    size = (end - begin)[heads]
    at = (offsets[doc] + begin)[heads]
    for where, places, low in split_ranges(hashes[heads], bits):
        docs, local = np.unique(doc[heads][places], return_inverse=True)
        sizes, n = size[places], positions[places]
        flat = np.repeat(at[places] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        each = np.repeat(heads[places] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        rows.append((
            1, where, None, None, None, ids[docs].astype("<i8").tobytes(), ties[docs].astype("<i8").tobytes(), local.astype("<u2").tobytes(),
            low.tobytes(), sizes.astype("<u1").tobytes(), before[heads][places].astype("<u1").tobytes(), n.astype("<u4").tobytes(),
            begin[each].astype("<u4").tobytes(), packer.compress(letters[flat].tobytes()),
        ))
    return rows


WINDOWS = pa.schema([("window", pa.binary()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("spans", pa.binary())])


def _window_rows(heavy, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                yield from _part_windows(part, heavy.value, bits)
            pa.default_memory_pool().release_unused()

    return run


def _part_windows(part: pa.RecordBatch, heavy: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Windows around heavy anchors: one row per window and document, and rows without a window for what is settled."""
    ids, ties = part.column("doc_id").to_numpy(), part.column("tie").to_numpy()
    texts = _bytes(part.column("text"))
    found = []
    for first, base, s in _long_safe(texts):
        use = _among(s.hash, heavy, bits)
        found.append((s.doc[use] + first, (s.begin + s.base + base)[use], (s.end - s.begin)[use] - LENGTH + 1))
    if not found:
        return
    doc, begin, n = (np.concatenate(x) for x in zip(*found))
    doc, begin = np.repeat(doc, n), np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    letters = np.frombuffer(b"".join(texts), dtype=np.uint8)
    for start in range(0, len(doc), WINDOWS_AT_ONCE):
        docs, begins = doc[start : start + WINDOWS_AT_ONCE], begin[start : start + WINDOWS_AT_ONCE]
        symbols = letters[(offsets[docs] + begins)[:, None] + np.arange(LENGTH)]
        group = np.unique(symbols.view(np.dtype((np.void, LENGTH)))[:, 0], return_inverse=True)[1]
        order = np.lexsort((begins, docs, ids[docs], group))
        docs, begins, group, symbols = docs[order], begins[order], group[order], symbols[order]
        own = ids[docs]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        beaten = own > own[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        settled = list(_spans_by_document(docs[beaten], begins[beaten], begins[beaten] + LENGTH))
        if settled:
            at = np.array([d for d, _ in settled])
            spans = pa.array([b for _, b in settled], pa.binary())
            yield pa.record_batch([pa.nulls(len(at), pa.binary()), pa.array(ids[at]), pa.array(ties[at]), spans], schema=WINDOWS)
        docs, begins, new, symbols = docs[~beaten], begins[~beaten], new[~beaten], symbols[~beaten]
        head = np.flatnonzero(new | np.concatenate([[True], docs[1:] != docs[:-1]]))
        spans = np.stack([begins, begins + LENGTH], axis=1).astype("<i8")
        yield pa.record_batch(
            [
                _binary(np.arange(len(head) + 1) * LENGTH, symbols[head]), pa.array(ids[docs[head]]), pa.array(ties[docs[head]]),
                _binary(np.append(head, len(docs)) * 16, spans),
            ],
            schema=WINDOWS,
        )


def _binary(edges: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])


def heavy_spans(windows: DataFrame) -> DataFrame:
    """(doc_id, tie, spans) of windows that a smaller doc_id has too, and what was settled before."""
    least = windows.filter("window IS NOT NULL").groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    beaten = windows.join(least.filter("least < most").select("window", "least"), "window").filter("doc_id > least")
    return windows.filter("window IS NULL").union(beaten.select(windows.columns)).select("doc_id", "tie", "spans")


def build_columns(letters: np.ndarray, size: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, order, common) after each round: stretches sorted by what follows from the column on, and the symbols
    that each shares with the one before it. Columns count from the anchor's first byte; those right of it come first.
    """
    n = len(size)
    starts = np.cumsum(size) - size
    shape = (COLUMNS, n)
    with tempfile.TemporaryFile() as file:
        symbols = np.zeros(shape, np.uint8) if COLUMNS * n <= IN_MEMORY else np.memmap(file, np.uint8, "w+", shape=shape)
        for start in range(0, n, ROWS_AT_ONCE):  # numbers per letter take eight times its memory
            own = slice(start, start + ROWS_AT_ONCE)
            begin, end = starts[start], starts[own][-1] + size[own][-1]
            row = np.repeat(np.arange(n)[own], size[own])
            symbols[np.arange(begin, end) - np.repeat(starts[own] - LEFT + before[own], size[own]), row] = letters[begin:end]
        first, last = LEFT - before, LEFT - before + size
        order, common = np.arange(n), np.zeros(n + 1, dtype=np.uint8)
        for at in range(COLUMNS - 1, -1, -1):
            # Symbol 0 stands for stretches that do not reach this column.
            symbol = np.where((first <= at) & (at < last), symbols[at].astype(np.uint16) + 1, 0).astype(np.uint16)[order]
            moved = np.argsort(symbol, kind="stable")
            shared = np.minimum.reduceat(common, moved + 1) if n else common[:0]
            symbol = symbol[moved]
            order = order[moved]
            common[0] = common[n] = 0
            alike = (symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)
            common[1:n] = np.where(alike, shared[:-1] + 1, 0)
            yield at - LEFT, order, common[:n]


def _build(table: pa.Table) -> pa.Table:
    """Marks of one range, merged per document, and those that were settled before."""
    settled = table.filter(pc.equal(table.column("kind"), 0)).select(["doc_id", "tie", "spans"])
    table = table.filter(pc.equal(table.column("kind"), 1))
    if table.num_rows == 0:
        return settled
    unpacker = zstandard.ZstdDecompressor()
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)
    docs, ties = join("docs", "<i8"), join("ties", "<i8")
    n_docs = np.array([len(b) // 8 for b in table.column("docs").to_pylist()])
    n_rows = np.array([len(b) // 2 for b in table.column("doc").to_pylist()])
    doc = join("doc", "<u2").astype(np.int64) + np.repeat(np.cumsum(n_docs) - n_docs, n_rows)
    low, size, before = join("low", "<u4"), join("size", "<u1").astype(np.int64), join("before", "<u1").astype(np.int64)
    positions, begins, letters = join("positions", "<u4").astype(np.int64), join("begins", "<u4").astype(np.int64), np.frombuffer(
        b"".join(unpacker.decompress(b) for b in table.column("letters").to_pylist()), dtype="u1"
    )
    # Anchors that are in one document after all are left out.
    order = np.argsort(low, kind="stable")
    head = np.flatnonzero(np.concatenate([[True], low[order][1:] != low[order][:-1]]))
    ids = docs[doc]
    span = np.diff(np.append(head, len(low)))
    least = np.repeat(np.minimum.reduceat(ids[order], head), span)
    most = np.repeat(np.maximum.reduceat(ids[order], head), span)
    use = np.zeros(len(low), dtype=bool)
    use[order] = least < most
    letters = letters[np.repeat(use, size)]
    begin_at = (np.cumsum(positions) - positions)[use]
    doc, size, before, positions, ids = doc[use], size[use], before[use], positions[use], ids[use]
    found_doc, found_begin = [], []
    for column, order, common in build_columns(letters, size, before):
        if column > 0 or not len(order):
            continue
        head = np.flatnonzero(common < LENGTH)
        smallest = np.repeat(np.minimum.reduceat(ids[order], head), np.diff(np.append(head, len(order))))
        beaten = order[ids[order] > smallest]
        n = positions[beaten]
        each = np.repeat(begin_at[beaten] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        found_doc.append(np.repeat(doc[beaten], n))
        found_begin.append(begins[each] + np.repeat(before[beaten], n) + column)
    out = []
    if found_doc:
        all_docs, begin = np.concatenate(found_doc), np.concatenate(found_begin)
        out = [(int(docs[d]), int(ties[d]), spans) for d, spans in _spans_by_document(all_docs, begin, begin + LENGTH)]
    marks = pa.table({
        "doc_id": pa.array([r[0] for r in out], pa.int64()), "tie": pa.array([r[1] for r in out], pa.int64()), "spans": pa.array([r[2] for r in out], pa.binary()),
    })
    return pa.concat_tables([settled, marks])


def tie(docs: DataFrame) -> Column:
    """What tells rows with equal doc_id apart: a hash of the text where the doc_id repeats, else 0, which packs well.

    Where more than NAMED ids repeat, all rows have the hash.
    """
    own = only(docs, doc_id="doc_id").filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"))
    with passing_shuffles(docs.sparkSession):
        repeated = [r["doc_id"] for r in own.groupBy("doc_id").count().filter("count > 1").limit(NAMED + 1).collect()]
    if len(repeated) > NAMED:
        return F.xxhash64("text")
    return F.when(F.col("doc_id").isin(repeated), F.xxhash64("text")).otherwise(F.lit(0).cast("long")) if repeated else F.lit(0).cast("long")


def repeated_spans(docs: DataFrame, own_tie: Column) -> DataFrame:
    """(doc_id, tie, spans): spans of bytes to remove per document, in parts; tie as ``tie`` has it."""
    ship(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text").filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    rows = rows.select(F.col("doc_id").cast("long"), "text").select("doc_id", own_tie.alias("tie"), "text")
    bits = range_bits(only(docs, doc_id="doc_id").count(), DOCS_PER_RANGE)
    with passing_shuffles(docs.sparkSession):
        stretches, windows = filed(rows, bits)
        spans = stretches.groupBy("range").applyInArrow(_build, "doc_id long, tie long, spans binary")
        if windows is None:
            return written(spans, "suffix-spans")
        windows = written(windows, "suffix-windows")
        spans = written(spans.union(heavy_spans(windows)), "suffix-spans")
    discard(windows)
    return spans


def filed(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame | None]:
    """Stretches by range, and the windows around heavy anchors, if there are any."""
    share = rows.sparkSession.sparkContext.broadcast
    anchors = rows.select("text").mapInArrow(_anchor_rows(bits), "range int, values binary")
    bitmap, heavy = frequency_bitmap(anchors, bits, BITMAP_BITS, 1, HEAVY)
    shared = share(heavy)
    stretches = rows.mapInArrow(_stretch_rows(share(bitmap), shared, bits), STRETCHES)
    windows = rows.mapInArrow(_window_rows(shared, bits), "window binary, doc_id long, tie long, spans binary") if len(heavy) else None
    return stretches, windows


def kept_bytes(data: bytes, spans: list[bytes]) -> tuple[bytes, np.ndarray]:
    """What stays of a text, and the maximal removed runs (begin, end)."""
    rows = np.frombuffer(b"".join(spans), dtype="<i8").reshape(-1, 2)
    runs = merged_spans(rows[:, 0], rows[:, 1])
    edges = [0, *runs.reshape(-1).tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])), runs


def _with_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents without and with spans, both with ``spans`` (list) and all their columns in the struct ``row``."""
    ship(docs.sparkSession)
    own_tie = tie(docs)
    spans = repeated_spans(docs, own_tie)
    place = lookup_place("doc_id")
    bitmap = docs.sparkSession.sparkContext.broadcast(lookup_bitmap(spans, "doc_id"))

    @F.pandas_udf("boolean")
    def maybe(places):
        import pandas as pd

        return pd.Series(marked(bitmap.value, places.to_numpy()))

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    whole = whole.withColumn("maybe", F.col("doc_id").isNotNull() & maybe(F.coalesce(place, F.lit(0))))
    gathered = spans.groupBy("doc_id", "tie").agg(F.collect_list("spans").alias("spans"))
    some = whole.filter("maybe").withColumn("tie", own_tie).join(gathered, ["doc_id", "tie"], "left")
    none = whole.filter("NOT maybe")
    return none, some.select("row", "doc_id", "text", F.coalesce("spans", F.array().cast("array<binary>")).alias("spans"))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    has = None
    for batch in batches:
        has = "spans" in batch.schema.names if has is None else has
        texts = _bytes(batch.column("text"))
        spans = batch.column("spans").to_pylist() if has else [[]] * len(texts)
        made = [kept_bytes(data, own) if own else (data, ()) for data, own in zip(texts, spans)]
        yield pa.record_batch(
            [
                batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(t) - len(k) for t, (k, _) in zip(texts, made)], pa.int64()), pa.array([len(r) for _, r in made], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k, _ in made], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def removed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    none, some = _with_spans(only(docs, doc_id="doc_id", text="text"))
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return none.select("doc_id", "text").mapInArrow(_report, columns).union(some.select("doc_id", "text", "spans").mapInArrow(_report, columns))


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents without repeated passages: ``text`` is what stays, characters that a cut breaks are dropped,
    ``n_chars`` follows it. Documents that lose all their bytes go; all others stay, as they are if nothing repeats."""
    none, some = _with_spans(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans = batch.column("row"), batch.column("spans").to_pylist()
            fields = [row.field(i) for i in range(row.type.num_fields)]
            names = [f.name for f in row.type]
            texts = [
                None if text is None else kept_bytes(text.encode(), own)[0].decode(errors="ignore") if own else text
                for text, own in zip(fields[names.index("text")].to_pylist(), spans)
            ]
            changed = pa.array([bool(own) for own in spans], pa.bool_())
            fields[names.index("text")] = pa.array(texts, pa.string())
            if "n_chars" in names:
                counted = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(row.type.field("n_chars").type)
                fields[names.index("n_chars")] = pc.if_else(changed, counted, fields[names.index("n_chars")])
            gone = pa.array([bool(own) and not t for t, own in zip(texts, spans)], pa.bool_())
            yield pa.record_batch(fields, names=names).filter(pc.invert(gone))

    return none.select("row.*").union(some.select("row", "spans").mapInArrow(cut, docs.schema))
