"""Hash ranges: many 64-bit hashes packed into a few rows, counted exactly, and bitmaps of fixed size over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_BITS = 24


def range_bits(n_docs: int, docs_per_range: int = 400) -> int:
    """Bits of a hash that name its range: enough for about so many documents' share per range, 8 to 16."""
    return int(min(16, max(8, np.ceil(np.log2(max(1, n_docs) / docs_per_range)))))


def split_ranges(values: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range, places of its values, their next 32 bits) for each range that occurs."""
    where = (values >> np.uint64(64 - bits)).astype(np.uint16)
    low = (values >> np.uint64(32 - bits)).astype(np.uint32)
    order = np.argsort(where, kind="stable")
    edges = np.flatnonzero(np.diff(where[order].astype(np.int64), prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(order)]):
        places = order[start:end]
        yield int(where[places[0]]), places, low[places]


def packed_rows(values: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows (range, values) of bare hashes."""
    rows = [(r, low.tobytes()) for r, _, low in split_ranges(values, bits)]
    return pa.record_batch([pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["range", "values"])


def frequency_bitmap(rows: DataFrame, bits: int, bitmap_bits: int, more_than: int, heavy: int | None = None):
    """A packed bitmap over the highest ``bitmap_bits`` of hashes: whether one in it occurs more than so many times.

    The counts are exact over all rows (range, values). What comes to the driver is the bitmap, 2^bitmap_bits bits. With
    ``heavy`` the result has a second part: the sorted prefixes (see ``prefixes``) that occur more than so many times.
    """
    inner = bitmap_bits - bits

    def mark(table: pa.Table) -> pa.Table:
        low = np.sort(np.frombuffer(b"".join(table.column("values").to_pylist()), dtype=np.uint32))
        often = low[more_than:][low[more_than:] == low[: max(0, len(low) - more_than)]]
        marks = np.zeros(1 << inner, dtype=bool)
        marks[often >> np.uint32(32 - inner)] = True
        most = low[:0] if heavy is None else np.unique(low[heavy:][low[heavy:] == low[: max(0, len(low) - heavy)]])
        return pa.table({
            "range": pa.array([table.column("range")[0].as_py()], pa.int32()),
            "marks": pa.array([np.packbits(marks).tobytes()], pa.binary()), "heavy": pa.array([most.tobytes()], pa.binary()),
        })

    out = np.zeros((1 << bits, (1 << inner) // 8), dtype=np.uint8)
    found = [np.zeros(0, dtype=np.uint64)]
    for row in rows.groupBy("range").applyInArrow(mark, "range int, marks binary, heavy binary").collect():
        out[row["range"]] = np.frombuffer(row["marks"], dtype=np.uint8)
        found.append(np.frombuffer(row["heavy"], dtype=np.uint32).astype(np.uint64) | np.uint64(row["range"] << 32))
    return out.reshape(-1) if heavy is None else (out.reshape(-1), np.sort(np.concatenate(found)))


def prefixes(values: np.ndarray, bits: int) -> np.ndarray:
    """What rows (range, values) keep of hashes: the range and the next 32 bits."""
    return values >> np.uint64(32 - bits)


def marked(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bits at these places are set."""
    places = places.astype(np.int64)
    return (bitmap[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1


def lookup_place(column):
    """Where an id stands in a lookup bitmap."""
    return F.pmod(F.xxhash64(column), F.lit(1 << LOOKUP_BITS)).cast("int")


def lookup_bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """A packed bitmap of fixed size over hashes of the ids, made in parts by Spark."""
    half = LOOKUP_BITS // 2

    def mark(table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << half, dtype=bool)
        marks[table.column("low").to_numpy()] = True
        return pa.table({"high": pa.array([table.column("high")[0].as_py()], pa.int32()), "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    place = lookup_place(column)
    parts = ids.select(F.shiftright(place, half).alias("high"), place.bitwiseAND((1 << half) - 1).alias("low")).distinct()
    out = np.zeros((1 << half, (1 << half) // 8), dtype=np.uint8)
    for row in parts.groupBy("high").applyInArrow(mark, "high int, marks binary").collect():
        out[row["high"]] = np.frombuffer(row["marks"], dtype=np.uint8)
    return out.reshape(-1)
