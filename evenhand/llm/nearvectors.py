"""Near-duplicate vectors by a subspace pigeonhole join, exact.

Unit vectors with cosine of at least c are at most b = 2 - 2c apart (squared). After a rotation that spreads lengths
evenly, coordinates are cut into blocks and each block gets its share of b in proportion to its dimensions: in at least
one block the pair is within the share. So vectors are range-joined in every block, on a grid over some of the block's
coordinates: each is at home in one cell and probes the cells that its range touches. What is found is verified by the
cosine of the vectors in double precision. A pair counts in the first block that finds it, so the union holds it once.

Only equal labels meet. Equal vectors are one class with a size. Groups of a cell are cut into chunks of at most about
CHUNK members on either side, so that a cell that holds a third of all vectors is many tasks of bounded memory. Tasks
return sums of links per vector and a spanning forest of the links, never the pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components, and those with a null label, have
no links and are their own component; vectors of different length do not link; repeated rows are one class and link
with each other; a null vec_id takes part and names a component only if nothing else is in it; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import only, ship, written
from evenhand.llm.components import components

BLOCKS = 8
CHUNK = 2048
PER_CELL = 500
MAX_BROADCAST_CELLS = 100_000  # rows of six numbers
SLACK = 1e-9
#: A grid step is twice the range, so that a range touches at most two cells in each coordinate.
STEPS = 2.0


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation of so many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
    return [slice(a, b) for a, b in itertools.pairwise(edges)]


def _vectors(raw: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(b, dtype="<f8") for b in raw])


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _cells(least: float, grid: int):
    """Rows (node, label, dim, size, vector, block, cell, home) of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column("embedding").to_pylist()])
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors = np.array(part.column("embedding").to_pylist(), dtype=np.float64)
                turned = _unit(vectors) @ rotation(int(dim)).T
                raw = [v.astype("<f8").tobytes() for v in vectors]
                for number, block in enumerate(blocks_of(int(dim))):
                    width = block.stop - block.start
                    reach = np.sqrt((2 - 2 * least) * width / dim + 2 * SLACK) + SLACK
                    step = STEPS * reach
                    coords = turned[:, block][:, :grid]
                    at = np.floor(coords / step).astype(np.int64)
                    low, high = (np.floor((coords + side * reach) / step).astype(np.int64) for side in (-1, 1))
                    rows = [(np.arange(len(raw)), at, True)]
                    for choice in itertools.product((0, 1), repeat=coords.shape[1]):
                        cell = np.where(np.array(choice) == 1, high, low)
                        # A coordinate whose range stays in one cell is probed once.
                        real = ((np.array(choice) == 0) | (high > low)).all(axis=1)
                        rows.append((np.flatnonzero(real), cell[real], False))
                    for places, cell, home in rows:
                        code = np.zeros(len(places), dtype=np.int64)
                        for column in range(cell.shape[1]):
                            code = code * 1024 + cell[:, column] + 512
                        taken = pa.array(places)
                        yield pa.record_batch(
                            [
                                part.column("node").take(taken), part.column("label").take(taken), pa.array(np.full(len(places), dim), pa.int32()),
                                part.column("size").take(taken), pa.array(raw, pa.binary()).take(taken), pa.array(np.full(len(places), number), pa.int32()),
                                pa.array(code), pa.array(np.full(len(places), home)),
                            ],
                            names=["node", "label", "dim", "size", "vector", "block", "cell", "home"],
                        )

    return run


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of n members the smallest that the links (left, right) reach."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if (root == before).all():
            return root


def _meet(least: float):
    def run(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
        out_nodes, out_links, a, b = (np.zeros(0, np.int64) for _ in range(4))
        if home.any() and not home.all():
            dim, number = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
            vectors = _vectors(table.column("vector").to_pylist())
            turned = _unit(vectors) @ rotation(dim).T
            blocks = blocks_of(dim)
            shares = np.array([(2 - 2 * least) * (x.stop - x.start) / dim + SLACK for x in blocks])
            members, probes = np.flatnonzero(home), np.flatnonzero(~home)
            x, y = turned[members][:, blocks[number]], turned[probes][:, blocks[number]]
            apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
            i, j = np.nonzero(apart <= shares[number] + SLACK)
            found = []
            for start in range(0, len(i), 200_000):
                left, right = members[i[start : start + 200_000]], probes[j[start : start + 200_000]]
                other = nodes[left] != nodes[right]
                left, right = left[other], right[other]
                u, v = vectors[left], vectors[right]
                cosine = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))
                keep = cosine >= least
                left, right = left[keep], right[keep]
                gap = (turned[left] - turned[right]) ** 2
                within = np.stack([gap[:, x].sum(axis=1) for x in blocks], axis=1) <= shares
                first = within.argmax(axis=1) == number
                found.append((left[first], right[first]))
            if found:
                left, right = (np.concatenate(z) for z in zip(*found))
                links = np.bincount(right, weights=sizes[left], minlength=len(nodes)).astype(np.int64)
                linked = np.flatnonzero(links)
                out_nodes, out_links = nodes[linked], links[linked]
                # A class may be here at home and as a probe: links are between classes.
                names, place = np.unique(nodes, return_inverse=True)
                root = _forest(place[left], place[right], len(names))
                moved = np.flatnonzero(root != np.arange(len(names)))
                a, b = names[moved], names[root[moved]]
        return pa.table({
            "node": pa.array(np.concatenate([out_nodes, a])),
            "links": pa.array([*out_links.tolist(), *[None] * len(a)], pa.int64()),
            "other": pa.array([*[None] * len(out_nodes), *b.tolist()], pa.int64()),
        })

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    rows = only(vectors, vec_id="vec_id", embedding="embedding", label="label").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = rows.filter("usable").groupBy("label", "embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    grid = int(np.clip(np.ceil(np.log(max(1, largest) / PER_CELL) / np.log(4)), 1, 6))

    label = classes.schema["label"].dataType.simpleString()
    cells = classes.select("node", "label", "size", "embedding").mapInArrow(
        _cells(least, grid), f"node long, label {label}, dim int, size long, vector binary, block int, cell long, home boolean"
    )
    key = ["label", "dim", "block", "cell"]
    counts = cells.groupBy(*key).agg(
        F.ceil(F.count_if("home") / CHUNK).alias("home_chunks"), F.ceil(F.count_if(~F.col("home")) / CHUNK).alias("probe_chunks")
    )
    large = written(counts.filter("home_chunks > 1 OR probe_chunks > 1"), "vector-cells")
    chunk = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("home_chunks")).otherwise(F.col("probe_chunks")))
    few = large.count() <= MAX_BROADCAST_CELLS
    chunked = cells.join(F.broadcast(large) if few else large, key, "left").fillna(1, ["home_chunks", "probe_chunks"]).withColumn("own", chunk)
    others = F.when(F.col("home"), F.col("probe_chunks")).otherwise(F.col("home_chunks"))
    chunked = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(others, F.lit(1)) - 1)))
    met = (
        chunked.withColumn("home_chunk", F.when(F.col("home"), F.col("own")).otherwise(F.col("other")))
        .withColumn("probe_chunk", F.when(F.col("home"), F.col("other")).otherwise(F.col("own")))
        .select(*key, "home_chunk", "probe_chunk", "node", "size", "vector", "home")
        .groupBy(*key, "home_chunk", "probe_chunk").applyInArrow(_meet(least), "node long, links long, other long")
    )
    met = written(met, "vector-links")
    labels = components(met.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = met.filter("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    rooted = classes.join(links, "node", "left").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    rooted = rooted.join(names, "root").select(
        F.col("label").alias("l"), F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    same = F.col("usable") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))
    named = rows.join(rooted, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return named.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
