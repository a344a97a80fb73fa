"""Shards by a k-d tree over document metadata: every split is a weighted median along the widest dimension.

Points are groups of equal texts, so copies stay together; the weight of a group is the bytes of all its rows. A node is
split in two at the point where half (or, for a number of shards that is no power of two, the right share) of its bytes
lies on either side, in the order of its widest dimension; points with equal values are ordered by their digest, so
ties are cut as finely as anything else. Levels are split until there are as many leaves as shards.

Medians are found by counting: bytes per node and slice of the order, summed over the few slices, then the slice that
holds the median is cut again. No node's points come together in one task; the driver sees sums per slice alone. Values are sent to [0, 1] by fixed rules per
dimension (numbers on a logarithmic or linear scale between the extremes, strings by their rank among the distinct
values, so that no two of them are one).

Law: ``bytes``. Slots number the rows of a shard from 0 without gaps; they are given out per part of a shard whose
offsets are known from counts.

Defined results: a null text has size 1, no digest of its own (all null texts are one group) and the checksum of no
bytes; null metadata counts as the smallest value; a group that outweighs a shard stays whole; repeated rows are in one
group; an empty table gives an empty table; further columns are ignored. Ties of slots go by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evenhand.llm.common import only, written

SLICES = 1 << 12
PARTS = 64  # of a shard, for slots
ORDER_BITS = 48
MAX_BROADCAST_VALUES = 100_000  # rows of a short name and a number


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, group, and what the dimensions are made from) of every row."""
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") + 1
    return only(docs, doc_id="doc_id", text="text", lang="lang", source="source").select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(data).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("")).alias("group"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.log2(size.cast("double")).alias("d_size"), F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)).alias("d_id"),
    )


def ranked(rows: DataFrame, name: str) -> DataFrame:
    """``d_<name>`` in place of a string: its rank among the distinct values, 0 for null.

    The window has one part because it runs over distinct values, of which languages and sources have few.
    """
    values = rows.select(F.col(name).alias("value")).filter("value IS NOT NULL").distinct()
    ranks = written(values.withColumn("rank", F.row_number().over(Window.orderBy("value")).cast("double")), "shard-ranks")
    small = F.broadcast(ranks) if ranks.count() <= MAX_BROADCAST_VALUES else ranks
    joined = rows.join(small, F.col(name) == F.col("value"), "left")
    return joined.withColumn(f"d_{name}", F.coalesce("rank", F.lit(0.0))).drop(name, "value", "rank")


DIMENSIONS = ["d_lang", "d_source", "d_size", "d_id"]


def _scaled(points: DataFrame) -> DataFrame:
    """Dimensions between 0 and 1 by the extremes of all points."""
    ends = points.agg(*[f(d).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))]).first()
    for d in DIMENSIONS:
        low, high = ends[f"min_{d}"], ends[f"max_{d}"]
        width = (high - low) if low is not None and high > low else 1.0
        points = points.withColumn(d, (F.col(d) - F.lit(low or 0.0)) / F.lit(width))
    return points


def _by_node(values: dict[int, float], kind: str) -> Column:
    """A value per node, of which there are as many as shards; null for other nodes."""
    pairs = [part for node, value in values.items() for part in (F.lit(node), F.lit(value).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), F.col("node"))


def _split(points: DataFrame, leaves: dict[int, int]) -> DataFrame:
    """Points with ``node`` after one level; ``leaves`` says how many shards each node will hold (1: it is a leaf).

    What comes to the driver is a row per node and, in each round, one per node and slice.
    """
    wide = points.groupBy("node").agg(F.sum("bytes").alias("total"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS])
    nodes = {r["node"]: r for r in wide.collect() if leaves[r["node"]] > 1}
    if not nodes:
        return points.withColumn("node", F.col("node") * 2)
    widest = {node: max(range(len(DIMENSIONS)), key=lambda i: (r[DIMENSIONS[i]], -i)) for node, r in nodes.items()}
    goal = {node: r["total"] * (leaves[node] // 2) / leaves[node] for node, r in nodes.items()}
    # One long orders the points of a node: the value in its highest bits, the digest below.
    chosen = F.element_at(F.array(*DIMENSIONS), _by_node(widest, "int") + 1)
    tie = F.coalesce(F.conv(F.substring("group", 1, 5), 16, 10).cast("long"), F.lit(0).cast("long"))
    placed = points.withColumn("order", F.floor(chosen * float((1 << (ORDER_BITS - 20)) - 1)) * (1 << 20) + tie)

    # The slice that holds the goal, cut finer and finer.
    low, before, inside = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    width = 1 << ORDER_BITS
    while width > 1:
        step = max(1, width // SLICES)
        start = _by_node(low, "long")
        held = placed.filter((F.col("order") >= start) & (F.col("order") < start + width))
        summed = held.groupBy("node", F.floor((F.col("order") - start) / step).alias("slice")).agg(F.sum("bytes").alias("bytes"))
        by_node: dict[int, list] = {}
        for r in summed.collect():
            by_node.setdefault(r["node"], []).append((r["slice"], r["bytes"]))
        for node, slices in by_node.items():
            for place, size in sorted(slices):
                if before[node] + size > goal[node]:
                    low[node], inside[node] = low[node] + place * step, size
                    break
                before[node] += size
        width = step
    # The order value at the cut goes to the side that comes nearer to the goal.
    cut = {node: low[node] + (goal[node] - before[node] >= inside[node] / 2) for node in nodes}
    right = F.coalesce(F.col("order") >= _by_node(cut, "long"), F.lit(False)).cast("int")
    return written(placed.select("group", "bytes", *DIMENSIONS, (F.col("node") * 2 + right).alias("node")), "shard-points")


def kd_shards(points: DataFrame, shards: int) -> DataFrame:
    """(group, shard) of points (group, bytes and the dimensions)."""
    leaves, level = {0: shards}, points.withColumn("node", F.lit(0))
    while any(n > 1 for n in leaves.values()):
        level = _split(level, leaves)
        halves = {node: (n // 2, n - n // 2) if n > 1 else (n, 0) for node, n in leaves.items()}
        leaves = {2 * node + side: n for node, held in halves.items() for side, n in enumerate(held) if n}
    number = {node: place for place, node in enumerate(sorted(leaves))}
    return level.select("group", _by_node(number, "int").alias("shard"))


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = written(described(docs), "shard-rows")
    rows = ranked(ranked(rows, "lang"), "source")
    points = rows.groupBy("group").agg(F.sum("size").alias("bytes"), *[F.min_by(d, F.struct("doc_id", *DIMENSIONS)).alias(d) for d in DIMENSIONS])
    points = written(_scaled(written(points, "shard-groups")), "shard-groups")
    placed = rows.drop(*DIMENSIONS).join(kd_shards(points, shards), "group")
    # Slots: parts of a shard are numbered by counts of the parts before, and inside each part by a window.
    part = F.pmod(F.xxhash64("doc_id", "group"), F.lit(PARTS))
    placed = written(placed.select("doc_id", "size", "text_crc32", "group", "shard", part.alias("part")), "shard-placed")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "group")) - 1
    numbered = placed.withColumn("inside", inside).join(F.broadcast(starts), ["shard", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
