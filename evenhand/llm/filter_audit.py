"""Interaction audit of filters by decision diagrams.

Each document has a failure mask, one bit per filter. Documents are counted by part and mask. From the counts of a part
a decision diagram is built: a level per filter, a branch for passing and one for failing, at the bottom the counts, and
on every node the sum of what is below. Equal nodes are one node. Swapping two neighbouring levels rebuilds only the
nodes of the upper one, and neighbour swaps alone lead through all orders of the filters. In each order the path on
which everything passes gives the steps: what its fail branches carry was removed there, what goes on was kept.

A text equal to that of a smaller doc_id fails E, in whatever part that is. Equal texts have equal masks otherwise, so
rows are summed by text and part, and the parts that hold the smallest doc_id are found among those sums: copies of
one text never meet as rows, however many they are.

Defined results: a null text is an empty one, a null source the part ''; a null doc_id is neither smaller nor larger
than any other, so such a row passes E; rows that share doc_id and text pass or fail E together; a document has a label
if any of its rows in ``labels`` is 1, and a null doc_id has none; an empty table gives no part and no row; very long
texts are read once, row by row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.common import only, ship

#: Documents, of them with quality 1, of them with toxic 1.
Weight = tuple[int, int, int]
NOTHING: Weight = (0, 0, 0)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = re.compile(r"[A-Z]")
MARKS = re.compile(r"[#$%&*|]")
#: All orders are listed, so filters are few.
MOST_FILTERS = 8


class Diagram:
    """Counts by failure mask under an order of the filters. A node is a number; 0 stands for no documents."""

    def __init__(self, counts: Mapping[int, Weight], filters: int):
        self.order = list(range(filters))
        self.nodes: list[tuple] = [(None, 0, 0)]
        self.weights: list[Weight] = [NOTHING]
        self.known: dict[tuple, int] = {}
        self.root = self._build(counts, 0, 0)

    def _build(self, counts: Mapping[int, Weight], level: int, mask: int) -> int:
        if level == len(self.order):
            return self._leaf(counts.get(mask, NOTHING))
        passed = self._build(counts, level + 1, mask)
        return self._node(self.order[level], passed, self._build(counts, level + 1, mask | 1 << self.order[level]))

    def _leaf(self, weight: Weight) -> int:
        return self._add(("counts", weight), (None, 0, 0), weight) if weight != NOTHING else 0

    def _node(self, filter_: int, passed: int, failed: int) -> int:
        if not passed and not failed:
            return 0
        total = tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed]))
        return self._add((filter_, passed, failed), (filter_, passed, failed), total)

    def _add(self, key: tuple, node: tuple, weight: Weight) -> int:
        known = self.known.get(key)
        if known is None:
            known = self.known[key] = len(self.nodes)
            self.nodes.append(node)
            self.weights.append(weight)
        return known

    def swap(self, level: int) -> None:
        """Exchange a level with the one below it. Nodes further down stay what they are."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = lower, upper
        made: dict[int, int] = {}

        def rebuilt(node: int) -> int:
            if not node:
                return 0
            if node not in made:
                filter_, passed, failed = self.nodes[node]
                if filter_ == upper:
                    (_, pp, pf), (_, fp, ff) = self.nodes[passed], self.nodes[failed]
                    made[node] = self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
                else:
                    made[node] = self._node(filter_, rebuilt(passed), rebuilt(failed))
            return made[node]

        self.root = rebuilt(self.root)

    def steps(self) -> list[tuple[int, Weight, Weight, Weight]]:
        """Along the path on which all filters pass: filter, what goes on, what is removed, what fails it alone."""
        out, node = [], self.root
        for level, filter_ in enumerate(self.order):
            _, passed, failed = self.nodes[node]
            alone = failed
            for _ in self.order[level + 1 :]:
                alone = self.nodes[alone][1]
            out.append((filter_, self.weights[passed], self.weights[failed], self.weights[alone]))
            node = passed
        return out


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the one below, one after the other, to see every order of n things once."""
    places, ways = list(range(n)), [-1] * n
    while True:
        movable = [
            (places[at], at) for at in range(n)
            if 0 <= at + ways[places[at]] < n and places[at + ways[places[at]]] < places[at]
        ]
        if not movable:
            return
        largest, at = max(movable)
        to = at + ways[largest]
        places[at], places[to] = places[to], places[at]
        for thing in range(largest + 1, n):
            ways[thing] = -ways[thing]
        yield min(at, to)


def orders(counts: Mapping[int, Weight], names: str) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    if len(names) > MOST_FILTERS:
        raise ValueError(f"all orders of {len(names)} filters are too many rows")
    diagram = Diagram(counts, len(names))
    failing = [sum(w[0] for mask, w in counts.items() if mask >> f & 1) for f in range(len(names))]
    found = [(list(diagram.order), diagram.steps())]
    for level in neighbour_swaps(len(names)):
        diagram.swap(level)
        found.append((list(diagram.order), diagram.steps()))
    everywhere = [0] * len(names)
    for _, steps in found:
        for filter_, _, removed, _ in steps:
            everywhere[filter_] += removed[0]
    return [
        ("".join(names[f] for f in order), step, kept[0], removed[0], failing[filter_] - removed[0], alone[0], removed[1], removed[2], everywhere[filter_])
        for order, steps in found
        for step, (filter_, kept, removed, alone) in enumerate(steps, 1)
    ]


def of_text(text: str) -> int:
    """Bits 0 to 3: under 50 words, under 65 % distinct words, over 5 % capitals, a mark."""
    words = WORDS.findall(text)
    n = len(words)
    few, same = n < 50, 100 * len(set(words)) < 65 * n
    shouted = 100 * len(CAPITALS.findall(text)) > 5 * len(text)
    return few | same << 1 | shouted << 2 | (MARKS.search(text) is not None) << 3


def failures(docs: DataFrame, of_text=of_text) -> DataFrame:
    """part, doc_id, digest of the text and the mask of all filters that the text alone decides."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            digests = [hashlib.sha256(text.encode()).digest() for text in texts]
            masks = [of_text(text) for text in texts]
            yield pa.record_batch(
                [batch.column("part"), batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["part", "doc_id", "digest", "mask"],
            )

    rows = only(docs, part="source", doc_id="doc_id", text="text").withColumn("part", F.coalesce(F.col("part").cast("string"), F.lit("")))
    return rows.mapInArrow(run, f"part string, doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, of_text=of_text, copies_bit: int = 4) -> DataFrame:
    """part, mask and how many documents, good ones and toxic ones have it; the mask knows copies of smaller ids too."""
    flags = only(labels, doc_id="doc_id", quality="quality", toxic="toxic").filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).cast("long").alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).cast("long").alias("bad"),
    )
    same = failures(docs, of_text).groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    known = same.join(flags, "doc_id", "left").select(
        "doc_id", "digest", "part", "mask", "n",
        *[(F.col("n") * F.coalesce(flag, F.lit(0))).alias(flag) for flag in ("good", "bad")],
    )
    sums = ("n", "good", "bad")
    # Per text and part all of its documents, those without an id, and those of the smallest id there.
    with_id = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *sums))
    texts = known.groupBy("digest", "mask", "part").agg(
        *[F.sum(s).alias(s) for s in sums],
        *[F.sum(F.when(F.col("doc_id").isNull(), F.col(s)).otherwise(0)).alias(f"no_id_{s}") for s in sums],
        F.min(with_id).alias("first"),
    )
    # Of a text there is now one row per part, so a window holds no more rows than there are parts.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    here = texts.withColumn("least", least)
    is_first = F.coalesce(F.col("first.doc_id") == F.col("least"), F.lit(False))
    passing = {s: F.col(f"no_id_{s}") + F.when(is_first, F.col(f"first.{s}")).otherwise(0) for s in sums}
    both = F.array(
        F.struct("mask", *[passing[s].alias(s) for s in sums]),
        F.struct(F.col("mask").bitwiseOR(1 << copies_bit).alias("mask"), *[(F.col(s) - passing[s]).alias(s) for s in sums]),
    )
    return here.select("part", F.inline(both)).filter("n > 0").groupBy("part", "mask").agg(*[F.sum(s).alias(s) for s in sums])


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """All orders and steps of every part from its counts by mask: at most 2 ** len(names) rows a part."""
    ship(counts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                rows = orders({c["mask"]: (c["n"], c["good"], c["bad"]) for c in masks}, names)
                made = [pa.array([part] * len(rows)), *[pa.array(list(column)) for column in itertools.islice(zip(*rows), 2)]]
                made += [pa.array(list(column), pa.int64()) for column in itertools.islice(zip(*rows), 2, None)]
                made[2] = made[2].cast(pa.int32())
                yield pa.record_batch(made, names=["part", "filter_order", "step", *COLUMNS])

    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("counts"))
    return parts.mapInArrow(run, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COLUMNS)}")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters in all 120 orders, for every source."""
    return audit(mask_counts(docs, labels))


def first_steps(rows: DataFrame, parts: Sequence[str] | None = None) -> DataFrame:
    """Per part and filter what it removes when it comes first, what it alone finds, and its mean over all orders."""
    chosen = rows if parts is None else rows.filter(F.col("part").isin(*parts))
    filter_ = F.expr("substring(filter_order, step, 1)").alias("filter")
    return chosen.groupBy("part", filter_).agg(
        F.max("removed").alias("removed_first"), F.max("unique_fails").alias("unique_fails"),
        (F.max("shapley") / F.countDistinct("filter_order")).alias("mean_removed"),
    )
