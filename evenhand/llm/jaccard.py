"""Exact n-gram Jaccard join by prefixes of tokens and of token combinations.

Tokens are the hashed shingles of a document, all in one order: rare ones first, then frequent ones, each by hash. Two
documents whose sets reach the threshold of 3/4 differ in at most a quarter e = n - ceil(3n/4) of the tokens of either.
So their first e + 1 rare tokens must share one. A document with too few rare tokens extends its prefix into its
frequent ones, which are cut into classes by hash: among the tokens of a class each combination of two is indexed, and
a class with c tokens in the prefix stands e against c - 1 differences. Long lists of frequent single tokens (a
passage in many documents) are thus never made; rare tokens have short lists.

1. A pass over all texts counts prefix tokens exactly, by packed hash ranges, and keeps one bit per token range:
   frequent or not (a bitmap of fixed size; a wrong "frequent" costs work and no link).
2. A second pass writes signatures, packed per hash range, and one row per document with its size and set digest.
   Equal sets are one class with one representative.
3. Within a hash range equal signatures meet. Short lists give all pairs; in long ones, which are kept, each member is
   paired with the first and with a random other. Pairs of classes are dropped if counts of their tokens by hash
   bucket bound the overlap too low, else verified on whole sets and linked; links give components.
4. A kept list that is not within one component is gone through once more: whoever is outside its largest part is
   compared with all others in the list, in blocks. After that every pair that shares a signature is verified or
   connected, so components are exact.

Every range, list and pair is a row or a small group; copies of one text are dropped early in the task that reads them
and once more as classes, so a group that holds a third of all rows costs as many rows, not pairs.

Defined results: texts without words, null ones included, have size 0, no links and their own doc_id as component; a
null doc_id takes part and is never a component's id unless nothing else is in it; repeated rows are one class; an
empty table gives an empty table; further columns are ignored by ``join`` and kept by ``one_of_each``. Sets are
compared by 64-bit hashes of shingles and 128-bit digests of sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evenhand.llm.common import discard, only, ship, written
from evenhand.llm.components import components
from evenhand.llm.ranges import frequency_bitmap, lookup_bitmap, lookup_place, marked, packed_rows, range_bits, split_ranges
from evenhand.llm.shingles import mixed, shingle_set

FREQUENT = 16  # a token in more prefixes than this is frequent
SHORT_LIST = 16  # up to this length a list gives all its pairs
COUNTED = 1.5  # prefixes are counted so much further, as rare tokens are taken from there too
BLOCK = 2048  # members of a list that are compared at once
CLASS_TOKENS = 4  # frequent tokens of a document per class, at least about
BITMAP_BITS = 26
DOCS_AT_ONCE = 4096
SIZE_STEPS = 2048  # sizes are compared on this many steps per doubling before sets are
SIZE_REACH = int(np.ceil(np.log2(4 / 3) * SIZE_STEPS)) + 1
PAIR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def differences(n: int) -> int:
    """Tokens of a set of size n that a partner may lack."""
    return n - (3 * n + 3) // 4


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The signatures of a sorted set; ``frequent`` marks its frequent tokens."""
    n = len(tokens)
    needed = differences(n) + 1
    rare = tokens[~frequent][:needed]
    left = needed - len(rare)
    if left <= 0:
        return rare
    often = tokens[frequent]
    out, band = [rare], n.bit_length() - 1
    for scheme in (band, band + 1) if 4 * n // 3 >= 2 << band else (band,):
        kinds = np.uint64(max(1, (1 << scheme) // CLASS_TOKENS))
        group = (often >> np.uint64(32)) * kinds >> np.uint64(32)
        covered = np.cumsum(np.concatenate([[0], group[1:] == group[:-1]])) if len(often) else np.zeros(0)
        reach = int(np.searchsorted(covered, left)) + 1
        taken, group, step = often[:reach], group[:reach], 1
        while step < len(taken):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            first, second = taken[:-step][same], taken[step:][same]
            out.append(mixed(first * PAIR[0] + second * PAIR[1] + PAIR[2] * np.uint64(scheme + 1)))
            step += 1
    return np.concatenate(out)


def bucket_counts(tokens: np.ndarray) -> np.ndarray:
    """Tokens per hash bucket, about one or two each; 255 stands for that many and more."""
    bits = min(12, max(4, len(tokens).bit_length() - 1))
    return np.minimum(np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def may_be_similar(left: np.ndarray, right: np.ndarray, sizes: int) -> bool:
    """Whether the overlap that bucket counts allow reaches the threshold for sets of together so many tokens."""
    if left.max() == 255 or right.max() == 255:
        return True
    if len(left) < len(right):
        left, right = right, left
    left = left.reshape(len(right), -1).sum(axis=1)
    return 7 * int(np.minimum(left, right).sum()) >= 3 * sizes


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _count_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                parts = []
                for text in batch.column("text").slice(first, DOCS_AT_ONCE).to_pylist():
                    tokens = shingle_set(text)
                    key = _key(tokens)
                    if len(tokens) and key not in seen:
                        seen.add(key)
                        parts.append(tokens[: int(COUNTED * (differences(len(tokens)) + 1))])
                if parts:
                    yield packed_rows(np.concatenate(parts), bits)
                if len(seen) > 500_000:
                    seen.clear()

    return run


SIGNATURES = "kind int, doc_id long, tie long, node long, n int, key binary, counts binary, range int, low binary, place binary, size binary"


def _signature_rows(bitmap, bits: int):
    names = [c.split()[0] for c in SIGNATURES.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        number = TaskContext.get().partitionId() << 38
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(first, DOCS_AT_ONCE)
                rows, found, places, sizes = [], [], [], []
                ids, ties = part.column("doc_id").to_pylist(), part.column("tie").to_pylist()
                for place, text in enumerate(part.column("text").to_pylist()):
                    tokens = shingle_set(text)
                    key = _key(tokens)
                    rows.append((0, ids[place], ties[place], number + place, len(tokens), key, bucket_counts(tokens).tobytes(), None, None, None, None))
                    if len(tokens) and key not in seen:
                        seen.add(key)
                        own = signatures(tokens, marked(bitmap.value, tokens >> np.uint64(64 - BITMAP_BITS)))
                        found.append(own)
                        places.append(np.full(len(own), place, dtype=np.uint16))
                        sizes.append(np.full(len(own), round(np.log2(len(tokens)) * SIZE_STEPS), dtype=np.uint16))
                if found:
                    all_places, all_sizes = np.concatenate(places), np.concatenate(sizes)
                    for where, at, low in split_ranges(np.concatenate(found), bits):
                        rows.append((1, None, None, number, None, None, None, where, low.tobytes(), all_places[at].tobytes(), all_sizes[at].tobytes()))
                yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
                number += 1 << 16
                if len(seen) > 500_000:
                    seen.clear()

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Candidates of one range: (a, b) of pairs, and (list, members) of long lists."""
    base = table.column("node").to_numpy()
    low = [np.frombuffer(b, dtype=np.uint32) for b in table.column("low").to_pylist()]
    count = [len(x) for x in low]
    low = np.concatenate(low)
    node = np.repeat(base, count) + np.frombuffer(b"".join(table.column("place").to_pylist()), dtype=np.uint16)
    size = np.frombuffer(b"".join(table.column("size").to_pylist()), dtype=np.uint16).astype(np.int32)
    order = np.lexsort((node, low))
    low, node, size = low[order], node[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    length = np.diff(np.append(first, len(low)))
    start, many = np.repeat(first, length), np.repeat(length, length)
    pairs = []

    def add(left: np.ndarray, right: np.ndarray) -> None:
        near = (np.abs(size[left] - size[right]) <= SIZE_REACH) & (node[left] != node[right])
        pairs.append(np.stack([node[left[near]], node[right[near]]], axis=1))

    place = np.arange(len(low))
    for step in range(1, min(SHORT_LIST, int(length.max(initial=0)))):
        left = np.flatnonzero((many <= SHORT_LIST) & (place - start + step < many))
        add(left, left + step)
    if (length > SHORT_LIST).any():
        add(start[(many > SHORT_LIST) & (place > start)], np.flatnonzero((many > SHORT_LIST) & (place > start)))
        shuffled = np.lexsort((mixed(node.astype(np.uint64) * PAIR[0] ^ low.astype(np.uint64) * PAIR[1]), low))
        left = np.flatnonzero((many > SHORT_LIST) & (place > start))
        add(shuffled[left - 1], shuffled[left])
    found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    lists = {}
    for at, n in zip(first[length > SHORT_LIST], length[length > SHORT_LIST]):
        members = np.unique(node[at : at + n]).astype("<i8").tobytes()
        lists[int.from_bytes(hashlib.blake2b(members, digest_size=8).digest(), "little", signed=True)] = members
    return pa.table({
        "a": pa.array([*found[:, 0].tolist(), *lists], pa.int64()),
        "b": pa.array(found[:, 1].tolist() + [None] * len(lists), pa.int64()),
        "members": pa.array([None] * len(found) + list(lists.values()), pa.binary()),
    })


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, tokens) of the wanted representatives (doc_id, key, node): only texts whose id may be wanted are read."""
    bitmap = rows.sparkSession.sparkContext.broadcast(lookup_bitmap(wanted, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(marked(bitmap.value, batch.column("place").to_numpy())))
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                sets = [shingle_set(text) for text in part.column("text").to_pylist()]
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array([_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "key", "tokens"],
                )

    placed = rows.withColumn("place", lookup_place("doc_id"))
    found = placed.mapInArrow(run, "doc_id long, key binary, tokens binary").alias("s")
    same = F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.key") == F.col("w.key"))
    return found.join(wanted.alias("w"), same).select("node", "tokens").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                left, right = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if len(left) > len(right):
                    left, right = right, left
                at = np.searchsorted(right, left)
                shared = int((right[np.minimum(at, len(right) - 1)] == left).sum())
                keep.append(100 * shared >= 75 * (len(left) + len(right) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _near(left: str, right: str):
    """Sizes that a pair may have."""
    return F.greatest(left, right) * 3 <= F.least(left, right) * 4


def _bounded(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """The pairs (a, b) that bucket counts do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("left", "right", "sizes"))
            keep = [may_be_similar(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), n) for x, y, n in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = counts.select(F.col("node").alias("a"), F.col("counts").alias("left"), F.col("n").alias("n_a"))
    right = counts.select(F.col("node").alias("b"), F.col("counts").alias("right"), F.col("n").alias("n_b"))
    both = pairs.join(left, "a").join(right, "b").filter(_near("n_a", "n_b"))
    return both.select("a", "b", "left", "right", (F.col("n_a") + F.col("n_b")).alias("sizes")).mapInArrow(run, "a long, b long")


def _possible(table: pa.Table) -> pa.Table:
    """The members of a block of a list that have a partner in another component which bucket counts do not rule out."""
    roots, sizes = table.column("root").to_numpy(), table.column("n").to_numpy().astype(np.int64)
    counts = [np.frombuffer(b, dtype=np.uint8) for b in table.column("counts").to_pylist()]
    width = np.array([len(c) for c in counts])
    full = np.array([c.max() == 255 for c in counts])
    keep = np.zeros(len(counts), dtype=bool)
    folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by width: members that have at least so many buckets, folded

    def at_width(w: int) -> tuple[np.ndarray, np.ndarray]:
        if w not in folded:
            places = np.flatnonzero(width >= w)
            folded[w] = places, np.stack([counts[p].reshape(w, -1).sum(axis=1, dtype=np.uint16) for p in places])
        return folded[w]

    for at in np.flatnonzero(table.column("minor").to_numpy(zero_copy_only=False)):
        near = (roots != roots[at]) & (3 * np.maximum(sizes, sizes[at]) <= 4 * np.minimum(sizes, sizes[at]))
        maybe = near & (full | full[at])
        for w in np.unique(width[near]):
            w = min(int(w), int(width[at]))
            places, rows = at_width(w)
            here = near[places]
            overlap = np.minimum(rows[here], counts[at].reshape(w, -1).sum(axis=1, dtype=np.uint16)).sum(axis=1, dtype=np.int64)
            # A bound at fewer buckets than both have is looser, so a partner is kept only if each of its bounds allows it.
            wide = np.minimum(width[places[here]], width[at]) == w
            places = places[here][wide & (7 * overlap >= 3 * (sizes[places[here]] + sizes[at]))]
            maybe[places] = True
        if maybe.any():
            keep |= maybe
            keep[at] = True
    return table.filter(pa.array(keep)).select(["list", "block", "group", "node", "root", "minor"])


def _shortened(sets: DataFrame) -> DataFrame:
    """(node, tokens) with 16 bits of each token, as sorted numbers: equal tokens stay equal, so overlaps only grow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [(np.frombuffer(b, dtype=np.uint64) >> np.uint64(48)).astype(np.uint16).tobytes() for b in batch.column("tokens").to_pylist()]
            yield pa.record_batch([batch.column("node"), pa.array(short, pa.binary())], names=["node", "tokens"])

    return sets.select("node", "tokens").mapInArrow(run, "node long, tokens binary")


def _list_pairs(table: pa.Table) -> pa.Table:
    """Pairs of a block of a list, a minor member and one in another component, that shortened tokens do not rule out."""
    nodes, roots = table.column("node").to_numpy(), table.column("root").to_numpy()
    sets = [np.unique(np.frombuffer(b, dtype=np.uint16), return_counts=True) for b in table.column("tokens").to_pylist()]
    sizes = np.array([int(n.sum()) for _, n in sets])
    values, times = np.concatenate([v for v, _ in sets]), np.concatenate([n for _, n in sets])
    starts = np.cumsum([0, *[len(v) for v, _ in sets[:-1]]])
    a, b = [], []
    for at in np.flatnonzero(table.column("minor").to_numpy(zero_copy_only=False)):
        own = np.zeros(1 << 16, dtype=times.dtype)
        own[sets[at][0]] = sets[at][1]
        shared = np.add.reduceat(np.minimum(own[values], times), starts)
        found = np.flatnonzero((roots != roots[at]) & (100 * shared >= 75 * (sizes + sizes[at] - shared)))
        a += np.minimum(nodes[found], nodes[at]).tolist()
        b += np.maximum(nodes[found], nodes[at]).tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _open_links(rows: DataFrame, nodes: DataFrame, counts: DataFrame, lists: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Links that lists not within one component still hold; None if all lists are.

    Bucket counts go first, then 16 bits of each token: whole sets are sent only for pairs that these leave.
    """
    labelled = lists.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = labelled.groupBy("list", "root").agg(F.count("*").alias("members"))
    mixed_lists = parts.groupBy("list").agg(
        F.max_by("root", F.struct("members", "root")).alias("main"), F.count("*").alias("parts"), F.sum("members").alias("members"),
        (F.sum("members") - F.max("members")).alias("minors"),
    )
    mixed_lists = written(mixed_lists.filter("parts > 1"), "jaccard-open")
    if mixed_lists.isEmpty():
        return None
    inside = written(labelled.join(mixed_lists, "list"), "jaccard-inside")
    # Blocks of a list: each of its members in one, each of its minor members in all, those in groups of a block's size.
    blocks, groups = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("members", "minors"))
    is_minor = F.col("root") != F.col("main")
    own, group = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.pmod(F.xxhash64("node", F.lit("group")), groups).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    as_member = inside.select("list", "node", "root", F.lit(False).alias("minor"), own.alias("block"), F.explode(numbers(groups)).alias("group"))
    as_minor = inside.filter(is_minor).select("list", "node", "root", F.lit(True).alias("minor"), F.explode(numbers(blocks)).alias("block"), group.alias("group"))
    members = as_member.union(as_minor).groupBy("list", "block", "group", "node", "root").agg(F.max("minor").alias("minor"))
    key = ["list", "block", "group"]
    possible = members.join(counts, "node").groupBy(*key).applyInArrow(_possible, "list long, block int, group int, node long, root long, minor boolean")
    possible = written(possible, "jaccard-possible")
    wanted = nodes.filter("node = rep").select("node", "doc_id", "key").join(possible.select("node").distinct(), "node", "left_semi")
    sets = written(_sets(rows, written(wanted, "jaccard-wanted")), "jaccard-sets")
    pairs = possible.join(_shortened(sets), "node").groupBy(*key).applyInArrow(_list_pairs, "a long, b long").distinct()
    return _verified(written(pairs, "jaccard-pairs"), sets)


def classes_and_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows as (node, doc_id, tie, n, rep), tie a hash of the text, and the labels (node, root) of representatives that have links."""
    spark = docs.sparkSession
    ship(spark)
    rows = only(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    bits = range_bits(rows.select("doc_id").count())
    prefixes = rows.select("text").mapInArrow(_count_rows(bits), "range int, values binary")
    bitmap = spark.sparkContext.broadcast(frequency_bitmap(prefixes, bits, BITMAP_BITS, FREQUENT))
    table = written(rows.mapInArrow(_signature_rows(bitmap, bits), SIGNATURES), "jaccard-signatures")

    nodes = table.filter("kind = 0").select("node", "doc_id", "tie", "n", "key")
    reps = nodes.filter("n > 0").groupBy("key", "n").agg(F.min("node").alias("rep"))
    nodes = written(nodes.join(reps, ["key", "n"], "left").withColumn("rep", F.coalesce("rep", "node")), "jaccard-nodes")
    met = table.filter("kind = 1").select("range", "node", "low", "place", "size").groupBy("range").applyInArrow(_meet, "a long, b long, members binary")
    met = written(met, "jaccard-candidates")

    rep_of = nodes.select("node", "rep", "n")
    left, right = (rep_of.select(F.col("node").alias(x), F.col("rep").alias(f"rep_{x}")) for x in "ab")
    pairs = met.filter("b IS NOT NULL").select("a", "b").distinct().join(left, "a").join(right, "b").filter("rep_a != rep_b")
    pairs = pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
    met_pairs = written(pairs, "jaccard-pairs")

    member = F.explode(F.col("nodes")).alias("node")
    lists = met.filter("b IS NULL").select(F.col("a").alias("list"), "members").dropDuplicates(["list"]).mapInArrow(_unpack, "list long, nodes array<long>")
    lists = lists.select("list", member).join(rep_of, "node").select("list", F.col("rep").alias("node")).distinct()
    lists = written(lists, "jaccard-lists")
    # The signatures are the largest table; what later steps need of it is kept apart.
    named = met_pairs.select(F.col("a").alias("node")).union(met_pairs.select("b")).union(lists.select("node")).distinct()
    counts = written(table.filter("kind = 0").select("node", "n", "counts").join(named, "node", "left_semi"), "jaccard-counts")
    discard(table)
    discard(met)
    pairs = written(_bounded(met_pairs, counts), "jaccard-pairs")

    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.filter("node = rep").select("node", "doc_id", "key").join(named, "node", "left_semi")
    sets = written(_sets(rows, written(wanted, "jaccard-wanted")), "jaccard-sets")
    links = written(_verified(pairs, sets), "jaccard-links")
    discard(sets)
    labels = written(components(links), "jaccard-labels")
    more = _open_links(rows, nodes, counts, lists, labels)
    if more is not None:
        more = written(more, "jaccard-links")
        if not more.isEmpty():  # labels are links too, and already stars
            known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
            labels = written(components(known.union(more)), "jaccard-labels")
    return nodes, labels


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        arrays = [np.frombuffer(b, dtype="<i8") for b in batch.column("members").to_pylist()]
        yield pa.record_batch([batch.column("list"), pa.array(arrays, pa.list_(pa.int64()))], names=["list", "nodes"])


def _rooted(docs: DataFrame) -> DataFrame:
    nodes, labels = classes_and_links(docs)
    labels = labels.select(F.col("node").alias("rep"), "root")
    return nodes.join(labels, "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def join(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links reach."""
    rooted = _rooted(docs)
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(names, "root").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all its columns.

    Rows that share id and text are told apart by nothing else, so one of them stays.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")
    kept = written(_rooted(docs).groupBy("root").agg(F.min(first).alias("first")), "jaccard-kept")
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.tie").alias("kept_tie")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    tie = F.xxhash64("row.text")
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (tie == F.col("kept_tie"))
    chosen = packed.join(kept, same)
    # Ids that occur once need no second look; their rows are the bulk and are not sorted.
    often = written(only(docs, repeated="doc_id").groupBy(F.col("repeated").cast("long").alias("repeated")).count().filter("count > 1"), "jaccard-repeated")
    again = F.col("kept_id").eqNullSafe(F.col("repeated"))
    single = chosen.join(often, again, "left_anti").select("row.*")
    if often.isEmpty():
        return single
    place = F.row_number().over(Window.partitionBy("kept_id", "kept_tie").orderBy(F.xxhash64("row")))
    return single.union(chosen.join(often, again, "left_semi").withColumn("place", place).filter("place = 1").select("row.*"))
