"""Mix sources to target weights: Pareto order sampling after whole copies. DataFrame functions only.

A source's target is its share of the mix by weight, stopped at ``max_repeats`` times its size; what is stopped is
shared again among the others. Every document gets the whole copies of target / size for certain. The rest is a
Pareto order sample: a document has odds u / (1 - u) for its uniform number u and inclusion odds p / (1 - p); the
smallest quotients of the two are taken until their words are nearest to what the target still needs.

Inclusion probabilities differ: within a source, documents of at least its mean size are likelier than shorter ones.
With p the part of the source's words still needed, and L and S the words of its long and short documents, long ones
have p + d S / max(L, S) and short ones p - d L / max(L, S), where d is FAVOUR of the room that p leaves up to 0 or 1.
So the expected words are those needed, whatever the sizes, and ``favour=0`` gives all documents the same chance.

The order is cut in two steps, so that no source has to fit into one task: words are summed per source and slice of
the quotient, and only the slice in which the cut falls is ordered. A cut is a pair of quotient and doc_id per source,
so taking a document is a function of its row: reruns and lost executors give the same mix.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source, last in order; a null doc_id
counts as the smallest one; rows with equal source and doc_id are taken or left together; an empty table gives an
empty plan; further columns are ignored by the plan and kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from evenhand.llm.common import only, word_count, written

SLICES = 4096
NO_ID = -(2**63)
MAX_BROADCAST_SOURCES = 100_000  # rows of a name and a dozen numbers
FAVOUR = 0.5


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def quotient(u: Column, p: Column) -> Column:
    """Odds of u over odds of p as q / (1 + q), which orders alike and lies in [0, 1]; u itself where p is 0 or 1."""
    own = u * (F.lit(1.0) - p)
    return F.when((p > 0) & (p < 1), own / (own + p * (F.lit(1.0) - u))).otherwise(u)


def targets(sizes: DataFrame, weights: Sequence[int], total_share: float, max_repeats: float) -> DataFrame:
    """Per source (source, source_size) its target: the level that fills all sources by weight, stopped at their caps.

    The windows have one part because they run over sources, of which a corpus has few, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place))
    cap = F.col("source_size") * F.lit(float(max_repeats))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) * F.lit(float(total_share)) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    free = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = weighed.withColumn("level", rest / free).withColumn("place", F.row_number().over(fill))
    holds = F.when(F.col("level") * F.col("weight") <= cap, F.col("place"))
    first = levelled.withColumn("first", F.min(holds).over(everything))
    level = F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything)
    return first.withColumn("target", F.least(cap, F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def _small(per_source: DataFrame) -> DataFrame:
    """A written table with a row per source, sent to all executors if it is counted to be small."""
    return F.broadcast(per_source) if per_source.count() <= MAX_BROADCAST_SOURCES else per_source


def plan(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    total_share: float = 1.5,
    max_repeats: float = 2.0,
    seed: str = "mix",
    slices: int = SLICES,
    favour: float = FAVOUR,
) -> tuple[DataFrame, DataFrame]:
    """The sized documents (doc_id, source, size, u) and the plan per source.

    The plan: source, source_size, docs, target, whole (copies of each document), quota (words beyond them), p_long and
    p_short (inclusion probabilities), cut and cut_id (last extra document).
    """
    sized = only(docs, doc_id="doc_id", source="source", text="text").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), uniform(F.col("doc_id"), seed).alias("u")
    )
    sized = written(sized, "mix-sizes")
    of_source = Window.partitionBy("source")  # one row per size by then
    per_size = sized.groupBy("source", "size").agg(F.count("*").alias("n")).withColumn("words", F.col("size") * F.col("n"))
    per_size = per_size.withColumns({"source_size": F.sum("words").over(of_source), "docs": F.sum("n").over(of_source)})
    sources = per_size.groupBy("source", "source_size", "docs").agg(
        F.sum(F.when(F.col("size") >= F.col("source_size") / F.col("docs"), F.col("words")).otherwise(F.lit(0))).alias("long_words")
    )
    sources = written(sources, "mix-sources")
    wanted = targets(sources.select("source", "source_size"), weights, total_share, max_repeats).withColumnRenamed("source", "of")
    wanted = wanted.drop("source_size").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = wanted.withColumns({"whole": F.floor(ratio), "p": ratio - F.floor(ratio)})
    short_words = F.col("source_size") - F.col("long_words")
    wanted = wanted.withColumns(
        {
            "quota": F.col("target") - F.col("whole") * F.col("source_size"),
            "spread": F.least(F.col("p"), F.lit(1.0) - F.col("p")) * F.lit(float(favour)),
            "most": F.greatest(F.col("long_words"), short_words, F.lit(1)),
        }
    ).withColumns(
        {
            "p_long": F.col("p") + F.col("spread") * (short_words / F.col("most")),
            "p_short": F.col("p") - F.col("spread") * (F.col("long_words") / F.col("most")),
        }
    ).drop("p", "spread", "most", "long_words")
    wanted = _small(written(wanted, "mix-targets"))

    placed = sized.join(wanted.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("place", _place())
    per_slice = placed.groupBy("source", "quota", F.floor(F.col("place") * slices).alias("slice")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = written(per_slice, "mix-slices").withColumn("until", F.sum("words").over(running))
    below = F.col("until") <= F.col("quota")
    crossing = reached.filter((F.col("quota") > 0) & ~below & (F.col("until") - F.col("words") <= F.col("quota"))).select(
        F.col("source").alias("cut_source"), F.col("slice").alias("cut_slice"), (F.col("until") - F.col("words")).alias("taken_before")
    )
    crossing = _small(written(crossing, "mix-crossing"))
    # Slices below the crossing one are taken whole; inside it, keys that rows share are summed first.
    inside = placed.join(
        crossing, F.col("source").eqNullSafe(F.col("cut_source")) & (F.floor(F.col("place") * slices) == F.col("cut_slice"))
    ).groupBy("source", "cut_slice", "quota", "taken_before", "place", F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("place", "id")
    so_far = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("taken_before")
    extra = inside.withColumn("fits", so_far + F.col("words") / 2 <= F.col("quota"))
    last = extra.filter("fits").groupBy("source").agg(F.max(F.struct("place", "id")).alias("last"))
    crossed = crossing.alias("c").join(last.alias("l"), F.col("c.cut_source").eqNullSafe(F.col("l.source")), "left").select(
        "cut_source",
        F.coalesce(F.col("l.last.place"), F.col("cut_slice") / F.lit(float(slices))).alias("cut"),
        F.coalesce(F.col("l.last.id"), F.lit(NO_ID)).alias("cut_id"),
        F.col("l.last").isNull().alias("cut_open"),
    )
    names = ["source", "source_size", "docs", "target", "whole", "quota", "p_long", "p_short", "cut", "cut_id", "cut_open"]
    planned = wanted.join(crossed, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(*names, F.col("cut").isNull().alias("no_cut"))
    return sized, _small(written(planned, "mix-plan"))


def _place() -> Column:
    """Where a document stands in its source's order, from its size and u and its source's plan."""
    is_long = F.col("size") >= F.col("source_size") / F.col("docs")
    return quotient(F.col("u"), F.when(is_long, F.col("p_long")).otherwise(F.col("p_short")))


def _extra() -> Column:
    """One further copy for a document before its source's cut; without a cut all of them, unless nothing is needed."""
    at = (F.col("place") == F.col("cut")) & (F.coalesce(F.col("doc_id"), F.lit(NO_ID)) <= F.col("cut_id")) & ~F.col("cut_open")
    return F.when(F.col("no_cut"), F.col("quota") > 0).otherwise((F.col("place") < F.col("cut")) | at).cast("long")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized, planned = plan(docs, **settings)
    chosen = sized.join(planned.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")))
    chosen = chosen.withColumn("place", _place())
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + _extra())).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with their own columns."""
    _, planned = plan(docs, **settings)
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").alias("doc_source"), "doc_id",
        word_count(F.col("text")).alias("size"), uniform(F.col("doc_id"), settings.get("seed", "mix")).alias("u"),
    )
    chosen = packed.join(planned, F.col("doc_source").eqNullSafe(F.col("source"))).withColumn("place", _place())
    copies = F.col("whole") + _extra()
    repeated = chosen.filter(copies > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    return repeated.select("row.*")
