"""First-match lookup of points in prioritised boxes.

A box is a row of ``priority, lat_from, lat_to, lon_from, lon_to`` and attributes; of all boxes that hold a point
the one with the lowest priority number wins. Boxes are half-open, ``[from, to)``, unless ``closed``.

A range condition alone would plan a nested-loop join. Here space is cut into square cells, in a few grids by width of
the boxes, each cell keeps the boxes that touch it, and points find their cells by equality joins. A crowded cell is
split into the cells of the next finer grid, again and again; a box that lies behind another one that covers all of a
cell is not kept there. So cells stay small where boxes crowd. The test against the original bounds decides, so the
result is exact at every edge and for any cell size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.fixed_values import borough_rows, zone_rows
from evenhand.operators.joins import HOT_SHARE, MAX_BROADCAST_BYTES, SALTS, fits, salted_join
from evenhand.session import written

ZONE_ATTRS = ["zip", "borough", "neighborhood"]
EDGES = ("lat_from", "lat_to", "lon_from", "lon_to")
BOX = ["priority", *EDGES]
MAX_CELLS = 250_000  # boxes in all cells together that are broadcast
MAX_LOCAL = 50_000  # boxes of which the driver makes the cells
MAX_TOUCHED = 1_000  # cells that one box may touch there
CROWD = 16  # boxes of a cell above which it is split
GROWTH = 8  # entries a box, all cells to be split together, above which splitting has stopped to help
RATIO = 4  # of cell widths from level to level
LOWEST, HIGHEST = -6, 9


def _sql_literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def _sql_row(row: Sequence) -> str:
    return "(" + ", ".join(map(_sql_literal, row)) + ")"


def box_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A short list of boxes as a table that lives in the plan."""
    values = ", ".join(_sql_row(r) for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS boxes(priority, {', '.join([*EDGES, *names])})")


def zone_table(spark: SparkSession) -> DataFrame:
    return box_table(spark, zone_rows(), ZONE_ATTRS)


def borough_table(spark: SparkSession) -> DataFrame:
    return box_table(spark, borough_rows(), ["borough"])


def _inside(box: Column, lat: Column, lon: Column, closed: bool) -> Column:
    upper = Column.__le__ if closed else Column.__lt__
    return (
        (lat >= box["lat_from"]) & upper(lat, box["lat_to"]) & (lon >= box["lon_from"]) & upper(lon, box["lon_to"])
    )


def match_in_list(rows: Sequence[tuple], names: Sequence[str], lat: Column, lon: Column, closed: bool = False) -> Column:
    """Struct of the first matching box of a short literal list, null without a match.

    Needs no join, so it also suits streams. Cost grows with the list: meant for some dozens of boxes.
    """
    kinds = {"priority": "int", **dict.fromkeys(EDGES, "double"), **dict.fromkeys(names, "string")}
    struct = ",".join(f"{name}:{kind}" for name, kind in kinds.items())
    listed = ", ".join(f"struct{_sql_row(row)}" for row in sorted(rows))
    boxes = F.expr(f"cast(array({listed}) as array<struct<{struct}>>)")
    here = (lat != 0.0) & (lon != 0.0)
    return F.when(here, F.get(F.filter(boxes, lambda b: _inside(b, lat, lon, closed)), F.lit(0)))


def borough_of(lat: str, lon: str) -> Column:
    """Borough by the five closed boxes, "Unknown" outside of them and for lost positions."""
    found = match_in_list(borough_rows(), ["borough"], F.col(lat), F.col(lon), closed=True)
    return F.coalesce(found["borough"], F.lit("Unknown"))


def _leveled(boxes: DataFrame, cell: float) -> DataFrame:
    """Boxes with the level whose cells are as wide as they are, or up to RATIO times wider."""
    widest = F.greatest(F.col("lat_to") - F.col("lat_from"), F.col("lon_to") - F.col("lon_from"))
    level = F.ceil(F.ln(F.nullif(widest, F.lit(0.0)) / F.lit(cell)) / F.lit(math.log(RATIO)))
    kept = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), F.coalesce(level, F.lit(LOWEST))))
    return boxes.withColumn("_level", kept.cast("int"))


def _size(cell: float, level: int) -> float:
    return cell * RATIO**level


def _cell_of(value: Column, cell: float) -> Column:
    return F.floor(value / F.lit(cell)).try_cast("int")


def _touched(low: str, high: str, cell: float) -> Column:
    """Indices of all cells an interval touches, computed as for points so that no rounding can part them."""
    return F.explode(F.sequence(_cell_of(F.col(low), cell), _cell_of(F.col(high), cell)))


def _cells_in_driver(boxes: np.ndarray, cell: float) -> pa.Table | None:
    """Rows of ``_level, _cy, _cx, boxes`` from rows of priority and edges; None if there would be too many.

    Grids nest exactly: their widths are powers of four apart, and such a division loses no digit.
    """
    boxes = boxes[(boxes[:, 1] <= boxes[:, 2]) & (boxes[:, 3] <= boxes[:, 4])]
    boxes = boxes[np.lexsort(boxes.T[::-1])]  # by priority, then edges
    boxes = boxes[np.sort(np.unique(boxes[:, 1:], axis=0, return_index=True)[1])]  # of equal edges the first can win
    widest = np.maximum(boxes[:, 2] - boxes[:, 1], boxes[:, 4] - boxes[:, 3])
    with np.errstate(divide="ignore"):
        levels = np.clip(np.ceil(np.log(widest / cell) / math.log(RATIO)), LOWEST, HIGHEST).astype(int)

    def indices(size: float) -> list[np.ndarray]:
        return [np.floor(boxes[:, edge] / size) for edge in (1, 2, 3, 4)]

    none = np.empty((0, 3), dtype=np.int64)
    pushed, kept = none, []
    for level in range(max(levels, default=LOWEST), LOWEST - 1, -1):
        y0, y1, x0, x1 = indices(_size(cell, level))
        own = np.flatnonzero(levels == level)
        counts = (y1[own] - y0[own] + 1) * (x1[own] - x0[own] + 1)
        if len(counts) and (not np.all(counts <= MAX_TOUCHED) or np.abs([y0[own], y1[own], x0[own], x1[own]]).max() >= 2**30):
            return None
        counts = counts.astype(int)
        box = np.repeat(own, counts)
        step = np.arange(len(box)) - np.repeat(np.cumsum(counts) - counts, counts)
        wide = (x1[box] - x0[box] + 1).astype(int)
        native = np.stack([y0[box].astype(int) + step // np.maximum(wide, 1), x0[box].astype(int) + step % np.maximum(wide, 1), box], axis=1)
        rows = np.concatenate([native, pushed])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        if not len(rows):
            continue
        cy, cx, box = rows.T
        starts = np.flatnonzero(np.append(True, (np.diff(cy) != 0) | (np.diff(cx) != 0)))
        number = np.cumsum(np.bincount(starts, minlength=len(rows))) - 1
        covers = (y0[box] < cy) & (cy < y1[box]) & (x0[box] < cx) & (cx < x1[box])
        first_cover = np.minimum.reduceat(np.where(covers, box, len(boxes)), starts)
        rows, number = rows[box <= first_cover[number]], number[box <= first_cover[number]]
        crowded = (np.bincount(number) > CROWD)[number] & (level > LOWEST)
        if crowded.sum() > max(GROWTH * len(boxes), MAX_CELLS // RATIO):
            crowded[:] = False  # so many edges lie so close together that finer cells only repeat them
        kept.append((level, rows[~crowded]))
        split = np.repeat(rows[crowded], RATIO * RATIO, axis=0)
        steps = np.tile(np.arange(RATIO * RATIO), int(crowded.sum()))
        split[:, 0], split[:, 1] = split[:, 0] * RATIO + steps // RATIO, split[:, 1] * RATIO + steps % RATIO
        y0, y1, x0, x1 = indices(_size(cell, level - 1))
        cy, cx, box = split.T
        pushed = split[(y0[box] <= cy) & (cy <= y1[box]) & (x0[box] <= cx) & (cx <= x1[box])]
    rows = np.concatenate([np.column_stack([np.full(len(r), level), r]) for level, r in kept] or [np.empty((0, 4), dtype=np.int64)])
    starts = np.flatnonzero(np.append(True, (np.diff(rows[:, :3], axis=0) != 0).any(axis=1))) if len(rows) else np.empty(0, dtype=int)
    chosen = boxes[rows[:, 3]]
    fields = [pa.array(chosen[:, 0].astype(np.int64)), *[pa.array(chosen[:, edge]) for edge in (1, 2, 3, 4)]]
    listed = pa.ListArray.from_arrays(np.append(starts, len(rows)).astype(np.int32), pa.StructArray.from_arrays(fields, BOX))
    places = [pa.array(rows[starts, at].astype(np.int32)) for at in range(3)]
    return pa.table([*places, listed], names=["_level", "_cy", "_cx", "boxes"])


def _cells_by_tables(boxes: DataFrame, cell: float) -> DataFrame:
    """Rows of ``_level, _cy, _cx`` and box for box tables of any size, a written table per level."""
    leveled = written(_leveled(boxes.groupBy(*EDGES).agg(F.min("priority").cast("bigint").alias("priority")), cell), "boxes")
    levels = [row["_level"] for row in leveled.select("_level").distinct().collect()]
    total, kept, pushed = leveled.count(), [], None
    for level in range(max(levels, default=LOWEST), LOWEST - 1, -1):
        size, parts = _size(cell, level), [] if pushed is None else [pushed]
        if level in levels:
            native = leveled.filter(F.col("_level") == level).withColumn("_cy", _touched("lat_from", "lat_to", size))
            parts.append(native.withColumn("_cx", _touched("lon_from", "lon_to", size)).select("_cy", "_cx", *BOX))
        if not parts:
            continue
        rows = written(reduce(DataFrame.unionByName, parts), "cells")
        inside = [
            (_cell_of(F.col(f"{axis}_from"), size) < F.col(index)) & (F.col(index) < _cell_of(F.col(f"{axis}_to"), size))
            for axis, index in (("lat", "_cy"), ("lon", "_cx"))
        ]
        covers = rows.filter(inside[0] & inside[1]).groupBy("_cy", "_cx").agg(F.min("priority").alias("_cover"))
        seen = salted_join(rows, covers, ["_cy", "_cx"]).filter(F.coalesce(F.col("priority") <= F.col("_cover"), F.lit(True)))
        seen = written(seen.drop("_cover"), "cells")
        crowds = seen.groupBy("_cy", "_cx").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD)
        entries = crowds.agg(F.sum("_n")).first()[0] or 0
        if level == LOWEST or entries > max(GROWTH * total, MAX_CELLS // RATIO):
            crowds = crowds.limit(0)
        marked = written(salted_join(seen, crowds, ["_cy", "_cx"]), "cells")
        kept.append(marked.filter("_n IS NULL").select(F.lit(level).alias("_level"), "_cy", "_cx", *BOX))
        if level > LOWEST and not marked.filter("_n IS NOT NULL").isEmpty():
            finer = _size(cell, level - 1)
            quarters = F.sequence(F.lit(0), F.lit(RATIO - 1))
            split = marked.filter("_n IS NOT NULL").select(*BOX, "_cy", "_cx", F.explode(quarters).alias("_i"))
            split = split.select(*BOX, (F.col("_cy") * RATIO + F.col("_i")).alias("_cy"), "_cx", F.explode(quarters).alias("_j"))
            split = split.select((F.col("_cy")).alias("_cy"), (F.col("_cx") * RATIO + F.col("_j")).alias("_cx"), *BOX)
            pushed = split.filter(
                F.col("_cy").between(_cell_of(F.col("lat_from"), finer), _cell_of(F.col("lat_to"), finer))
                & F.col("_cx").between(_cell_of(F.col("lon_from"), finer), _cell_of(F.col("lon_to"), finer))
            )
        else:
            pushed = None
            if not any(lower < level for lower in levels):
                break
    return reduce(DataFrame.unionByName, kept)


def first_match(
    points: DataFrame,
    boxes: DataFrame,
    attrs: Sequence[str],
    lat: str = "pickup_latitude",
    lon: str = "pickup_longitude",
    *,
    closed: bool = False,
    keep_unmatched: bool = True,
    cell: float = 0.02,
    max_cells: int = MAX_CELLS,
    salts: int = SALTS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add the attributes of the first matching box to every point.

    A point looks up one cell in each grid that has cells. Up to ``max_cells`` boxes in all cells together, and a
    bound in bytes, cells are broadcast and the points are not shuffled at all. Larger ones are joined by a shuffle on
    the cell, over distinct positions only. Up to MAX_LOCAL boxes the driver makes the cells, from literal boxes
    without a job. ``sized_by`` is a table of the same boxes that is cheaper to read.
    """
    spark = points.sparkSession
    geometry = (boxes if sized_by is None else sized_by).select(*BOX).na.drop()
    few = geometry.limit(MAX_LOCAL + 1).collect()
    local = _cells_in_driver(np.array([tuple(row) for row in few], dtype=np.float64).reshape(-1, 5), cell) if len(few) <= MAX_LOCAL else None
    y, x = F.col(lat), F.col(lon)
    names = boxes.coalesce(1) if len(few) <= MAX_LOCAL else boxes  # a bounded table in one task needs no exchange
    names = names.groupBy(*[F.col(c).alias(f"_box_{c}") for c in BOX]).agg(F.min(F.struct(*attrs)).alias("_zone"))
    if local is None or len(local.column("boxes").combine_chunks().flatten()) > max_cells or local.nbytes > MAX_BROADCAST_BYTES:
        rows = _cells_by_tables(geometry, cell) if local is None else spark.createDataFrame(local).select("_level", "_cy", "_cx", F.inline("boxes"))
        levels = None if local is None else sorted(set(local.column("_level").to_pylist()))
        return _first_match_shuffled(points, rows, levels, names, len(few) <= MAX_LOCAL, list(attrs), lat, lon, closed, keep_unmatched, cell, salts)

    here = (y != 0.0) & (x != 0.0)
    cells = spark.createDataFrame(local)
    joined, hits = points, []
    for level in sorted(set(local.column("_level").to_pylist())):
        size, place = _size(cell, level), f"{level - LOWEST}"
        of_level = cells.filter(F.col("_level") == level).select(
            F.col("_cy").alias(f"_cy{place}"), F.col("_cx").alias(f"_cx{place}"), F.col("boxes").alias(f"_boxes{place}")
        )
        joined = joined.withColumns({f"_cy{place}": F.when(here, _cell_of(y, size)), f"_cx{place}": F.when(here, _cell_of(x, size))})
        joined = joined.join(F.broadcast(of_level), [f"_cy{place}", f"_cx{place}"], "left")
        hits.append(F.get(F.filter(f"_boxes{place}", lambda b: _inside(b, y, x, closed)), F.lit(0)))
    kind = "struct<priority:bigint," + ",".join(f"{e}:double" for e in EDGES) + ">"
    best = F.least(*hits) if len(hits) > 1 else hits[0] if hits else F.lit(None).cast(kind)
    found = joined.withColumn("_hit", best)
    if not keep_unmatched:
        found = found.filter(F.col("_hit").isNotNull())
    return _named(found, names, True, points.columns, attrs)


def _named(found: DataFrame, names: DataFrame, small: bool, columns: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Attributes of the boxes in ``_hit``; a bounded table of boxes is broadcast, another one if its bytes allow."""
    found = found.withColumns({f"_box_{c}": F.col("_hit")[c] for c in BOX})
    keys = [f"_box_{c}" for c in BOX]
    if small or fits(names):
        named = found.join(F.broadcast(names), keys, "left")
    else:
        named = salted_join(found, names, keys)
    return named.select(*columns, *[F.col("_zone")[a].alias(a) for a in attrs])


def _first_match_shuffled(points, rows, levels, names, small, attrs, lat, lon, closed, keep_unmatched, cell, salts) -> DataFrame:
    """The way for box tables too large to broadcast.

    Rows at one position share their answer, so positions are counted first. Their candidates fall to one per position
    by a combining ``min``, and the answers go back by a join. Crowded cells and positions are salted; the counts say
    which positions those are.
    """
    if levels is None:
        rows = written(rows, "cells")
        levels = sorted(row["_level"] for row in rows.select("_level").distinct().collect())
    y, x = F.col("_y"), F.col("_x")
    keyed = points.withColumns({"_y": F.col(lat), "_x": F.col(lon)})
    spots = keyed.filter((y != 0.0) & (x != 0.0)).groupBy("_y", "_x").agg(F.count(F.lit(1)).alias("_n"))
    spots = written(spots, "positions")
    total = spots.agg(F.sum("_n")).first()[0] or 0
    often = spots.filter(F.col("_n") >= max(HOT_SHARE * total, 2)).select(F.xxhash64("_y", "_x").alias("key"))
    hot = [row["key"] for row in often.collect()]  # at most 1 / HOT_SHARE
    places = [
        F.struct(F.lit(n).alias("_level"), _cell_of(y, _size(cell, n)).alias("_cy"), _cell_of(x, _size(cell, n)).alias("_cx"))
        for n in levels or [LOWEST]
    ]
    asked = spots.select("_y", "_x", F.inline(F.array(*places)))
    pairs = salted_join(asked, rows, ["_level", "_cy", "_cx"], "inner", salts)
    box = {e: F.col(e) for e in EDGES}
    answers = pairs.filter(_inside(box, y, x, closed)).groupBy("_y", "_x").agg(F.min(F.struct(*BOX)).alias("_hit"))
    joined = salted_join(keyed, answers, ["_y", "_x"], "left" if keep_unmatched else "inner", salts, hot=hot)
    return _named(joined, names, small, points.columns, attrs)
