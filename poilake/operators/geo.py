"""District assignment and map aggregates."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poilake import constants as K
from poilake.functions.geodesy import distance_sq
from poilake.functions.scores import color_band
from poilake.session import materialize

# A cell with more candidates than this is divided into sixteen, to this depth at most.
_ENOUGH, _DEPTH = 32, 14
# Candidates of a cell that one task divides further in memory.
_ONE_TASK = 50_000
# A cell is left as it is if its parts have on average more than this share of its candidates.
_NO_GAIN = 0.5
# Parts of a cell for each of its candidates, at most: beyond it crowded parts stay as they are.
_PARTS = 64
# Rows whose coordinates are not below this have no place.
_FARTHEST = 1e6
# Copies of a cell's candidates, so that a cell with a third of all rows is spread over tasks.
_SALTS = 8


class _Grid(NamedTuple):
    """The square that all cells divide, and the levels of which there are cells.

    ``only`` holds the few candidates of the one cell that is not divided.
    """

    south: float
    west: float
    side: float
    levels: list[int]
    only: list[Row] | None = None


def _placed(lat: str, lon: str) -> Column:
    return F.coalesce((F.abs(F.col(lat)) < _FARTHEST) & (F.abs(F.col(lon)) < _FARTHEST), F.lit(False))


def _square(rows: DataFrame, lat: str, lon: str) -> tuple[float, float, float]:
    """South and west edge and side of a square around all placed rows."""
    box = rows.where(_placed(lat, lon)).agg(F.min(lat), F.min(lon), F.max(lat), F.max(lon)).first()
    if box[0] is None:
        return 0.0, 0.0, 1.0
    return box[0], box[1], max(box[2] - box[0], box[3] - box[1], 1e-9) * (1 + 1e-9)


def _divided(cells: DataFrame) -> DataFrame:
    """Each (row, col, ...) as the sixteen cells of the next level."""
    quarter = F.array(*[F.lit(i).cast("long") for i in range(4)])
    return (
        cells.withColumn("_up", F.explode(quarter))
        .withColumn("_to", F.explode(quarter))
        .withColumns({"row": F.col("row") * 4 + F.col("_up"), "col": F.col("col") * 4 + F.col("_to")})
        .drop("_up", "_to")
    )


def _refined(level: int, square: tuple[float, float, float], enough: int, lister: Callable):
    """Divides the cell of a group in memory: (level, row, col, items) of its parts with few candidates."""
    south, west, width = square

    def run(table: pa.Table) -> pa.Table:
        items = table.drop_columns(["row", "col"])
        prune = lister(items)
        todo = deque([(level, table["row"][0].as_py(), table["col"][0].as_py(), np.arange(table.num_rows))])
        cells, kept = [], []
        while todo:
            at, row, col, own = todo.popleft()
            parts = []
            if len(own) > enough and at < _DEPTH and len(cells) + len(todo) < _PARTS * table.num_rows:
                side = width / 4 ** (at + 1)
                for i in range(4 * row, 4 * row + 4):
                    for j in range(4 * col, 4 * col + 4):
                        parts.append((at + 1, i, j, prune(own, i * side + south, j * side + west, side)))
                if sum(len(p[3]) for p in parts) > _NO_GAIN * 16 * len(own):
                    parts = []
            if parts:
                todo += [p for p in parts if len(p[3])]
            else:
                cells.append((at, row, col))
                kept.append(own)
        ends = pa.array(np.cumsum([0, *map(len, kept)]), pa.int32())
        chosen = items.take(pa.array(np.concatenate(kept))).to_struct_array().combine_chunks()
        columns = [pa.array(c, kind) for c, kind in zip(zip(*cells), (pa.int32(), pa.int64(), pa.int64()))]
        return pa.table([*columns, pa.ListArray.from_arrays(ends, chosen)], names=["level", "row", "col", "items"])

    return run


def _cells(
    items: DataFrame,
    poi: DataFrame,
    lat: str,
    lon: str,
    prune: Callable[[DataFrame, Column, Column, Column], DataFrame],
    lister: Callable,
    enough: int = _ENOUGH,
) -> tuple[DataFrame | None, _Grid]:
    """Disjoint cells (level, row, col) around the rows with their candidate ``items``.

    A cell is divided into sixteen until few candidates are left, or until that does not lower
    their number any more. ``prune`` keeps the items that can be an answer somewhere in their
    cell; it gets (row, col, item) with the south and west edges and the side of the cell.
    Cells of up to ``_ONE_TASK`` candidates are divided further in memory, one task each, by
    ``lister``, which does the same for a table of items: it returns a function of (places in
    the table, south, west, side). Cells without candidates are left out. Where one cell is
    enough, its items are read here, nothing is stored and the rows are not looked at.
    """
    few = items.limit(enough + 1).collect()
    if len(few) <= enough:
        return None, _Grid(0.0, 0.0, 1.0, [0] if few else [], few)
    square = south, west, width = _square(poi, lat, lon)
    root = F.lit(0).cast("long")
    still, level, most = items.select(root.alias("row"), root.alias("col"), F.struct("*").alias("item")), 0, items.count()
    while most > _ONE_TASK and level < _DEPTH:
        level, before = level + 1, most
        side = F.lit(width / 4**level)
        kept = prune(_divided(still), F.col("row") * side + F.lit(south), F.col("col") * side + F.lit(west), side)
        still = materialize(kept.select("row", "col", "item"), "cells")
        most = still.groupBy("row", "col").count().agg(F.max("count")).first()[0] or 0
        if most >= before:
            break
    kinds = f"level int, row long, col long, items array<{items.schema.simpleString()}>"
    leaves = still.select("row", "col", "item.*").groupBy("row", "col").applyInArrow(_refined(level, square, enough, lister), kinds)
    leaves = materialize(leaves, "leaves")
    levels = sorted(row["level"] for row in leaves.select("level").distinct().collect())
    return leaves, _Grid(*square, levels)


def _literal(value) -> Column:
    """A row, or a value of one, as a column."""
    if isinstance(value, Row):
        return F.struct(*[_literal(v).alias(n) for n, v in value.asDict().items()])
    return F.lit(value)


def _with_candidates(poi: DataFrame, leaves: DataFrame | None, grid: _Grid, lat: str, lon: str) -> DataFrame:
    """``poi`` with ``_items``, the candidates of each row's cell; null where it has no place.

    Every row lies in one cell of one level. The stored cells' size lets Spark send them to all
    tasks while they are small; else rows and cells meet by salted keys. The candidates of one
    cell for all are part of the plan.
    """
    if grid.only is not None:
        return poi.withColumn("_items", F.when(_placed(lat, lon), F.array(*[_literal(item) for item in grid.only])))
    tries = F.array(*[F.lit(n) for n in grid.levels])
    side = F.lit(grid.side) / F.pow(F.lit(4.0), F.col("_level").cast("double"))
    last = F.pow(F.lit(4.0), F.col("_level").cast("double")) - 1

    def cell(at: str, edge: float) -> Column:
        found = F.least(F.greatest(F.floor((F.col(at) - edge) / side), F.lit(0)), last)
        nowhere = F.monotonically_increasing_id()  # spreads rows without a place
        return F.when(F.col("_level") >= 0, found.cast("long")).otherwise(nowhere)

    rows = poi.withColumn("_level", F.explode(F.when(_placed(lat, lon), tries).otherwise(F.array(F.lit(-1))))).withColumns(
        {
            "_row": cell(lat, grid.south),
            "_col": cell(lon, grid.west),
            "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"),
        }
    )
    cells = leaves.select(
        F.col("level").alias("_level"),
        F.col("row").alias("_row"),
        F.col("col").alias("_col"),
        F.col("items").alias("_items"),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"),
    )
    met = rows.join(cells, ["_level", "_row", "_col", "_salt"], "left")
    return met.where(F.col("_items").isNotNull() | (F.col("_level") < 0)).select(*poi.columns, "_items")


def _nearest_lister(k: int):
    """The pruning of ``_nearest_cells`` for a table of centres."""

    def lister(items: pa.Table):
        y, x = (items[c].to_numpy() for c in ("center_lat", "center_lon"))

        def prune(own: np.ndarray, south: float, west: float, side: float) -> np.ndarray:
            points = [(south + up, west + to) for up in (0.0, side) for to in (0.0, side)]
            away = np.array([(p - y[own]) ** 2 + (q - x[own]) ** 2 for p, q in [*points, (south + side / 2, west + side / 2)]])
            n = min(k, len(own))
            rivals = np.unique(np.argpartition(away, n - 1, axis=1)[:, :n])
            beaten = np.zeros(len(own), dtype=np.int64)
            for r in rivals:
                other = away[:4, r : r + 1]
                beaten += (away[:4] > other + (away[:4] + other) * 1e-9).all(axis=0)
            return own[beaten < k]

        return prune

    return lister


def _nearest_cells(centers: DataFrame, k: int, poi: DataFrame, lat: str, lon: str) -> tuple[DataFrame | None, _Grid]:
    """Cells with the centres that are among the ``k`` nearest of some point of the cell.

    Where a centre is nearer than another is a half plane. So if it is nearer at all corners of
    a cell, it is nearer everywhere in it. A centre that ``k`` others beat at all corners is
    left out; these others are the nearest ones of the cell's middle (and of its corners). Of
    centres on one spot only the first ``k`` names can be an answer.
    """
    spots = centers.where(F.col("center_lat").isNotNull() & F.col("center_lon").isNotNull()).select(
        "district_name", "center_lat", "center_lon"
    )
    if k == 1:
        spots = spots.groupBy("center_lat", "center_lon").agg(F.min(F.struct("district_name")).alias("first"))
        spots = spots.select("first.district_name", "center_lat", "center_lon")
    else:
        same = Window.partitionBy("center_lat", "center_lon").orderBy("district_name")
        spots = spots.withColumn("_nth", F.row_number().over(same)).where(F.col("_nth") <= k).drop("_nth")

    def prune(still: DataFrame, south: Column, west: Column, side: Column) -> DataFrame:
        corners = [(south + up, west + to) for up in (F.lit(0.0), side) for to in (F.lit(0.0), side)]
        middle = (south + side / 2, west + side / 2)
        spot = F.struct("item.center_lat", "item.center_lon")

        def away(point, c: Column) -> Column:
            return distance_sq(*point, c["center_lat"], c["center_lon"])

        nth = F.row_number().over(Window.partitionBy("row", "col").orderBy(away(middle, spot)))
        first = still.withColumn("nth", nth).where(F.col("nth") <= k)
        rivals = first.groupBy("row", "col").agg(F.collect_list(spot).alias("rivals"))
        item = F.col("item")

        def loses(r: Column) -> Column:
            out = F.lit(True)
            for p in corners:
                mine, other = away(p, item), away(p, r)
                out = out & (mine > other + (mine + other) * F.lit(1e-9))
            return out

        lost = F.forall("rivals", loses) & (F.size("rivals") >= k)
        return still.join(rivals, ["row", "col"]).where(~lost)

    return _cells(spots, poi, lat, lon, prune, _nearest_lister(k), max(_ENOUGH, 3 * k))


def _by_distance(lat: str, lon: str) -> Column:
    """The candidates as structs (distance_sq, district_name)."""
    return F.transform(
        "_items",
        lambda c: F.struct(
            distance_sq(F.col(lat), F.col(lon), c["center_lat"], c["center_lon"]).alias("distance_sq"),
            c["district_name"].alias("district_name"),
        ),
    )


def assign_nearest(poi: DataFrame, centers: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds ``district_name`` of the nearest centre, ties by name, null without coordinates.

    One plan for dimensions of any size: rows meet the few centres that can be nearest in
    their cell. Rows need no key; repeated rows stay. Centres with a null coordinate are
    ignored, a null name comes before all others. The centres are read when this is called.
    """
    rest = poi.drop("district_name")
    leaves, grid = _nearest_cells(centers, 1, rest, lat, lon)
    if not grid.levels:
        return rest.withColumn("district_name", F.lit(None).cast("string"))
    best = F.array_min(_by_distance(lat, lon))["district_name"]
    return _with_candidates(rest, leaves, grid, lat, lon).withColumn("district_name", best).drop("_items")


def rank_centers(poi: DataFrame, centers: DataFrame, k: int = 1, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The ``k`` nearest centres of each located row with distance and rank.

    Fewer than ``k`` centres are all returned. Ties go by name.
    """
    leaves, grid = _nearest_cells(centers, k, poi, lat, lon)
    if not grid.levels:
        kinds = {"district_name": "string", "distance_sq": "double", "rank_nearest": "int"}
        return poi.where(F.lit(False)).withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()})
    ranked = F.slice(F.array_sort(_by_distance(lat, lon)), 1, k)
    return (
        _with_candidates(poi, leaves, grid, lat, lon)
        .where(F.col("_items").isNotNull())
        .select(*poi.columns, F.posexplode(ranked).alias("_at", "_center"))
        .select(
            *poi.columns,
            F.col("_center.district_name").alias("district_name"),
            F.col("_center.distance_sq").alias("distance_sq"),
            (F.col("_at") + 1).alias("rank_nearest"),
        )
    )


def assign_bbox(
    poi: DataFrame, boxes: DataFrame, default: str = K.UNKNOWN_DISTRICT, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Adds ``district_name`` of the box around each row; the smallest box wins, then the name.

    One plan for any number of boxes: rows meet the boxes that can be the answer in their cell.
    Rows need no key. Boxes with a null edge hold nothing; ``default`` is for rows in no box,
    without coordinates, or in a box without a name.
    """
    edges = ["lat_min", "lat_max", "lon_min", "lon_max"]
    area = (F.col("lat_max") - F.col("lat_min")) * (F.col("lon_max") - F.col("lon_min"))
    # Of equal boxes the first name is the answer, a missing one before all others.
    whole = boxes.dropna(subset=edges).groupBy(*edges).agg(F.min(F.struct("district_name")).alias("first"))
    whole = whole.select(area.alias("area"), "first.district_name", *edges)

    def prune(still: DataFrame, south: Column, west: Column, side: Column) -> DataFrame:
        b = {e: F.col(f"item.{e}") for e in edges}
        slack = side * F.lit(1e-6)  # more than floor() can misplace a row by
        met = still.where(
            (b["lat_min"] <= south + side + slack) & (b["lat_max"] >= south - slack)
            & (b["lon_min"] <= west + side + slack) & (b["lon_max"] >= west - slack)
        ).withColumn("rank", F.struct("item.area", "item.district_name"))
        covers = (
            (b["lat_min"] <= south - slack) & (b["lat_max"] >= south + side + slack)
            & (b["lon_min"] <= west - slack) & (b["lon_max"] >= west + side + slack)
        )
        # A box all over the cell hides those that come after it.
        best = met.groupBy("row", "col").agg(F.min(F.when(covers, F.col("rank"))).alias("best"))
        return met.join(best, ["row", "col"]).where(F.col("best").isNull() | (F.col("rank") <= F.col("best")))

    def lister(items: pa.Table):
        bounds = np.stack([items[e].to_numpy() for e in edges], axis=1)
        by = [("area", "ascending"), ("district_name", "ascending")]
        rank = np.empty(items.num_rows, dtype=np.int64)
        rank[pc.sort_indices(items, by, null_placement="at_start").to_numpy()] = np.arange(items.num_rows)

        def prune(own: np.ndarray, south: float, west: float, side: float) -> np.ndarray:
            slack = side * 1e-6
            low, high = np.array([south, west]) - slack, np.array([south, west]) + side + slack
            own = own[np.argsort(rank[own])]
            down, up = bounds[own][:, [0, 2]], bounds[own][:, [1, 3]]
            met = ((down <= high) & (up >= low)).all(axis=1)
            own, down, up = own[met], down[met], up[met]
            covers = np.flatnonzero(((down <= low) & (up >= high)).all(axis=1))
            if len(covers):
                own, down, up = own[: covers[0] + 1], down[: covers[0] + 1], up[: covers[0] + 1]
            # Of boxes that are the same inside the cell only the first can be the answer there.
            inside = np.concatenate([np.maximum(down, low), np.minimum(up, high)], axis=1)
            return own[np.sort(np.unique(inside, axis=0, return_index=True)[1])] if len(own) else own

        return prune

    rest = poi.drop("district_name")
    leaves, grid = _cells(whole, rest, lat, lon, prune, lister)
    if not grid.levels:
        return rest.withColumn("district_name", F.lit(default))
    y, x = F.col(lat), F.col(lon)
    around = F.filter(
        "_items", lambda b: y.between(b["lat_min"], b["lat_max"]) & x.between(b["lon_min"], b["lon_max"])
    )
    best = F.array_min(F.transform(around, lambda b: F.struct(b["area"], b["district_name"])))["district_name"]
    return (
        _with_candidates(rest, *_padded(leaves, grid), lat, lon)
        .withColumn("district_name", F.coalesce(best, F.lit(default)))
        .drop("_items")
    )


def _padded(leaves: DataFrame | None, grid: _Grid) -> tuple[DataFrame | None, _Grid]:
    """``leaves`` and, without candidates, the cells that they leave uncovered, with all levels.

    Each leaf's ancestors were divided, so the uncovered cells are their children that are
    neither leaves nor ancestors.
    """
    if grid.only is not None:
        return leaves, grid
    cell = leaves.select("level", "row", "col")
    above = cell.where("level > 0").withColumn("up", F.explode(F.sequence(F.lit(1), F.col("level"))))
    scale = F.pow(F.lit(4.0), F.col("up").cast("double"))
    above = above.select(
        (F.col("level") - F.col("up")).alias("level"),
        F.floor(F.col("row") / scale).alias("row"),
        F.floor(F.col("col") / scale).alias("col"),
    ).distinct()
    children = _divided(above).withColumn("level", F.col("level") + 1).select("level", "row", "col")
    empty = children.join(cell.unionByName(above), ["level", "row", "col"], "left_anti")
    blank = empty.withColumn("items", F.array().cast(leaves.schema["items"].dataType))
    every = list(range(max(grid.levels) + 1))
    return materialize(leaves.unionByName(blank), "padded"), grid._replace(levels=every)


def heat_grid(df: DataFrame, cell: float, weight: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Weight and count per square grid cell of ``cell`` degrees."""
    return (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.floor(F.col(lat) / cell).alias("cell_lat"), F.floor(F.col(lon) / cell).alias("cell_lon"))
        .agg(F.sum(weight).alias("weight"), F.count("*").alias("points"))
    )


def marker_clusters(
    df: DataFrame, zooms: Sequence[int], rating: str = "rating", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Marker count, centroid and commonest colour per map tile at each zoom.

    The rows are aggregated once, at the finest zoom; the coarser tiles, whose edges the
    finer ones share, are sums of those.
    """
    finest = max(zooms)
    tile = 360.0 / 2**finest
    bands = ("green", "orange", "red")
    color = color_band(F.col(rating))
    fine = (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.floor(F.col(lat) / tile).alias("_row"), F.floor(F.col(lon) / tile).alias("_col"))
        .agg(
            F.count("*").alias("_n"),
            F.sum(lat).alias("_lat"),
            F.sum(lon).alias("_lon"),
            *[F.count_if(color == b).alias(f"_{b}") for b in bands],
        )
    )
    steps = F.lit(2).cast("double") ** (F.lit(finest) - F.col("zoom"))
    tiles = fine.select("*", F.explode(F.array(*[F.lit(z) for z in sorted(zooms)])).alias("zoom"))
    sums = tiles.groupBy(
        "zoom", F.floor(F.col("_row") / steps).alias("tile_lat"), F.floor(F.col("_col") / steps).alias("tile_lon")
    ).agg(
        F.sum("_n").alias("markers"),
        F.sum("_lat").alias("_lat"),
        F.sum("_lon").alias("_lon"),
        *[F.sum(f"_{b}").alias(f"_{b}") for b in bands],
    )
    top = F.greatest(*[F.col(f"_{b}") for b in bands])
    commonest = F.when(F.col("_green") == top, "green").when(F.col("_orange") == top, "orange").otherwise("red")
    return sums.select(
        "zoom",
        "tile_lat",
        "tile_lon",
        "markers",
        (F.col("_lat") / F.col("markers")).alias("center_lat"),
        (F.col("_lon") / F.col("markers")).alias("center_lon"),
        commonest.alias("color"),
    )
