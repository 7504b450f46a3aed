"""Which alike place is nearest: a search inside square tiles, without a row for each pair."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poilake.functions.geodesy import ECCENTRICITY_SQ, EQUATOR_RADIUS, SHORTEST_DEGREE, reach_cell, touched_cells
from poilake.session import materialize

#: The side of a tile as a multiple of the reach; rows of a tile that one task takes; pairs that it holds at once.
TILE, TILE_ROWS, PAIRS = 4, 1 << 19, 1 << 20
_ROW = "tile long, part int, kind int, query string, lat double, lon double, key_id long, spot long, key_ids array<long>, similarities array<double>"
_FOUND = "_query string, _lat double, _lon double, spot long, similarity double"


def _meters(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """``distance_m`` of arrays, up to rounding."""
    middle = np.radians((lat1 + lat2) / 2)
    bend = 1 - ECCENTRICITY_SQ * np.sin(middle) ** 2
    north = EQUATOR_RADIUS * (1 - ECCENTRICITY_SQ) / (bend * np.sqrt(bend)) * np.radians(lat1 - lat2)
    turn = (lon1 - lon2 + 540) % 360 - 180
    east = EQUATOR_RADIUS / np.sqrt(bend) * np.cos(middle) * np.radians(turn)
    return np.sqrt(north * north + east * east)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Spots:
    """The places of a tile, those of a key together and by latitude."""

    def __init__(self, key_ids: np.ndarray, lats: np.ndarray, lons: np.ndarray, spots: np.ndarray):
        by = np.lexsort((lats, key_ids))
        self.lats, self.lons, self.spots = lats[by], lons[by], spots[by]
        self.keys, starts = np.unique(key_ids[by], return_index=True)
        self.ends = np.append(starts, len(by))

    def groups(self, key_ids: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one without places here."""
        if not len(self.keys):
            return np.full(len(key_ids), -1)
        at = np.minimum(np.searchsorted(self.keys, key_ids), len(self.keys) - 1)
        return np.where(self.keys[at] == key_ids, at, -1)

    def _first(self, groups: np.ndarray, lats: np.ndarray) -> np.ndarray:
        """Where the places of each group from this latitude on begin."""
        low, high = self.ends[groups], self.ends[groups + 1]
        while (low < high).any():
            middle = (low + high) // 2
            below = (low < high) & (self.lats[np.minimum(middle, len(self.lats) - 1)] < lats)
            low, high = np.where(below, middle + 1, low), np.where(below, high, np.minimum(middle, high))
        return low

    def walk(self, groups: np.ndarray, lats: np.ndarray, lons: np.ndarray, limit: np.ndarray) -> Iterator[tuple]:
        """(pairs, places, metres) outwards from each point, as far as latitudes are within ``limit``, which may shrink meanwhile."""
        first = self._first(groups, lats)
        for step in (1, -1):
            rest, at = np.arange(len(groups)), first - (step < 0)
            while len(rest):
                inside = at < self.ends[groups[rest] + 1] if step > 0 else at >= self.ends[groups[rest]]
                rest, at = rest[inside], at[inside]
                close = np.abs(self.lats[at] - lats[rest]) * SHORTEST_DEGREE <= limit[rest]
                rest, at = rest[close], at[close]
                if len(rest):
                    yield rest, at, _meters(lats[rest], lons[rest], self.lats[at], self.lons[at])
                at = at + step


class _Lists:
    """What is alike to each of some queries and has places here, the most similar first, in tiers of one similarity."""

    def __init__(self, sizes: np.ndarray, key_ids: np.ndarray, similarities: np.ndarray, spots: _Spots):
        groups = spots.groups(key_ids)
        owner = np.repeat(np.arange(len(sizes)), sizes)[groups >= 0]
        self.groups, self.similarities = groups[groups >= 0], similarities[groups >= 0]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (self.similarities[1:] != self.similarities[:-1])
        self.starts = np.append(np.flatnonzero(new), len(owner))
        #: The tiers of list i are those from tiers[i] to before tiers[i + 1].
        self.tiers = np.searchsorted(owner[self.starts[:-1]], np.arange(len(sizes) + 1))


def _nearest(spots: _Spots, lists: _Lists, of: np.ndarray, lats: np.ndarray, lons: np.ndarray, within: float) -> Iterator[tuple]:
    """(points, places, similarities): the nearest place of the first tier that has one, with all that rounding may put before it.

    ``of`` is the list of each point. Where rounding could decide whether a place is within reach, the next tier is taken too.
    """
    slack = max(1e-6, 1e-12 * within)
    tier, last = lists.tiers[of], lists.tiers[of + 1]
    open_ = np.flatnonzero(tier < last)
    while len(open_):
        sizes = lists.starts[tier[open_] + 1] - lists.starts[tier[open_]]
        settled = np.zeros(len(open_), dtype=bool)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PAIRS, prepend=-1))
        for begin, end in zip(cuts, [*cuts[1:], len(open_)]):
            some, n = open_[begin:end], sizes[begin:end]
            at = _ragged(lists.starts[tier[some]], n)
            point = np.repeat(np.arange(len(some)), n)
            groups, y, x = lists.groups[at], lats[some][point], lons[some][point]
            best = np.full(len(some), within + slack)
            limit = best[point]
            for pairs, _, meters in spots.walk(groups, y, x, limit):
                np.minimum.at(best, point[pairs], meters)
                limit[pairs] = np.minimum(limit[pairs], best[point[pairs]] + slack)
            limit = np.minimum(best, within)[point] + slack
            for pairs, places, meters in spots.walk(groups, y, x, limit):
                near = meters <= limit[pairs]
                if near.any():
                    yield some[point[pairs[near]]], spots.spots[places[near]], lists.similarities[at[pairs[near]]]
            settled[begin:end] = best <= within - slack
        tier[open_] += 1
        open_ = open_[~settled & (tier[open_] < last[open_])]


def _answers(query: pa.Array, lats: np.ndarray, lons: np.ndarray, found: list[tuple]) -> pa.RecordBatch:
    point, spot, similarity = (np.concatenate(c) for c in zip(*found))
    columns = [query.take(pa.array(point)), *map(pa.array, (lats[point], lons[point], spot, similarity))]
    return pa.RecordBatch.from_arrays(columns, names=["_query", "_lat", "_lon", "spot", "similarity"])


def _searched(batches: Iterator[pa.RecordBatch], within: float) -> Iterator[pa.RecordBatch]:
    """Answers of sorted rows: of each tile and part its places, then each query's list before its points."""
    here, places, spots, last = None, [], None, None
    for batch in batches:
        tile, part, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        new = np.flatnonzero((tile[1:] != tile[:-1]) | (part[1:] != part[:-1])) + 1
        for begin, end in zip([0, *new], [*new, len(tile)]):
            if begin == end:
                continue
            if here != (tile[begin], part[begin]):
                here, places, spots, last = (tile[begin], part[begin]), [], None, None
            kinds = kind[begin:end]
            first = int(np.searchsorted(kinds != 0, True))
            if first:
                rows = batch.slice(begin, first)
                places.append([rows.column(i).to_numpy(zero_copy_only=False) for i in (6, 4, 5, 7)])
            if first == end - begin or not places:
                continue
            if spots is None:
                spots = _Spots(*(np.concatenate(c) for c in zip(*places)))
            rows, kinds = batch.slice(begin + first, end - begin - first), kinds[first:]
            asked = rows.filter(pa.array(kinds == 1))
            key_ids, similarities = asked.column(8), asked.column(9)
            sizes = np.diff(key_ids.offsets.to_numpy())
            values = [key_ids.flatten().to_numpy(zero_copy_only=False), similarities.flatten().to_numpy(zero_copy_only=False)]
            if last is not None:  # the list that the batch before ended with
                sizes, values = np.append(len(last[0]), sizes), [np.concatenate(v) for v in zip(last, values)]
            of = (np.cumsum(kinds == 1) - (last is None))[kinds == 2]
            if len(sizes):
                last = [v[len(v) - sizes[-1] :].copy() for v in values]
            points = rows.filter(pa.array(kinds == 2))
            if not points.num_rows:
                continue
            lists = _Lists(sizes, *values, spots)
            query, lats, lons = points.column(3), *(points.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            found, held = [], 0
            for answer in _nearest(spots, lists, of, lats, lons, within):
                found.append(answer)
                held += len(answer[0])
                if held > PAIRS:
                    yield _answers(query, lats, lons, found)
                    found, held = [], 0
            if found:
                yield _answers(query, lats, lons, found)


def nearest_alike(points: DataFrame, spots: DataFrame, lists: DataFrame, within: float) -> DataFrame:
    """(_query, _lat, _lon, spot, similarity): for each point the nearest spot within reach of the most similar key that has one.

    ``points`` are distinct (_query, _lat, _lon), ``spots`` distinct (spot, key_id, _plat, _plon) with ``spot`` as their
    number, and ``lists`` give each ``_query`` its ``key_ids`` and ``similarities``, the most similar first. A point may
    have more rows than its answer: spots at nearly the same distance, and those that a part of its tile found.

    Spots are copied to the tiles that their reach touches; points and the lists of their queries go to one tile, where a
    task goes through the tiers of a list until one has a spot, and no pair is written. A tile of many rows is split by key.
    """
    spark = points.sparkSession
    side = TILE * within
    points = points.withColumn("tile", reach_cell(F.col("_lat"), F.col("_lon"), side))
    spots = spots.withColumn("tile", F.explode(touched_cells(F.col("_plat"), F.col("_plon"), within, side)))
    held = points.select("tile").unionByName(spots.select("tile")).groupBy("tile").agg(F.count("*").alias("n"))
    # At most one tile for TILE_ROWS rows comes to the driver.
    crowded = defaultdict(list)
    for row in held.where(F.col("n") > TILE_ROWS).collect():
        crowded[1 << (-(-row["n"] // TILE_ROWS) - 1).bit_length()].append(row["tile"])
    parts = F.lit(1)
    for n, tiles in crowded.items():
        parts = F.when(F.col("tile").isin(tiles), n).otherwise(parts)

    def rows(df: DataFrame, kind: int, **columns) -> DataFrame:
        shape = [c.split() for c in _ROW.split(", ")]
        return df.select(*[columns.get(c, F.lit(kind) if c == "kind" else F.col(c) if c in ("tile", "part") else F.lit(None)).cast(t).alias(c) for c, t in shape])

    all_parts = F.explode(F.sequence(F.lit(0), parts - 1))
    points = points.withColumn("part", all_parts)
    # A query without a list has an empty one, or its points would follow another's.
    named = points.select("_query", "tile").distinct().join(lists.hint("merge"), "_query", "left")
    named = named.withColumns({"parts": parts, "part": all_parts})
    # Zipped first: two filters of one condition, by index, gave wrong elements.
    own = F.filter(F.arrays_zip("key_ids", "similarities"), lambda x: F.pmod(x["key_ids"], F.col("parts")) == F.col("part"))
    named = named.withColumn("own", F.when(F.col("parts") > 1, own))
    together = (
        rows(spots.withColumn("part", F.pmod("key_id", parts)), 0, lat=F.col("_plat"), lon=F.col("_plon"), key_id=F.col("key_id"), spot=F.col("spot"))
        .unionByName(rows(named, 1, query=F.col("_query"), **{c: F.when(F.col("parts") > 1, F.col("own")[c]).otherwise(F.col(c)) for c in ("key_ids", "similarities")}))
        .unionByName(rows(points, 2, query=F.col("_query"), lat=F.col("_lat"), lon=F.col("_lon")))
    )
    # So many partitions whatever their bytes: the work is in the search.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = together.repartition(tasks, "tile", "part").sortWithinPartitions("tile", "part", F.asc_nulls_first("query"), "kind")
    return dealt.mapInArrow(lambda batches: _searched(batches, within), _FOUND)


def key_lists(alike: DataFrame, keys: DataFrame) -> DataFrame:
    """(_query, key_ids, similarities) of pairs (_query, _key, similarity), by the numbers ``key_id`` of the keys; stored."""
    pair = F.struct((-F.col("similarity")).alias("least"), "key_id")
    found = alike.join(keys.hint("merge"), "_key").groupBy("_query").agg(F.sort_array(F.collect_list(pair)).alias("found"))
    lists = found.select(
        "_query", F.col("found.key_id").alias("key_ids"), F.transform("found.least", lambda x: -x).alias("similarities")
    )
    return materialize(lists, "lists")
