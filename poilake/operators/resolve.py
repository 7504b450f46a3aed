"""Entity resolution: which rows of several sources are the same place.

A place starts a cluster (is a *seed*) unless an earlier place that is itself a seed
matches it; every other place belongs to its earliest matching seed. That is what a
sequential pass over the places in order yields, and it is not transitive.

Two places match when they are less than ``near`` metres apart, or less than ``far``
metres apart with names more similar than ``min_sim``. The pairs of matching places can
be quadratic in the number of places on one spot, so they are never listed. Instead:

* rows of equal coordinates and name key become one node;
* places of one tight cell always match, so only the earliest open node of each tight
  cell can be the next seed there;
* such candidates that no earlier candidate matches are pairwise non-matching, hence at
  least ``near`` metres apart, and a node has only a bounded number of them in reach;
* an ordered chain of places would need a round per link that way, so tiles of bounded size
  are walked in order by one task each, as far as what lies beyond their borders allows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake import constants as K
from poilake.functions.geodesy import (
    ECCENTRICITY_SQ,
    EQUATOR_RADIUS,
    SHORTEST_DEGREE,
    SHORTEST_EQUATOR_DEGREE,
    distance_m,
    reach_cell,
    reach_cells,
    tight_cell,
)
from poilake.functions.text import blank_to_null, key_similarity, may_exceed, similarity_above, token_sort_key
from poilake.operators.dedup import union_sources
from poilake.operators.names import similar_keys
from poilake.operators.nearby import key_lists, nearest_alike
from poilake.operators.order import global_index
from poilake.session import materialize, scratch_path, store
from poilake.sources.files import delete_folder

_SPOT = ["lat", "lon", "name_key"]
#: Nodes that one task walks in order, and the sizes of tiles as powers of two of the smallest.
TILE_NODES, LEVELS = 8192, (0, 2, 4, 6)


@dataclass(frozen=True)
class MatchRule:
    """When two places are the same."""

    near: float = K.NEAR_METERS
    far: float = K.FAR_METERS
    min_sim: int = K.MIN_SIMILARITY
    fold: str = "drop_latin1"


def _reached(probes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of a probe (columns ``p_*``) and another node in the cells around it, with their distance.

    The probes are copied to the cells around them; the nodes are not.
    """
    spread = probes.select(
        F.col("idx").alias("p_idx"),
        F.col("lat").alias("p_lat"),
        F.col("lon").alias("p_lon"),
        F.col("name_key").alias("p_key"),
        F.explode("around").alias("reach"),
    )
    pairs = spread.join(nodes.select("idx", *_SPOT, "reach"), "reach").where(F.col("p_idx") != F.col("idx"))
    distance = distance_m(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    return pairs.withColumn("distance_m", distance)


def _matches(probes: DataFrame, nodes: DataFrame, rule: MatchRule) -> DataFrame:
    """Matching pairs (p_idx, idx) with distance and, between ``near`` and ``far``, similarity."""
    ring = F.col("distance_m") >= rule.near
    alike = may_exceed(F.col("p_key"), F.col("name_key"), rule.min_sim)
    pairs = _reached(probes, nodes).where(~ring | ((F.col("distance_m") < rule.far) & alike))
    # Names are compared only in the ring.
    named = pairs.withColumn("similarity", key_similarity(F.col("p_key"), F.col("name_key"), needed=ring))
    matched = named.where(~ring | (F.col("similarity") > rule.min_sim))
    return matched.select("p_idx", "idx", "distance_m", "similarity")


def place_nodes(places: DataFrame, order: Sequence[str], rule: MatchRule = MatchRule()) -> DataFrame:
    """One node per spot and name key, numbered by the earliest of its rows.

    Columns: ``idx, lat, lon, name_key`` and the cells of the node.
    """
    lat, lon = F.col("lat"), F.col("lon")
    keyed = places.where(lat.isNotNull() & lon.isNotNull()).select(
        "lat", "lon", token_sort_key(F.col("name"), rule.fold).alias("name_key"),
        F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).alias("_first"),
    )
    spots = keyed.groupBy(*_SPOT).agg(F.min("_first").alias("_first"))
    celled = spots.withColumns(
        {
            "reach": reach_cell(lat, lon, rule.far),
            "around": reach_cells(lat, lon, rule.far),
            "tight": tight_cell(lat, lon, rule.near),
        }
    )
    return global_index(celled, ["_first", *_SPOT]).drop("_first")


def _tiled(nodes: DataFrame, rule: MatchRule, turn: int) -> DataFrame:
    """The nodes with a square tile (``level, row, col``) of at most ``TILE_NODES`` of them, and
    whether they lie within reach of its ``border``.

    Each node is in the largest such tile of a nested grid; nodes of a crowded smallest tile are
    left out. The grid moves from turn to turn, so what lies on a border does not stay there.
    """
    side = 4 * rule.far / SHORTEST_DEGREE
    shift = F.lit(side * (1 << LEVELS[-1]) * (turn * 0.618 % 1))
    y, x = F.col("lat") + 90 + shift, F.pmod(F.col("lon"), F.lit(360.0))
    celled = nodes.withColumns({"_r": F.floor(y / side), "_c": F.floor((x + shift) / side)})
    counts = celled.groupBy("_r", "_c").agg(F.count("*").alias("n"))
    spread = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct("_r", "_c", "n", F.lit(j).alias("level"), F.shiftright("_r", j).alias("row"), F.shiftright("_c", j).alias("col"))
                    for j in LEVELS
                ]
            )
        )
    )
    fits = spread.groupBy("level", "row", "col").agg(F.sum("n").alias("all")).where(F.col("all") <= TILE_NODES)
    widest = spread.join(fits, ["level", "row", "col"]).groupBy("_r", "_c").agg(
        F.max(F.struct("level", "row", "col")).alias("tile")
    )
    wide = F.lit(side) * F.pow(F.lit(2.0), F.col("level"))
    edge_y = F.lit(1.001 * rule.far / SHORTEST_DEGREE)
    highest = F.least(F.abs(F.col("lat")) + edge_y, F.lit(89.99))
    edge_x = F.lit(1.001 * rule.far / SHORTEST_EQUATOR_DEGREE) / F.cos(F.radians(highest))

    def at_edge(value: Column, width: Column, edge: Column) -> Column:
        inside = F.pmod(value, width)
        return (inside < edge) | (inside > width - edge)

    border = at_edge(y, wide, edge_y) | at_edge(x + shift, wide, edge_x) | at_edge(x, F.lit(360.0), edge_x)
    placed = celled.join(widest, ["_r", "_c"]).select("tile.*", *nodes.columns)
    return placed.withColumn("border", border)


def _meters(a: tuple, b: tuple) -> float:
    """``distance_m`` of two (lat, lon, ...)."""
    middle = math.radians((a[0] + b[0]) / 2)
    bend = 1 - ECCENTRICITY_SQ * math.sin(middle) ** 2
    north = EQUATOR_RADIUS * (1 - ECCENTRICITY_SQ) / (bend * math.sqrt(bend)) * math.radians(a[0] - b[0])
    turn = (a[1] - b[1] + 540) % 360 - 180
    east = EQUATOR_RADIUS / math.sqrt(bend) * math.cos(middle) * math.radians(turn)
    return math.sqrt(north * north + east * east)


def _settler(rule: MatchRule):
    """The sequential rule inside one tile: which of its nodes are seeds or belong to one for sure."""

    def match(a: tuple, b: tuple) -> bool | None:
        """None where rounding could decide."""
        meters = _meters(a, b)
        if min(abs(meters - rule.near), abs(meters - rule.far)) < 1e-6:
            return None
        if meters < rule.near or meters >= rule.far:
            return meters < rule.near
        if a[2] is None or b[2] is None:
            return False
        return similarity_above(a[2], b[2], rule.min_sim)

    def settle(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("idx")
        seeds, unsure, unsure_tight, out = defaultdict(list), defaultdict(list), set(), []
        columns = ["idx", "lat", "lon", "name_key", "reach", "around", "tight", "border"]
        for idx, lat, lon, key, reach, around, tight, border in zip(*(tile[c].tolist() for c in columns)):
            node = (lat, lon, key if isinstance(key, str) else None)
            taken = False
            for seed in (s for cell in around for s in seeds[cell]):
                answer = match(seed, node)
                if answer:
                    taken = True
                    break
                border = border or answer is None
            if taken:
                out.append((idx, False))
                continue
            # An earlier node that is not decided, or one beyond the border, may still take it.
            if not border and tight not in unsure_tight:
                border = any(match(u, node) is not False for cell in around for u in unsure[cell])
            if border or tight in unsure_tight:
                unsure[reach].append(node)
                unsure_tight.add(tight)
            else:
                seeds[reach].append(node)
                out.append((idx, True))
        return pd.DataFrame(out, columns=["idx", "seed"]).astype({"idx": "int64", "seed": "bool"})

    return settle


def _tile_round(open_nodes: DataFrame, n: int, rule: MatchRule, turn: int) -> DataFrame:
    """Decided nodes (idx, seed): whole chains at once, where they stay inside their tiles.

    The last ``TILE_NODES`` open nodes are one tile without a border.
    """
    if n > TILE_NODES:
        tiled = _tiled(open_nodes, rule, turn)
    else:
        tiled = open_nodes.withColumns({**{c: F.lit(0) for c in ("level", "row", "col")}, "border": F.lit(False)})
    settled = tiled.groupBy("level", "row", "col").applyInPandas(_settler(rule), "idx long, seed boolean")
    return materialize(settled, "settled")


def _wide_round(open_nodes: DataFrame, rule: MatchRule) -> DataFrame:
    """Decided nodes (idx, seed): those earlier than all open nodes they match, and what they take.

    The earliest open node is always among them. The probes, not the nodes, are copied, so a
    spot of any size is settled without a task of its own.
    """
    spark = open_nodes.sparkSession
    row = F.struct("idx", *_SPOT, "reach", "around")
    first = open_nodes.groupBy("tight").agg(F.min_by(row, "idx").alias("c")).select("c.*")
    beaten = _reached(first, first).where((F.col("idx") < F.col("p_idx")) & (F.col("distance_m") < rule.near))
    paths = [scratch_path(spark, "leading"), scratch_path(spark, "pairs")]
    leading = store(first.join(beaten.select(F.col("p_idx").alias("idx")), "idx", "left_anti"), paths[0])
    pairs = store(_matches(leading, open_nodes, rule).select("p_idx", "idx"), paths[1])
    late = pairs.where(F.col("idx") < F.col("p_idx")).select(F.col("p_idx").alias("idx"))
    seeds = leading.join(late, "idx", "left_anti").select("idx", F.lit(True).alias("seed"))
    # A node that a seed takes is no seed itself, as seeds are earlier than all they match.
    taken = pairs.join(seeds.select(F.col("idx").alias("p_idx")), "p_idx", "left_semi").select("idx").distinct()
    done = materialize(seeds.unionByName(taken.withColumn("seed", F.lit(False))), "settled")
    for path in paths:
        delete_folder(spark, path)
    return done


def _seeds(nodes: DataFrame, rule: MatchRule) -> DataFrame:
    """All seeds (idx, spot and cells).

    Tiles settle the ordered chains inside them at once; where they decide less than half of the
    open nodes, as on borders and in crowded tiles, a wide round follows, which always decides
    at least one node, so no round limit is needed. State is written to the shared folder, so a
    lost executor costs part of one round at most.
    """
    spark, open_nodes, open_path, found, turn = nodes.sparkSession, nodes, None, [], 0
    n, in_tiles = nodes.count(), True
    while n:
        done = _tile_round(open_nodes, n, rule, turn) if in_tiles else _wide_round(open_nodes, rule)
        found.append(done.where("seed").select("idx"))
        next_path = scratch_path(spark, "open")
        open_nodes = store(open_nodes.join(done.select("idx"), "idx", "left_anti"), next_path)
        if open_path:
            delete_folder(spark, open_path)
        left = open_nodes.count()
        open_path, n, in_tiles, turn = next_path, left, not in_tiles or 2 * left < n, turn + 1
    if open_path:
        delete_folder(spark, open_path)
    chosen = union_sources(*found) if found else nodes.select("idx").limit(0)
    return materialize(nodes.join(chosen, "idx", "left_semi").select("idx", *_SPOT, "around"), "seeds")


def _seed_matches(nodes: DataFrame, seeds: DataFrame, rule: MatchRule) -> DataFrame:
    """Every (seed_idx, idx) match of a seed with a later node."""
    found = _matches(seeds, nodes, rule).where(F.col("p_idx") < F.col("idx"))
    return found.withColumnRenamed("p_idx", "seed_idx")


def match_pairs(places: DataFrame, order: Sequence[str], rule: MatchRule = MatchRule()) -> DataFrame:
    """Every later node each seed matches, with distance and name similarity.

    Columns: ``seed_idx, idx, distance_m, similarity`` (null below ``near``, where names
    do not matter); ``place_nodes`` of the same input says what the numbers stand for.
    """
    nodes = place_nodes(places, order, rule)
    return _seed_matches(nodes, _seeds(nodes, rule), rule)


def greedy_clusters(places: DataFrame, order: Sequence[str], rule: MatchRule = MatchRule()) -> DataFrame:
    """The places with ``cluster``, the position of their seed.

    ``order`` names the columns that order the rows; the first source of choice comes first,
    and rows that tie go by position and name. Rows without coordinates match nothing and get
    a null cluster.
    """
    nodes = place_nodes(places, order, rule)
    seeds = _seeds(nodes, rule)
    own = seeds.select("idx", F.col("idx").alias("seed_idx"))
    joined = _seed_matches(nodes, seeds, rule).select("idx", "seed_idx")
    membership = own.unionByName(joined).groupBy("idx").agg(F.min("seed_idx").alias("cluster"))
    spots = nodes.select("idx", *_SPOT).join(membership, "idx").select(*_SPOT, "cluster")
    keyed = places.withColumn("name_key", token_sort_key(F.col("name"), rule.fold))
    return keyed.join(spots, _SPOT, "left").drop("name_key").select(*places.columns, "cluster")


def collapse_clusters(clustered: DataFrame, order: Sequence[str], primary: str = "google") -> DataFrame:
    """One row per cluster: the primary record's name, spot and category, the mean of the
    known ratings, the sorted sources and the size (D16).

    The primary record is the first of the primary source, else the first of all; where
    ``order`` ties, the record's own content decides. Rows without a cluster stay as they are,
    one cluster each.
    """
    record = ["name", "lat", "lon", "category"]
    rank = F.struct(
        F.when(F.col("source") == primary, 0).otherwise(1).alias("_p"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate([*order, *record])],
    )
    best = F.min_by(F.struct(*record), rank)
    placed = clustered.where(F.col("cluster").isNotNull())
    merged = placed.groupBy("cluster").agg(
        best.alias("_best"),
        F.avg("rating").alias("rating"),
        F.concat_ws(",", F.sort_array(F.collect_set("source"))).alias("sources"),
        F.count("*").alias("cluster_size"),
    ).select(
        "_best.name", "_best.lat", "_best.lon", "rating", "sources", "_best.category", "cluster_size"
    )
    alone = clustered.where(F.col("cluster").isNull()).select(
        "name", "lat", "lon", "rating", F.col("source").alias("sources"), "category", F.lit(1).cast("long").alias("cluster_size")
    )
    return merged.unionByName(alone)


def merge_sources(
    sources: Sequence[DataFrame], priority: Sequence[str] = ("google", "osm"), rule: MatchRule = MatchRule()
) -> DataFrame:
    """Union the normalised sources, cluster and collapse them.

    Each source has the columns source, source_id, name, lat, lon, rating, category, and may
    have its ``position`` in the source's list; ``priority`` lists the sources, first choice
    first. Places are walked by priority, source, position and id, and where these tie by
    their content, so the result does not depend on how the rows are partitioned.
    """
    shape = ["source", "source_id", "name", "lat", "lon", "rating", "category"]
    empty = F.lit(None).cast("long")
    places = union_sources(
        *[s.select(*shape, (F.col("position") if "position" in s.columns else empty).alias("position")) for s in sources]
    )
    rank = F.lit(len(priority))
    for i, source in reversed(list(enumerate(priority))):
        rank = F.when(F.col("source") == source, i).otherwise(rank)
    ranked = places.withColumn("_priority", rank)
    order = ["_priority", "source", "position", "source_id", "name", "lat", "lon", "rating", "category"]
    clustered = greedy_clusters(ranked, order, rule)
    return collapse_clusters(clustered, order, primary=priority[0])


def search_key(name: Column, city: str | None = None, fold: str = "unaccent") -> Column:
    """What a place search compares: the sorted words, without those of the city."""
    key = token_sort_key(name, fold)
    if city:
        drop = F.split(token_sort_key(F.lit(city), fold), " ")
        key = F.array_join(F.array_except(F.split(key, " "), drop), " ")
    return blank_to_null(key)


def enrich(
    candidates: DataFrame,
    places: DataFrame,
    city: str,
    rank: Sequence[Column],
    fold: str = "unaccent",
    least: float = 0.6,
    within: float | None = None,
) -> DataFrame:
    """Each candidate with the best place found for "name, city"; candidates without one are dropped.

    The remote search becomes a similarity join of the distinct search keys: word order does not
    matter, misspelt names match if their grams are ``least`` alike. The most similar name
    wins, then ``rank`` (ascending) among its places. Only the best place of a key can be the
    answer, so places are reduced to one row per key before they are joined. Runs the similarity
    join when called.

    ``within`` metres makes it a search around the candidate: both sides need ``lat`` and
    ``lon``, places farther away are no hit, and among equally similar names the nearest place
    wins, then ``rank``. Places with one key on one spot are one row of that search, so are
    candidates.

    The place comes back as the struct column ``google_data``, with ``similarity`` and, for a
    search around the candidate, ``distance_m``. Names without letters or digits, and null
    ones, find nothing; without coordinates there is no place around. Candidates that repeat
    stay repeated.
    """
    record = F.struct(*[F.col(c) for c in places.columns])
    own = ["_lat", "_lon"] if within else []
    found, asked = (
        rows.withColumns({"_query": search_key(F.col("name"), city, fold), **{c: F.col(c[1:]) for c in own}})
        for rows in (places, candidates)
    )
    order = F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(rank)])
    best = found.dropna(subset=["_query", *own]).groupBy("_query", *own).agg(
        F.min_by(record, order).alias("google_data"), F.min(order).alias("_rank")
    )
    best = best.withColumnsRenamed({"_query": "_key", "_lat": "_plat", "_lon": "_plon"})
    nodes = materialize(asked.select("_query", *own).dropna().distinct(), "asked")
    known = found.dropna(subset=["_query", *own]).select(F.col("_query").alias("key"))
    alike = similar_keys(nodes.select(F.col("_query").alias("key")), known, least)
    alike = materialize(alike.select(F.col("left_key").alias("_query"), F.col("right_key").alias("_key"), "similarity"), "alike")
    # The tables are of compressed names, whose broadcast could fill the driver: all joins merge.
    if not within:
        closest = alike.groupBy("_query").agg(F.max("similarity").alias("_most"))
        closest = alike.join(closest.hint("merge"), "_query").where("similarity = _most")
        answer = F.min_by(F.struct("google_data", "similarity"), F.struct("_rank", "_key"))
        answers = closest.join(best.hint("merge"), "_key").groupBy("_query").agg(answer.alias("_answer"))
        found = asked.join(answers.hint("merge"), "_query")
        return found.select(*candidates.columns, "_answer.google_data", "_answer.similarity")
    keys = global_index(alike.select("_key").distinct(), ["_key"], "key_id")
    # Only places whose name is alike to one asked for; numbered once stored.
    spots = best.join(keys.hint("merge"), "_key").drop("_key").withColumn("spot", F.monotonically_increasing_id())
    spots = materialize(spots, "spots")
    found = nearest_alike(nodes, spots.select("spot", "key_id", "_plat", "_plon"), key_lists(alike, keys), within)
    met = found.join(spots.hint("merge"), "spot")
    meters = distance_m(*(F.col(c) for c in ("_lat", "_lon", "_plat", "_plon")))
    met = met.withColumn("distance_m", meters).where(F.col("distance_m") <= within)
    # Keys are numbered in their order.
    order = F.struct(-F.col("similarity"), "distance_m", "_rank", "key_id")
    answer = F.min_by(F.struct("google_data", "similarity", "distance_m"), order)
    answers = met.groupBy("_query", *own).agg(answer.alias("_answer")).select("_query", *own, "_answer.*")
    found = asked.join(answers.hint("merge"), ["_query", *own])
    return found.select(*candidates.columns, "google_data", "similarity", "distance_m")
