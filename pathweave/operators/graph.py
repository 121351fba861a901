"""The directed, weighted street graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.functions import profile as P
from pathweave.functions.geo import haversine
from pathweave.operators.dedup import last_wins
from pathweave.sources.opl import only, tag

#: An edge between two nodes of curated routes costs this share.
OFFICIAL_FACTOR = 0.45


def profiled(ways: DataFrame, compact: bool = False) -> DataFrame:
    """ways (ord, id, tags, refs) plus cost, is_cycleway, is_dismount, dir; others are dropped."""
    ways = ways.withColumns({f"t_{k}": tag(F.col("tags"), k) for k in P.TAGS})  # one look-up a tag
    get = lambda k: F.col(f"`t_{k}`")
    ways = ways.withColumns({f"c_{k}": c for k, c in P.conditions(get).items()})
    shared = {k: F.col(f"c_{k}") for k in P.conditions(get)}
    has = lambda k: F.map_contains_key("tags", F.lit(k))
    own = ways.withColumns({"p": P.profile(get, compact, shared), "is_dismount": P.is_dismount(get), "dir": P.direction(get, has)})
    fields = {"weight": F.col("p.cost"), "is_cycleway": F.col("p.is_cycleway"), "is_dismount": F.col("is_dismount"), "dir": F.col("dir")}
    return only(own, ["ord", "id", "refs"], F.col("p").isNotNull(), **fields)


def segments(ways: DataFrame) -> DataFrame:
    """(ord, id, pos, src, dst) for each pair of adjacent refs; pos from 1."""
    pairs = F.expr("transform(sequence(1, greatest(size(refs) - 1, 1)), i -> struct(i as pos, try_element_at(refs, i) as src, try_element_at(refs, i + 1) as dst))")
    own = ways.where(F.size("refs") >= 2).select("ord", "id", F.explode(pairs).alias("s"))
    return own.select("ord", "id", F.col("s.pos").cast("bigint").alias("pos"), "s.src", "s.dst")


def edges_raw(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Directed edges before dedup: (src, dst, meters, cost, is_cycleway, is_dismount, ord, pos, step).

    A way's refs carry what edges need of it, so ways are read once. Refs meet the node table once; a
    window over each way then pairs neighbours. A segment needs both of its nodes: a missing one
    breaks the way and is not bridged (F8).
    """
    carried = ("weight", "is_cycleway", "is_dismount", "dir")
    refs = ways.where(F.size("refs") >= 2).select("ord", *carried, F.posexplode("refs").alias("pos", "ref"))
    known = refs.join(nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref")
    end = F.lead(F.struct("pos", "ref", "lat", "lon")).over(Window.partitionBy("ord").orderBy("pos"))
    seg = known.select("ord", *carried, "pos", F.col("ref").alias("a"), "lat", "lon", end.alias("z")).where("z.pos = pos + 1")
    meters = haversine(F.col("lat"), F.col("lon"), F.col("z.lat"), F.col("z.lon"))
    own = seg.select("ord", *carried, F.col("z.pos").cast("bigint").alias("pos"), "a", F.col("z.ref").alias("b"), meters.alias("meters"))
    step = lambda a, b, n: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(n).alias("step"))
    fwd, rev = step("a", "b", 0), step("b", "a", 1)
    steps = F.when(F.col("dir") == "fwd", F.array(fwd)).when(F.col("dir") == "rev", F.array(rev)).otherwise(F.array(fwd, rev))
    out = own.select(F.explode(steps).alias("e"), "meters", (F.col("meters") * F.col("weight")).alias("cost"), "is_cycleway", "is_dismount", "ord", "pos")
    return out.select("e.src", "e.dst", "meters", "cost", "is_cycleway", "is_dismount", "ord", "pos", "e.step")


def edges(raw: DataFrame) -> DataFrame:
    """A2: one edge a (src, dst), the last by way, segment and direction, even if it costs more."""
    return last_wins(raw, ["src", "dst"], F.col("ord"), F.col("pos"), F.col("step")).drop("ord", "pos", "step")


def discounted(edge: DataFrame, official_nodes: DataFrame, factor: float = OFFICIAL_FACTOR) -> DataFrame:
    """Edges with both ends on curated routes (any of them) cost a share."""
    on = official_nodes.select("node_id").distinct().withColumn("hit", F.lit(True))
    for end in ("src", "dst"):
        edge = edge.join(on.select(F.col("node_id").alias(end), F.col("hit").alias(f"on_{end}")), end, "left")
    both = F.col("on_src") & F.col("on_dst")
    return edge.withColumn("cost", F.when(both, F.col("cost") * factor).otherwise(F.col("cost"))).select("src", "dst", "meters", "cost", "is_cycleway", "is_dismount")


def amenities(nodes: DataFrame) -> DataFrame:
    """Drinking water and toilets; the name is null where the tag is missing."""
    kind = F.try_element_at("tags", F.lit("amenity"))
    own = nodes.where(kind.isin("drinking_water", "toilets"))
    own = own.select(F.col("id").alias("node_id"), kind.alias("kind"), F.try_element_at("tags", F.lit("name")).alias("name"), "lat", "lon", "ord")
    return last_wins(own, ["node_id"], F.col("ord")).drop("ord")
