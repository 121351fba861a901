"""The street, place, region and release jobs as queries over the fixtures."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.functions import geo
from pathweave.functions import profile as P
from pathweave.operators import graph, places, raster, regions, release, spatial_join
from pathweave.operators.components import components, same_component
from pathweave.operators.dedup import first_wins
from pathweave.plans import fixtures as fx
from pathweave.plans.oracle import ORACLE, POINTS
from pathweave.session import cut, prepare, shared_folder
from pathweave.sources import opl, routes, store, tiles

Frame = DataFrame


def _edges(spark: SparkSession, d: str, compact: bool = False) -> DataFrame:
    return graph.edges(_raw(spark, d, compact))


def _raw(spark: SparkSession, d: str, compact: bool = False) -> DataFrame:
    return graph.edges_raw(graph.profiled(fx.ways(spark, d), compact), fx.nodes(spark, d))


def _shown(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst", F.round("meters", 3).alias("meters"), F.round("cost", 3).alias("cost"), "is_cycleway", "is_dismount")


def _located(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 7) for c in ("lat", "lon", "latitude", "longitude") if c in df.columns})


def opl_nodes(spark, d):
    tag = lambda k: F.try_element_at("tags", F.lit(fx.KEYS.get(k, k))).alias(k)
    return _located(fx.nodes(spark, d)).select("id", "lat", "lon", *map(tag, fx.NODE_TAGS))


def opl_ways(spark, d):
    tag = lambda k: F.try_element_at("tags", F.lit(fx.KEYS.get(k, k))).alias(k)
    total = F.aggregate(F.transform("refs", lambda r, i: r * (i + 1)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return fx.ways(spark, d).select("id", F.size("refs").cast("bigint").alias("n_refs"), total.alias("ref_sum"), *map(tag, fx.WAY_TAGS))


def decode_opl(spark, d):
    prepare(spark)
    return spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", opl.decode(opl.encode(F.col("text"))).alias("text"))


def tags_lookup(spark, d):
    return fx.ways(spark, d).select("id", F.explode("tags").alias("k", "v"))


def tags_dup_last_wins(spark, d):
    prepare(spark)
    part = spark.read.parquet(f"{d}/part.parquet")
    raw = F.concat(F.lit("k="), opl.encode(F.col("p_brand")), F.lit(",loose,k="), opl.encode(F.col("p_type")))
    return part.select(F.col("p_partkey").alias("id"), F.try_element_at(opl.tags(raw), F.lit("k")).alias("v"))


def profile_detail(spark, d, compact=False):
    return graph.profiled(fx.ways(spark, d), compact).select("id", F.col("weight").alias("cost"), "is_cycleway")


def profile_compact(spark, d):
    return profile_detail(spark, d, compact=True)


def _tag(k):
    return opl.tag(F.col("tags"), k)


def dismount_flag(spark, d):
    return fx.ways(spark, d).select("id", P.is_dismount(_tag).alias("is_dismount"))


def oneway_class(spark, d):
    return fx.ways(spark, d).select("id", P.direction(_tag, lambda k: F.map_contains_key("tags", F.lit(k))).alias("dir"))


def way_segments(spark, d):
    return graph.segments(fx.ways(spark, d)).select(F.col("id").alias("way_id"), "pos", "src", "dst")


def edges_raw(spark, d):
    return _shown(_raw(spark, d))


def edges_final(spark, d):
    return _shown(_edges(spark, d))


def edges_compact(spark, d):
    return _shown(_edges(spark, d, compact=True))


def nodes_first_wins(spark, d):
    own = fx.nodes(spark, d).select("id", "lat", "lon", "ord")
    later = own.withColumns({"lat": F.col("lat") + 1, "ord": F.col("ord") + (1 << 40)})
    return _located(first_wins(own.unionByName(later), ["id"], F.col("ord")).drop("ord"))


def amenities(spark, d):
    return _located(graph.amenities(fx.nodes(spark, d)))


def haversine(spark, d):
    seg = graph.segments(fx.ways(spark, d)).select(F.col("id").alias("way_id"), "pos", "src", "dst")
    end = lambda c: fx.nodes(spark, d).select(F.col("id").alias(c), F.col("lat").alias(f"{c}_lat"), F.col("lon").alias(f"{c}_lon"))
    own = seg.join(end("src"), "src").join(end("dst"), "dst")
    return own.select("way_id", "pos", F.round(geo.haversine(*map(F.col, ("src_lat", "src_lon", "dst_lat", "dst_lon"))), 3).alias("meters"))


def grid_cells(spark, d):
    return fx.nodes(spark, d).select("id", geo.cell(F.col("lat")).alias("cy"), geo.cell(-F.col("lon")).alias("cx"))


def tile_names(spark, d):
    own = fx.nodes(spark, d)
    return own.select(F.floor("lat").cast("bigint").alias("y"), F.floor("lon").cast("bigint").alias("x"), geo.tile_name(F.col("lat"), F.col("lon")).alias("tile")).distinct()


def official_nearest(spark, d):
    return spatial_join.nearest_within(fx.official(spark, d), fx.nodes(spark, d)).select("idx", "node_id")


def official_nodes(spark, d):
    return routes.official_nodes(fx.official(spark, d), fx.nodes(spark, d))


def edges_discounted(spark, d):
    return _shown(graph.discounted(_edges(spark, d), official_nodes(spark, d)))


def nearest_node(spark, d):
    found = [spatial_join.nearest_node(fx.nodes(spark, d), *p).select(F.lit(i).alias("point"), "id", F.round("score", 9).alias("score")) for i, p in enumerate(POINTS)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def nearest_node_multi(spark, d):
    graphs = [fx.nodes(spark, d).where(F.col("id") % 3 == g) for g in range(3)]
    return spatial_join.nearest_of_several(graphs, *POINTS[0]).select("id", "graph", F.round("score", 9).alias("score"))


def _components(spark, d):
    return components(_edges(spark, d).select(F.col("src").alias("a"), F.col("dst").alias("b")))


def components_query(spark, d):
    return _components(spark, d)


def _customer_pairs(spark, d):
    key = F.col("c_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").select(key.alias("source"), (key + 60 * (1 + key % 2) + key % 3).alias("target"))


def connected_pairs(spark, d):
    return same_component(_components(spark, d), _customer_pairs(spark, d))


def way_centroids(spark, d):
    return _located(places.centroids(fx.ways(spark, d), fx.nodes(spark, d)))


def _places(spark, d):
    lines = fx.node_lines(spark, d).unionByName(fx.way_lines(spark, d))
    return places.places(opl.place_elements(lines))


def places_query(spark, d):
    return _located(_places(spark, d))


def place_tokens(spark, d):
    return places.postings(_places(spark, d), ("searchTerms",))


def region_assign(spark, d):
    return regions.region_nodes(fx.nodes(spark, d))


def region_complete_ways(spark, d):
    return regions.complete_ways(fx.nodes(spark, d), fx.ways(spark, d))


def tag_filter_compact(spark, d):
    amenity = F.coalesce(F.try_element_at("tags", F.lit("amenity")).isin("drinking_water", "toilets"), F.lit(False))
    return regions.tag_filter(fx.nodes(spark, d), fx.ways(spark, d), regions.compact_way(_tag), amenity)


def region_quadrants(spark, d):
    return geo.quadrants(regions.regions(spark))


def tile_layers(spark, d):
    return tiles.layer_zooms(tiles.layers(spark))


def elevation_bilinear(spark, d):
    tile = raster.plane_tiles(spark, [f"N{y}E{x}" for y in (37, 38) for x in (126, 127, 128, 129, 130, 131)], 3, 2)
    return raster.elevations(fx.nodes(spark, d), tile).select("id", "ele")


def dem_catalogue(spark, d):
    return geo.dem_catalogue(spark)


def _manifest(spark, d):
    """A manifest with a region for each nation."""
    nation = spark.read.parquet(f"{d}/nation.parquet")
    k = F.col("n_nationkey")
    asset = lambda end, size, down: F.struct(F.concat("n_name", F.lit(end)).alias("file"), size.cast("bigint").alias("size"), F.lit(None).cast("string").alias("sha256"), down.cast("bigint").alias("downloadSize"))
    own = nation.agg(
        F.collect_list(F.struct(F.col("n_name").alias("id"), asset(".routing.sqlite", 1000 + k * 10, 400 + k).alias("routing"))).alias("regions"),
        F.map_from_entries(F.collect_list(F.struct("n_name", asset(".places.sqlite", 500 + k * 7, 200 + k)))).alias("searchIndexes"),
    )
    whole = json.dumps({"file": "all.routing.sqlite", "size": 99999, "downloadSize": 44444})
    return own.withColumn("nationwideRouting", F.from_json(F.lit(whole), "file string, size bigint, sha256 string, downloadSize bigint"))


def manifest_assets(spark, d):
    return release.assets(_manifest(spark, d)).select("grp", "id", "file", "size", "downloadSize")


def manifest_totals(spark, d):
    return release.totals(release.assets(_manifest(spark, d)))


def _local(folder: str) -> str:
    """A shared folder as the path under which all machines mount it."""
    return folder.removeprefix("file:").replace("//", "/") if folder.startswith("file:") else folder


def asset_sha256(spark, d):
    """The pages as files of the shared folder, hashed chunk by chunk."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("file"), F.encode("html", "UTF-8").alias("content"))
    paths = cut(release.store_assets(pages, _local(shared_folder(spark))))
    found = release.require(cut(release.hashed(paths)))
    return found.select(F.regexp_extract("path", r"([0-9]+)\.html$", 1).cast("bigint").alias("page_id"), "size", "sha256")


def opl_files(spark, d):
    """The network as OPL text files, read back."""
    folder = shared_folder(spark)
    for kind, rows in (("nodes", fx.node_lines(spark, d)), ("ways", fx.way_lines(spark, d))):
        rows.select("value").write.text(f"{folder}/{kind}")
    lines = opl.read_lines(spark, f"{folder}/nodes", f"{folder}/ways")
    row = lambda df, kind, n: df.select(F.lit(kind).alias("kind"), "id", F.size("tags").cast("bigint").alias("n_tags"), n.cast("bigint").alias("n_refs"))
    return row(opl.nodes(lines), "n", F.lit(0)).unionByName(row(opl.ways(lines), "w", F.size("refs")))


def route_points(spark, d):
    """The curated points as a CSV with a byte order mark, read back and numbered in file order."""
    names = {ours: theirs for theirs, ours in routes.COLUMNS.items()}
    rows = fx.official(spark, d).select("idx", *names)
    text = rows.select("idx", *[F.when(F.col("idx") % 9 == 4, F.lit("?")).otherwise(F.col(c).cast("string")).alias(f"\ufeff{n}" if i == 0 else n) for i, (c, n) in enumerate(names.items())])
    folder = shared_folder(spark)
    text.repartitionByRange(1, "idx").sortWithinPartitions("idx").drop("idx").write.option("header", True).csv(folder)  # one file of a dimension table
    return routes.read_points(spark, folder)


def elevation_files(spark, d):
    """Elevations from raster files, one of them in an archive (S8, J6); other tiles are missing and count as 0."""
    folder = shared_folder(spark)
    made = raster.plane_tiles(spark, ["N37E126", "N37E127"], 3, 2)
    cut(release.store_assets(raster.packed(made, ["N37E127"]), _local(folder)))
    return raster.elevations(fx.nodes(spark, d), raster.read_tiles(spark, folder)).select("id", "ele")


def tag_filter_detail(spark, d):
    amenity = F.coalesce(F.try_element_at("tags", F.lit("amenity")).isin("drinking_water", "toilets"), F.lit(False))
    return regions.tag_filter(fx.nodes(spark, d), fx.ways(spark, d), regions.detail_way(F.col("tags")), amenity)


def tag_filter_named(spark, d):
    return regions.tag_filter(fx.nodes(spark, d), fx.ways(spark, d), regions.named(F.col("tags")), regions.named(F.col("tags")))


def connected_across(spark, d):
    """Three graphs in stores of their own, stitched by node id (S12, S13, J10): which customers' nodes are connected?"""
    edges, nodes = cut(_edges(spark, d)), cut(fx.nodes(spark, d).select("id", "lat", "lon"))
    folder = shared_folder(spark)
    for part in range(3):
        own = lambda c, part=part: F.pmod(F.col(c), F.lit(3)) == part
        store.write_graph({"edges": edges.where(own("src")), "nodes": nodes.where(own("id")), "metadata": store.metadata(spark, "detail")}, f"{folder}/{part}")
    whole = store.read_graph(spark, *[f"{folder}/{part}" for part in range(3)])
    labels = components(whole["edges"].select(F.col("src").alias("a"), F.col("dst").alias("b")))
    return same_component(labels, _customer_pairs(spark, d))


def folded_terms(spark, d):
    """The search terms of texts in several languages, folded."""
    prepare(spark)
    term = F.explode(places.terms(F.coalesce("text", F.lit("")))).alias("term")
    return spark.read.parquet(f"{d}/documents.parquet").select(term).groupBy("term").agg(F.count("*").alias("n"))


def place_match(spark, d):
    """Places that hold a term and a term of a prefix (T1, K9), from the index as stored."""
    folder = shared_folder(spark)
    places.write_index(_places(spark, d), folder)
    return places.match(spark.read.parquet(f"{folder}/postings"), "Toilets 아라1*")


RENAMED = {"components_query": "components", "places_query": "places"}
QUERIES = (
    opl_nodes, opl_ways, decode_opl, tags_lookup, tags_dup_last_wins, profile_detail, profile_compact, dismount_flag,
    oneway_class, way_segments, edges_raw, edges_final, edges_compact, nodes_first_wins, amenities, haversine, grid_cells,
    tile_names, official_nearest, official_nodes, edges_discounted, nearest_node, nearest_node_multi, components_query,
    connected_pairs, way_centroids, places_query, place_tokens, region_assign, region_complete_ways, tag_filter_compact,
    region_quadrants, tile_layers, elevation_bilinear, dem_catalogue, manifest_assets, manifest_totals, asset_sha256,
    opl_files, route_points, elevation_files, tag_filter_detail, tag_filter_named, connected_across, folded_terms, place_match,
)


def queries() -> dict:
    return {RENAMED.get(f.__name__, f.__name__): f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
