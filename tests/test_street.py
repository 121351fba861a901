"""Graph, spatial, place, region, raster and release operators on literal rows, and oracle parity."""

import io
import json
import math
import random
import zipfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pathweave.functions import geo
from pathweave.operators import graph, places, raster, regions, release
from pathweave.operators.components import components, same_component
from pathweave.operators.dedup import first_wins, last_wins
from pathweave.operators.spatial_join import nearest_node, nearest_of_several, nearest_within
from pathweave.plans import street
from pathweave.sources import routes, store, tiles
from pathweave.streaming import opl_stream

TABLES = "region nation customer supplier part orders lineitem benchmark pages documents".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(float(r[i]) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(street.queries()))
def test_oracle(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    df = street.queries()[name](spark, small)
    want = con.sql(street.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.collect(), df.columns) == canonical(want.fetchall(), want.columns)


def test_dedup_order(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (1, None, 2), (2, "c", 9)], "k int, v string, o int")
    assert sorted(r["v"] for r in first_wins(df, ["k"], F.col("o")).collect()) == ["b", "c"]
    assert sorted(r["v"] for r in last_wins(df, ["k"], F.col("o")).collect()) == ["a", "c"]


def test_edges_break_at_missing_nodes_and_last_way_wins(spark):
    nodes = spark.createDataFrame([(i, 37.0 + i / 1000, 126.0) for i in (1, 2, 4)], "id long, lat double, lon double")
    ways = spark.createDataFrame(
        [(1, 1, [1, 2, 3, 4], 1.0, 0, 0, "both"), (2, 2, [1, 2], 9.0, 1, 1, "fwd"), (3, 3, [2, 2], 1.0, 0, 0, "both"), (4, 4, [1], 1.0, 0, 0, "both")],
        "ord long, id long, refs array<long>, weight double, is_cycleway int, is_dismount int, dir string",
    )
    got = {(r["src"], r["dst"]): (r["meters"], r["cost"]) for r in graph.edges(graph.edges_raw(ways, nodes)).collect()}
    assert set(got) == {(1, 2), (2, 1), (2, 2)}
    assert got[1, 2][1] == got[1, 2][0] * 9.0 and got[2, 1][1] == got[2, 1][0] and got[2, 2] == (0.0, 0.0)
    on = spark.createDataFrame([(1,), (2,)], "node_id long")
    less = {(r["src"], r["dst"]): r["cost"] for r in graph.discounted(graph.edges(graph.edges_raw(ways, nodes)), on).collect()}
    assert less[1, 2] == got[1, 2][1] * 0.45


def test_nearest_within_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    nodes = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-0.01, 0.01, (400, 2)).round(4))]
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-0.012, 0.012, (200, 2)).round(4))]
    schema = "double, lon double"
    got = {r["idx"]: r["node_id"] for r in nearest_within(spark.createDataFrame(points, f"idx int, lat {schema}"), spark.createDataFrame(nodes, f"id int, lat {schema}")).collect()}
    want = {}
    for i, y, x in points:
        near = sorted(((a - y) * (a - y) + (b - x) * (b - x), n) for n, a, b in nodes)
        if near[0][0] <= geo.RADIUS**2:
            want[i] = near[0][1]
    assert got == want
    with pytest.raises(ValueError):
        nearest_within(spark.createDataFrame(points, f"idx int, lat {schema}"), spark.createDataFrame(nodes, f"id int, lat {schema}"), 1.0)


def test_nearest_node(spark):
    df = spark.createDataFrame([(5, 37.0, 126.0), (3, 37.0, 126.0), (1, 38.0, 126.0)], "id int, lat double, lon double")
    assert nearest_node(df, 37.01, 126.0).first()["id"] == 3
    assert nearest_node(df, 30.0, 126.0).count() == 0
    assert nearest_of_several([df.where("id = 5"), df.where("id = 3")], 37.01, 126.0).first()["id"] == 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (503, 501), (600, 600)]
    got = dict(components(spark.createDataFrame(edges[::-1], "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 503: 500, 600: 600}
    labels = spark.createDataFrame(list(got.items()), "node long, component long")
    pairs = spark.createDataFrame([(0, 200), (0, 500), (9999, 9999), (None, 1)], "source long, target long")
    assert sorted((str(r["source"]), r["connected"]) for r in same_component(labels, pairs).collect()) == [("0", False), ("0", True), ("9999", True), ("None", False)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_chains_and_hubs(spark, monkeypatch):
    """Rounds grow as the logarithm: a chain in random order and a hub with many spokes."""
    from pathweave.operators import components as module

    rounds = []
    monkeypatch.setattr(module, "jumped", lambda trees, f=module.jumped: rounds.append(1) or f(trees))
    chain = list(range(2000))
    random.Random(3).shuffle(chain)
    assert {r["component"] for r in components(spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")).collect()} == {0}
    assert len(rounds) <= 15
    rounds.clear()
    hub = spark.range(1, 100_001).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    got = components(hub)
    assert got.count() == 100_001 and got.where("component <> 0").count() == 0 and len(rounds) <= 3
    pairs = [(i, j) for i in range(60) for j in range(i) if (i * 7 + j * 13) % 41 == 0]
    label = list(range(60))
    for _ in range(60):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    got = dict(components(spark.createDataFrame([*pairs, (None, 1)], "a long, b long")).collect())
    assert got == {n: label[n] for p in pairs for n in p}


def test_folding_and_match(spark):
    df = spark.createDataFrame([("Café ÖSCH-Ấn", "a"), ("cafe bar", "b"), ("아라 1길", "c"), (None, "d")], "name string, id string")
    got = dict(df.select("id", places.terms(F.coalesce("name", F.lit("")))).collect())
    assert got == {"a": ["cafe", "osch", "an"], "b": ["cafe", "bar"], "c": ["아라", "1길"], "d": []}
    posted = places.postings(df.fillna(""), ("name",))
    assert {r["id"] for r in places.match(posted, "CAFÉ").collect()} == {"a", "b"}
    assert {r["id"] for r in places.match(posted, "cafe ba*").collect()} == {"b"} and places.match(posted, "--").count() == 0


def test_compressed_leaves_no_part_of_a_file(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError), release.installed(tmp_path / "x") as f:
        f.write(b"half")
        raise ValueError
    assert list(tmp_path.iterdir()) == []


def test_geo(spark):
    pts = [(37.5665, 126.978, "N37E126"), (-33.8688, 151.2093, "S34E151"), (40.7128, -74.006, "N40W075"), (37.0, 126.0, "N37E126")]
    df = spark.createDataFrame(pts, "lat double, lon double, want string")
    assert df.where(geo.tile_name(F.col("lat"), F.col("lon")) != F.col("want")).count() == 0
    r = df.select(geo.haversine(F.lit(37.5), F.lit(127.0), F.lit(37.6), F.lit(127.1)), geo.haversine(F.lit(37.6), F.lit(127.1), F.lit(37.5), F.lit(127.0))).first()
    a, b = math.radians(37.5), math.radians(37.6)
    v = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(0.1) / 2) ** 2
    assert r[0] == pytest.approx(r[1]) == pytest.approx(12742000 * math.asin(math.sqrt(v)))
    assert [x[0] for x in spark.createDataFrame([(-0.003,), (0.003,)], "v double").select(geo.cell(F.col("v"))).collect()] == [-1, 1]
    x, y = geo.slippy_tile(F.lit(37.5665), F.lit(126.978), 10)
    assert tuple(df.select(x, y).first()) == (873, 396)


def test_raster(spark, tmp_path):
    flat = np.full((1201, 1201), 220, ">i2").tobytes()
    with zipfile.ZipFile(tmp_path / "N37E126.SRTMGL1.hgt.zip", "w") as z:
        z.writestr("N37E126.hgt", flat)
    (tmp_path / "N37E127.hgt.zip").write_bytes(b"no zip")
    (tmp_path / "N37E128.hgt").write_bytes(b"12")
    got = raster.read_tiles(spark, str(tmp_path))
    assert {r["tile"] for r in got.collect()} == {"N37E126", "N37E128"}
    pts = spark.createDataFrame([(1, 37.25, 126.75), (2, 37.5, 127.5), (3, 37.5, 128.5), (4, 10.0, 10.0)], "id long, lat double, lon double")
    assert {r["id"]: r["ele"] for r in raster.elevations(pts, got).collect()} == {1: 220, 2: 0, 3: 0, 4: 0}


def test_interpolation_details():
    grid = np.zeros((1201, 1201), ">i2")
    grid[1200, 37], grid[1200, 38], grid[0, 0], grid[1200, 0] = 5, -32768, 7, 5
    at = lambda y, x: int(raster.interpolate(grid.tobytes(), np.array([y]), np.array([x]))[0])
    assert at(37.0, 126.0) == 5  # an integral latitude is the last row of the tile north of it
    assert at(37.0, 126.0 + 1 / 32) == 2  # 2.5 to even, the void counts as 0
    assert at(38.0 - 1e-12, 126.0) == 7
    big = np.full((3601, 3601), 9, ">i2").tobytes()
    assert int(raster.interpolate(big, np.array([37.3]), np.array([126.3]))[0]) == 9
    buffer = io.BytesIO()
    zipfile.ZipFile(buffer, "w").close()
    assert raster.unpacked("a.hgt.zip", buffer.getvalue()) is None


def test_places(spark):
    rows = [
        ("n", 1, 1.0, 2.0, {"name": "", "name:ko": "가", "amenity": "cafe", "addr:city": "", "addr:street": "s"}),
        ("n", 2, 1.0, 2.0, {"name": "b", "shop": ""}),
        ("w", 3, 1.0, 2.0, {"name": "c"}),
        ("n", 4, 1.0, 2.0, {"shop": "x"}),
        ("n", 5, 1.0, 2.0, {"name": "Café-Bar", "shop": "x", "amenity": "bar", "brand": "Z"}),
    ]
    got = {r["id"]: r for r in places.described(spark.createDataFrame(rows, "kind string, id long, lat double, lon double, tags map<string,string>")).collect()}
    assert set(got) == {"n1", "n2", "n5"}
    assert (got["n1"]["name"], got["n1"]["subtitle"], got["n1"]["searchTerms"]) == ("가", "s", "가 가 s cafe")
    assert (got["n2"]["subtitle"], got["n2"]["searchTerms"]) == ("", "b")
    index = spark.createDataFrame(list(got.values()))
    hits = places.bm25(index, "CAFE-cafe? bar").orderBy(F.desc("score")).collect()
    assert [h["id"] for h in hits] == ["n5", "n1"]


def test_regions(spark):
    df = spark.createDataFrame([("a|1,2,3,4",), ("b|x,2,3",)], "e string").select(regions.parse_region(F.col("e")).alias("r")).select("r.*")
    assert [tuple(r) for r in df.collect()] == [("a", 1.0, 2.0, 3.0, 4.0), ("b", None, 2.0, 3.0, None)]
    assert regions.regions(spark).count() == 17 and tiles.layers(spark).count() == 19 and routes.routes(spark).count() == 13


def test_routes_csv(spark, tmp_path):
    head = "﻿순서,국토종주 자전거길,위도(LINE_XP),경도(LINE_YP)\n"
    (tmp_path / "r.csv").write_text(head + "1,1,37.45,126.83\nx,1,1,1\n2,14,37,126\n3,13,37.46,126.84\n", encoding="utf-8")
    got = routes.read_points(spark, str(tmp_path / "r.csv")).orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 37.45, 126.83), (1, 13, 3, 37.46, 126.84)]
    nodes = spark.createDataFrame([(7, 37.4501, 126.8301)], "id long, lat double, lon double")
    assert [tuple(r) for r in routes.official_nodes(routes.read_points(spark, str(tmp_path / "r.csv")), nodes).collect()] == [(7, 1, 1)]


def test_release(spark, tmp_path):
    for name in ("a.pmtiles", "b.pmtiles"):
        (tmp_path / name).write_bytes(name.encode() * 1000)
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.pmtiles", "b.pmtiles")], "path string")
    found = release.require(release.hashed(paths)).withColumn("file", F.element_at(F.split("path", "/"), -1)).select("file", "size", "sha256")
    with pytest.raises(FileNotFoundError):
        release.require(release.hashed(spark.createDataFrame([("/nowhere/x",)], "path string")))
    region = lambda i: {"id": i, "name": "가", "available": True, "mapFile": f"{i}.pmtiles", "routing": {"file": "r", "size": 10, "downloadSize": 4, "downloadFile": "r.z"}}
    doc = {"schemaVersion": 2, "release": "r0", "nationwideRouting": {"file": "n", "size": 10, "downloadSize": 6}, "searchIndexes": {"a": {"file": "s", "size": 20, "downloadSize": 10}}, "regions": [region("a"), region("b")]}
    (tmp_path / "manifest.json").write_text(json.dumps(doc))
    manifest = release.read_manifest(spark, str(tmp_path / "manifest.json"))
    assert tuple(release.totals(release.assets(manifest)).first()) == (4, 50, 24, "0.480")
    from datetime import UTC, datetime

    new = release.with_map_files(manifest, found, "r1", "https://example.org/r1", datetime(2024, 1, 1, 20, 0, 0, 5, tzinfo=UTC))
    release.write_manifest(new, str(tmp_path / "out.json"))
    text = (tmp_path / "out.json").read_text()
    back = json.loads(text)
    assert text.endswith("}\n") and "가" in text and back["generatedAt"] == "2024-01-02T05:00:00+09:00"
    assert back["regions"][0]["size"] == 9000 and back["regions"][0]["routing"]["downloadFile"] == "r.z"
    fresh = release.with_routing_files(manifest, found, "v10").select(F.explode("regions").alias("r")).select("r.routing.*").first()
    assert fresh["file"] == "a.routing.v10.sqlite" and fresh["downloadFile"] is None
    packed = release.compressed(paths, str(tmp_path / "packed"))
    row = packed.orderBy("path").first()
    assert release.unpack((tmp_path / "packed" / row["downloadFile"]).read_bytes(), "gzip") == b"a.pmtiles" * 1000
    assert [r["ok"] for r in release.verified(found, found.where("file = 'a.pmtiles'")).orderBy("file").collect()] == [True, False]


def test_store(spark, small, tmp_path):
    tables = {"edges": street.edges_final(spark, small), "nodes": street.fx.nodes(spark, small).select("id", "lat", "lon"), "metadata": store.metadata(spark, "detail")}
    store.write_graph(tables, str(tmp_path / "g"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        store.write_graph(tables, str(tmp_path / "g"))
    store.write_graph(tables, str(tmp_path / "g"), "skip")
    back = store.read_graph(spark, str(tmp_path / "g"))
    assert back["edges"].count() == tables["edges"].count() and back["nodes"].count() == 150
    plan = back["nodes"].where(F.col("lat").between(37.4, 37.5))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lat), GreaterThanOrEqual(lat" in plan


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.opl").write_text("n1 v1 Tamenity=cafe x126 y37\nw1 v1 T Nn1\nw2 v1 Thighway=cycleway Nn1,n2\n")
    for name, df, mode in (("nodes", opl_stream.nodes, "append"), ("ways", opl_stream.rideable_ways, "append"), ("counts", opl_stream.place_counts, "complete")):
        q = df(opl_stream.lines(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("nodes").count() == 1 and spark.table("ways").first()["weight"] == 0.42
    assert [tuple(r) for r in spark.table("counts").collect()] == [("cafe", 1)]


def test_connected_pairs_of_all_customers(spark, tmp_path, monkeypatch):
    spark.range(1, 251).selectExpr("id as c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    labels = spark.createDataFrame([(k, k % 7) for k in range(1, 400) if k % 5], "node long, component long")
    monkeypatch.setattr(street, "_components", lambda spark, d: labels)
    targets = {k: k + 60 * (1 + k % 2) + k % 3 for k in range(1, 251)}
    own = lambda k: k % 7 if k % 5 and k < 400 else k
    got = {(r["source"], r["target"], r["connected"]) for r in street.connected_pairs(spark, str(tmp_path)).collect()}
    assert {(k, t) for k, t, _ in got} == set(targets.items())
    both = {(k, t, c) for k, t, c in got if k % 5 and t % 5}
    assert both == {(k, t, own(k) == own(t)) for k, t in targets.items() if k % 5 and t % 5}


def test_region_complete_ways_of_all_regions(spark, monkeypatch):
    nodes = [(i, (s + n) / 2, (w + e) / 2) for i, (_, w, s, e, n) in enumerate(regions.REGIONS)]
    ways = [(100 + i, [i, (i + 1) % len(nodes), 999]) for i in range(len(nodes))]
    monkeypatch.setattr(street.fx, "nodes", lambda spark, d: spark.createDataFrame(nodes, "id long, lat double, lon double"))
    monkeypatch.setattr(street.fx, "ways", lambda spark, d: spark.createDataFrame(ways, "id long, refs array<long>"))
    want = set()
    for name, w, s, e, n in regions.REGIONS:
        inside = {i for i, lat, lon in nodes if w <= lon <= e and s <= lat <= n}
        touched = [(k, refs) for k, refs in ways if inside & set(refs)]
        want |= {(name, "w", k) for k, _ in touched} | {(name, "n", i) for i in inside | {r for _, refs in touched for r in refs if r != 999}}
    got = [tuple(r) for r in street.region_complete_ways(spark, "").collect()]
    assert set(got) == want and len(got) == len(want)
