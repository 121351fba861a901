"""OPL parsing: escapes, tag bags, node and way scans, quarantine."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathweave.sources import opl

LINES = [
    "n1 v1 dV c1 t2024 i1 usyn Tname=a%c544%,amenity=toilets x126.0001000 y37.0001000",
    "w1 v1 dV c1 t2024 i1 usyn Thighway=path,surface=asphalt Nn7,n8,n9,n10",
    "w900 v1 dV c1 t i0 u T N",
    "w901 Thighway=path Nn1,n2",
    "n77 v1 dD c1 t i1 u T x y",
    "n78 v1 T y37.5",
    "r1 v1 Tname=x Mn1@",
    "w-5 v1 Ta=1,a=2,loose,b=c=d Nnn3,4",
]


def lines(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "ord long, value string")


def scalar_decode(text):
    return re.sub("%([0-9a-fA-F]+)%", lambda m: chr(int(m[1], 16)), text)


def test_decode_cases(spark):
    cases = ["%zz%41%q", "%25%20%25%", "a%c544%b", "%", "%%", "%41%%42%", "plain", "", "%1f6b2%", "%0000041%"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert [r[0] for r in df.select(opl.decode(F.col("s"))).collect()] == [scalar_decode(c) for c in cases]
    bad = spark.createDataFrame([("%110000%",), ("%d800%",), ("%ffffffffffffffffffff%",), (None,)], "s string")
    assert [r[0] for r in bad.select(opl.decode(F.col("s"))).collect()] == [None] * 4


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=12).filter(lambda s: "\x00" not in s), min_size=1, max_size=20))
def test_encode_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(opl.decode(opl.encode(F.col("s")))).collect()] == texts


def test_nodes_and_ways(spark):
    node = opl.nodes(lines(spark)).collect()
    assert [(r["id"], r["lat"], r["lon"], r["tags"]) for r in node] == [(1, 37.0001, 126.0001, {"name": "a아", "amenity": "toilets"})]
    way = {r["id"]: (r["tags"], r["refs"]) for r in opl.ways(lines(spark)).collect()}
    assert way == {1: ({"highway": "path", "surface": "asphalt"}, [7, 8, 9, 10]), -5: ({"a": "2", "b": "c=d"}, [3, 4])}
    assert [r["ord"] for r in opl.nodes(lines(spark), quarantined=True).collect()] == [4]
    assert [r["ord"] for r in opl.ways(lines(spark), quarantined=True).collect()] == [2]


def test_place_elements_and_file_order(spark, tmp_path):
    got = {(r["kind"], r["id"]): r for r in opl.place_elements(lines(spark)).collect()}
    assert got["n", 77]["lat"] is None and got["w", 1]["refs"] == [7, 8, 9, 10]
    text = [f"n{i} v1 T x1 y2" for i in range(5000)]
    (tmp_path / "a.opl").write_text("\n".join(text) + "\n")
    back = opl.read_lines(spark, str(tmp_path / "a.opl")).orderBy("ord").select("value").collect()
    assert [r[0] for r in back] == text
