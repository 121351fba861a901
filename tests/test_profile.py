"""Golden vectors of the cost profile, dismount flag and one-way classes."""

import pytest
from pyspark.sql import functions as F

from pathweave.functions import profile as P
from pathweave.operators.graph import profiled

# tags, compact, cost, cycleway flag, dismount flag (None: the way is dropped)
VECTORS = [
    ("highway=motorway", False, None, None, None),
    ("highway=footway", False, 3.8, 0, 1),
    ("highway=footway,surface=ground", False, None, None, None),
    ("highway=path,access=private,bicycle=designated", False, 0.48, 1, 0),
    ("highway=service,access=no,foot=yes", False, 4.2, 0, 1),
    ("highway=service,access=no", False, None, None, None),
    ("highway=primary,bridge=yes,bicycle=no", False, 8.0, 0, 1),
    ("highway=path,surface=ground,foot=designated", False, None, None, None),
    ("highway=path,surface=asphalt,smoothness=impassable", False, None, None, None),
    ("highway=residential,cycleway:right=track", False, 0.48, 1, 0),
    ("highway=residential,cycleway:right=lane", False, 0.9 * 0.78, 0, 0),
    ("highway=residential", False, 0.9, 0, 0),
    ("highway=path,surface=asphalt,bicycle=dismount", False, 4.2, 0, 1),
    ("highway=pedestrian", False, 3.8, 0, 1),
    ("highway=path", False, None, None, None),
    ("highway=path,surface=asphalt", False, 4.2, 0, 1),
    ("highway=footway,bicycle=no,foot=yes", False, 3.8, 0, 1),
    ("highway=path,trail_visibility=good", False, None, None, None),
    ("highway=path,mtb:scale=1", False, None, None, None),
    ("highway=footway,foot=no", False, 3.8, 0, 1),
    ("highway=footway,foot=no,bicycle=no", False, None, None, None),
    ("highway=footway,bicycle=yes", False, 0.72, 1, 0),
    ("highway=footway,bicycle=designated", False, 0.52, 1, 0),
    ("highway=footway,bicycle=permissive", False, 3.8, 0, 1),
    ("highway=cycleway", False, 0.42, 1, 0),
    ("highway=cycleway,bicycle=dismount", False, 2.4, 1, 1),
    ("highway=path,bicycle=designated,foot=designated", False, 0.48, 1, 1),
    ("highway=path,bicycle=yes,surface=ground", False, 0.55 * 1.8, 0, 0),
    ("highway=secondary,cycleway=lane,surface=gravel,smoothness=bad", False, 1.65 * 0.78 * 1.35 * 1.35, 0, 0),
    ("route=ferry,bicycle=yes", False, 1.8, 0, 0),
    ("route=ferry", False, None, None, None),
    ("highway=primary_link,bicycle=designated", False, None, None, None),
    ("highway=track,vehicle=no", False, None, None, None),
    ("highway=steps,bicycle=yes", False, None, None, None),
    ("highway=residential", True, None, None, None),
    ("highway=residential,cycleway=lane", True, None, None, None),
    ("highway=residential,cycleway=track", True, 0.48, 1, 0),
    ("highway=track", True, 0.65, 0, 0),
    ("highway=footway", True, 3.8, 0, 1),
]
ONEWAY = [
    ("", "both"), ("oneway=yes", "fwd"), ("oneway=-1", "rev"), ("junction=roundabout", "fwd"), ("oneway=yes,oneway:bicycle=no", "both"),
    ("oneway=-1,oneway:bicycle=yes", "rev"), ("oneway:bicycle=,bicycle:oneway=yes", "both"), ("bicycle:oneway=1", "fwd"), ("oneway=reversible", "both"),
]


def bag(text):
    return dict(x.split("=", 1) for x in text.split(",") if x)


@pytest.mark.parametrize("compact", [False, True])
def test_profile_vectors(spark, compact):
    rows = [(i, bag(v[0])) for i, v in enumerate(VECTORS) if v[1] is compact]
    ways = spark.createDataFrame([(i, i, t, [1, 2]) for i, t in rows], "ord long, id long, tags map<string,string>, refs array<long>")
    got = {r["id"]: (r["weight"], r["is_cycleway"], r["is_dismount"]) for r in profiled(ways, compact).collect()}
    for i, _ in rows:
        _, _, cost, cyc, dis = VECTORS[i]
        assert got.get(i) == (None if cost is None else (cost, cyc, dis)), VECTORS[i]


def test_oneway(spark):
    df = spark.createDataFrame([(i, bag(t)) for i, (t, _) in enumerate(ONEWAY)], "id int, tags map<string,string>")
    tag = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit(""))
    got = dict(df.select("id", P.direction(tag, lambda k: F.map_contains_key("tags", F.lit(k)))).collect())
    assert [got[i] for i in range(len(ONEWAY))] == [want for _, want in ONEWAY]
