"""The bicycle cost profile, dismount flag and one-way class as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag values of the cost profile.
ALLOWED = ("yes", "designated", "official", "permissive")
FORBIDDEN = ("no", "private")
PAVED = ("paved", "asphalt", "concrete", "concrete:plates", "concrete:lanes", "paving_stones", "sett", "unhewn_cobblestone", "compacted", "fine_gravel")
UNSUITABLE = ("dirt", "earth", "ground", "mud", "sand", "grass", "woodchips")
ROUGH = ("cobblestone", "cobblestone:flattened", "gravel", "pebblestone")
BASE_COST = {
    "cycleway": 0.42, "path": 0.55, "track": 0.65, "pedestrian": 3.8, "living_street": 0.82, "residential": 0.9,
    "service": 1.0, "unclassified": 1.05, "tertiary": 1.2, "secondary": 1.65, "primary": 2.2, "trunk": 3.0,
}

#: The tags that profile, is_dismount and direction read.
TAGS = (
    "highway", "bicycle", "foot", "access", "vehicle", "surface", "smoothness", "bridge", "route", "sac_scale", "trail_visibility",
    "mtb:scale", "informal", "cycleway", "cycleway:left", "cycleway:right", "oneway", "oneway:bicycle", "bicycle:oneway", "junction",
)
Tags = Callable[[str], Column]

# Rules are data. A test of a tag is (whether the value must be among these, these); the empty string
# stands for a missing tag. A clause holds if all its tests do; @name asks for a condition. A list of
# clauses holds if one of them does.
one, none = (lambda *values: (True, values)), (lambda *values: (False, values))
ON_FOOT, MAIN, OWN = ("footway", "pedestrian"), ("primary", "secondary", "tertiary"), ("designated", "official")
SIDES = ("cycleway", "cycleway:left", "cycleway:right")
PRESENT = none("")
CONDITIONS = {
    "bike_ok": [{"bicycle": one(*ALLOWED)}],
    "walkable": [{"sac_scale": one(""), "surface": none(*UNSUITABLE), "foot": none(*FORBIDDEN), "highway": one(*ON_FOOT, "path"), "access": none("private")}],
    "connector": [{"@walkable": True}, {"highway": one(*ON_FOOT, "path", "service"), "foot": one(*ALLOWED), "access": none("private")}],
    "bridge_push": [{"highway": one(*MAIN), "bridge": one("yes"), "bicycle": one("no")}],
    "dedicated": [{"bicycle": one(*OWN)}, {"highway": one("cycleway")}, *({side: one("track", "separate")} for side in SIDES)],
    "lane": [{side: one("lane", "shared_lane", "share_busway")} for side in SIDES],
    "trail": [{"sac_scale": PRESENT}, {"mtb:scale": PRESENT}, {"trail_visibility": PRESENT}, {"informal": one("yes")}, {"surface": none(*PAVED)}],
}
#: The first rule that holds decides: None (no way for bicycles) or (cost, flag). Beyond them the base cost counts.
RULES = (
    ([{"highway": one("motorway", "motorway_link", "steps")}, {"bicycle": one(*FORBIDDEN), "@bridge_push": False, "@walkable": False}], None),
    ([{k: one(*FORBIDDEN), "@bike_ok": False, "@connector": False} for k in ("vehicle", "access")], None),
    ([{"route": one("ferry"), "@bike_ok": False}], None),
    ([{"route": one("ferry")}], (1.8, 0)),
    ([{"highway": one(*ON_FOOT), "bicycle": one("yes")}], (0.72, 1)),
    ([{"highway": one(*ON_FOOT), "bicycle": one(*OWN)}], (0.52, 1)),
    ([{"highway": one(*ON_FOOT), "sac_scale": PRESENT}, {"highway": one(*ON_FOOT), "surface": one(*UNSUITABLE)}], None),
    ([{"highway": one(*ON_FOOT)}], (3.8, 0)),
    ([{"@bridge_push": True}], (8.0, 0)),
    ([{"highway": one("path"), "@bike_ok": False, "@trail": True}], None),
    ([{"highway": none(*BASE_COST)}, {"smoothness": one("horrible", "very_horrible", "impassable")}], None),
)
#: In a compact graph this rules a way out as well.
OFF_COMPACT = [{"highway": none("path", "track", "trunk", *MAIN), "@dedicated": False, "@connector": False}]
#: A dedicated way costs no more than this. Then the factors, in this order: of each line the first that holds.
DEDICATED = 0.48
FACTORS = (
    (([{"@lane": True, "@dedicated": False}], 0.78),),
    (([{"surface": one(*ROUGH)}], 1.35), ([{"surface": one(*UNSUITABLE)}], 1.8)),
    (([{"smoothness": one("bad", "very_bad")}], 1.35),),
)
#: Then the cost is raised to the first of these that holds.
FLOORS = (([{"@connector": True, "@bike_ok": False}], 4.2), ([{"bicycle": one("dismount")}], 2.4))
#: P9.
WALKED = [
    {"bicycle": one("dismount")},
    {"@bridge_push": True},
    {"highway": one(*ON_FOOT, "path"), "bicycle": none("yes", *OWN)},
    {"highway": one("footway", "path", "service"), "foot": one(*ALLOWED), "bicycle": none(*FORBIDDEN)},
]


def holds(clauses: list[dict], tag: Tags, shared: dict[str, Column] | None = None) -> Column:
    """Whether one of the clauses holds. shared: conditions that are columns already."""

    def test(key: str, wanted) -> Column:
        if key.startswith("@"):
            found = shared[key[1:]] if shared else holds(CONDITIONS[key[1:]], tag)
            return found if wanted else ~found
        inside, values = wanted
        found = tag(key).isin(*values)
        return found if inside else ~found

    return reduce(or_, (reduce(and_, (test(k, v) for k, v in clause.items())) for clause in clauses))


def conditions(tag: Tags) -> dict[str, Column]:
    """The conditions that several rules share. tag: a tag's value, the empty string if missing.

    A plan that makes them columns first (and passes those to profile) compiles to less code.
    """
    return {name: holds(clauses, tag) for name, clauses in CONDITIONS.items()}


def _first(cases, default: float | None = None) -> Column:
    """The value of the first case that holds."""
    out = F.lit(default).cast("double")
    for condition, value in reversed(list(cases)):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def profile(tag: Tags, compact: bool = False, shared: dict[str, Column] | None = None) -> Column:
    """struct(cost, is_cycleway), null where the way is not for bicycles."""
    on = shared or conditions(tag)
    first = lambda cases, default: _first([(holds(c, tag, on), v) for c, v in cases], default)
    cost = _first((tag("highway") == kind, value) for kind, value in BASE_COST.items())
    cost = F.least(cost, F.when(on["dedicated"], DEDICATED).otherwise(float("inf")))
    for cases in FACTORS:  # a factor is 1 where none holds, so products keep their order
        cost = cost * first(cases, 1.0)
    cost = F.greatest(cost, first(FLOORS, 0.0))

    found = lambda value, flag: F.struct(value.cast("double").alias("cost"), flag.cast("int").alias("is_cycleway"))
    nothing = F.lit(None).cast("struct<cost:double,is_cycleway:int>")
    out = found(cost, on["dedicated"])
    for clauses, outcome in reversed([*RULES, *[(OFF_COMPACT, None)] * compact]):
        out = F.when(holds(clauses, tag, on), found(*map(F.lit, outcome)) if outcome else nothing).otherwise(out)
    return out


def is_dismount(tag: Tags) -> Column:
    """1 where a rider walks; it does not depend on the profile."""
    return holds(WALKED, tag).cast("int")


def direction(tag: Tags, has: Callable[[str], Column]) -> Column:
    """P10: both, fwd or rev. has: whether a key is present, with whatever value."""
    own = F.when(has("oneway:bicycle"), tag("oneway:bicycle")).otherwise(tag("bicycle:oneway"))
    general = tag("oneway")
    return (
        F.when(own.isin("no", "0", "false"), "both")
        .when((own == "-1") | (general == "-1"), "rev")
        .when(own.isin("yes", "1", "true") | general.isin("yes", "1", "true") | (tag("junction") == "roundabout"), "fwd")
        .otherwise("both")
    )
