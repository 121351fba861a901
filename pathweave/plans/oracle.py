"""DuckDB SQL for the street queries, written independently of the Spark plans."""

from __future__ import annotations

from pathweave.functions import profile as P
from pathweave.operators.regions import COMPACT_HIGHWAYS, REGIONS
from pathweave.plans.fixtures import NODE, OFFICIAL, REF, WAY, WAY_TAGS
from pathweave.sources.tiles import LAYERS


def _in(column: str, values) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


FX = f"""
fx_node0 as ({NODE}),
fx_node as (select * replace (cast(cast(lat as decimal(10,7)) as double) as lat, cast(cast(lon as decimal(10,7)) as double) as lon) from fx_node0),
fx_way as ({WAY}),
fx_ref as ({REF}),
fx_official as ({OFFICIAL})"""

_tags = ", ".join(f"coalesce({c}, '') as {c}" for c in WAY_TAGS if c != "oneway_bicycle")
PROFILE = f"""
t as (select id, oneway_bicycle as ob, {_tags} from fx_way),
c1 as (select *,
  {_in('bicycle', P.ALLOWED)} as bike_ok,
  highway in ('footway','pedestrian','path') and not ({_in('foot', P.FORBIDDEN)}) and access <> 'private' and not ({_in('surface', P.UNSUITABLE)}) as walkable,
  bicycle = 'no' and bridge = 'yes' and highway in ('primary','secondary','tertiary') as push,
  highway = 'cycleway' or bicycle in ('designated','official') or cycleway in ('track','separate') as dedicated,
  cycleway in ('lane','shared_lane','share_busway') as lane from t),
c2 as (select *, walkable or ({_in('foot', P.ALLOWED)} and highway in ('footway','pedestrian','path','service') and access <> 'private') as conn from c1),
b0 as (select *, case highway {' '.join(f"when '{k}' then cast({v} as double)" for k, v in P.BASE_COST.items())} end as base from c2),
b1 as (select *, case when dedicated then least(base, cast(0.48 as double)) when lane then base * cast(0.78 as double) else base end as x1 from b0),
b2 as (select *, case when {_in('surface', P.ROUGH)} then x1 * cast(1.35 as double) when {_in('surface', P.UNSUITABLE)} then x1 * cast(1.8 as double) else x1 end as x2 from b1),
b3 as (select *, case when smoothness in ('bad','very_bad') then x2 * cast(1.35 as double) else x2 end as x3 from b2),
b4 as (select *, case when bicycle = 'dismount' then greatest(x3, cast(2.4 as double)) else x3 end as x4 from b3),
b5 as (select *, case when conn and not bike_ok then greatest(x4, cast(4.2 as double)) else x4 end as x5 from b4),
p as (select *, case
    when {_in('bicycle', P.FORBIDDEN)} and not push and not walkable then 'none'
    when {_in('access', P.FORBIDDEN)} and not bike_ok and not conn then 'none'
    when highway in ('motorway','motorway_link','steps') then 'none'
    when highway in ('footway','pedestrian') and bicycle = 'yes' then 'foot_yes'
    when highway in ('footway','pedestrian') and bicycle in ('designated','official') then 'foot_own'
    when highway in ('footway','pedestrian') and {_in('surface', P.UNSUITABLE)} then 'none'
    when highway in ('footway','pedestrian') then 'foot'
    when push then 'push'
    when highway = 'path' and not bike_ok and not ({_in('surface', P.PAVED)}) then 'none'
    when COMPACT and not dedicated and not conn and highway not in ('trunk','primary','secondary','tertiary','track','path') then 'none'
    when base is null or smoothness in ('horrible','very_horrible','impassable') then 'none'
    else 'base' end as rule from b5),
prof as (select *,
    case rule when 'foot_yes' then cast(0.72 as double) when 'foot_own' then cast(0.52 as double) when 'foot' then cast(3.8 as double) when 'push' then cast(8.0 as double) when 'base' then x5 end as weight,
    case rule when 'foot_yes' then 1 when 'foot_own' then 1 when 'foot' then 0 when 'push' then 0 when 'base' then cast(dedicated as int) end as is_cycleway,
    cast(bicycle = 'dismount'
      or (highway in ('footway','pedestrian','path') and bicycle not in ('yes','designated','official'))
      or (bicycle = 'no' and bridge = 'yes' and highway in ('primary','secondary','tertiary'))
      or ({_in('foot', P.ALLOWED)} and highway in ('footway','path','service') and not ({_in('bicycle', P.FORBIDDEN)})) as int) as is_dismount,
    case when coalesce(ob, '') in ('no','0','false') then 'both'
      when ob = '-1' or oneway = '-1' then 'rev'
      when coalesce(ob, '') in ('yes','1','true') or oneway in ('yes','1','true') then 'fwd' else 'both' end as dir
  from p)"""

EDGES = """
seg as (select way_id, pos, ref as a, lead(ref) over (partition by way_id order by pos) as b from fx_ref),
geo as (select s.way_id, s.pos, s.a, s.b,
    12742000 * asin(sqrt(pow(sin((radians(n2.lat) - radians(n1.lat)) / 2), 2)
      + cos(radians(n1.lat)) * cos(radians(n2.lat)) * pow(sin((radians(n2.lon) - radians(n1.lon)) / 2), 2))) as meters
  from seg s join fx_node n1 on n1.id = s.a join fx_node n2 on n2.id = s.b),
raw as (
  select a as src, b as dst, meters, meters * weight as cost, is_cycleway, is_dismount, way_id, pos, 0 as step
  from geo join prof on prof.id = way_id where weight is not null and dir in ('both','fwd')
  union all
  select b, a, meters, meters * weight, is_cycleway, is_dismount, way_id, pos, 1
  from geo join prof on prof.id = way_id where weight is not null and dir in ('both','rev')),
edge as (select src, dst, meters, cost, is_cycleway, is_dismount from raw
  qualify row_number() over (partition by src, dst order by way_id desc, pos desc, step desc) = 1)"""

OFFICIAL_NODES = """
near as (select o.idx, o.route_id, o.sequence, n.id as node_id from fx_official o join fx_node n
    on (n.lat - o.lat) * (n.lat - o.lat) + (n.lon - o.lon) * (n.lon - o.lon) <= cast(0.0015 as double) * cast(0.0015 as double)
  qualify row_number() over (partition by o.idx order by (n.lat - o.lat) * (n.lat - o.lat) + (n.lon - o.lon) * (n.lon - o.lon), n.id) = 1),
onode as (select node_id, route_id, sequence from near where route_id between 1 and 13
  qualify row_number() over (partition by node_id, route_id order by idx) = 1)"""

COMPONENTS = """
und as (select distinct src as a, dst as b from edge where src <> dst union select distinct dst, src from edge where src <> dst),
reach(node, other) as (
  select a, a from und union select r.node, u.b from reach r join und u on u.a = r.other),
comp as (select node, min(other) as component from reach group by node
  union all select distinct src, src from edge where src = dst and src not in (select a from und))"""


def q(body: str, *parts: str, compact: bool = False, recursive: bool = False) -> str:
    chain = ",".join((FX, *parts)).replace("COMPACT", "true" if compact else "false")
    return f"with {'recursive ' if recursive else ''}{chain}\n{body}"


EDGE_COLUMNS = "src, dst, round(meters, 3) as meters, round(cost, 3) as cost, is_cycleway, is_dismount"
POINTS = ((37.4523, 126.8301), (37.55, 126.95), (36.0, 127.0))
_regions = ", ".join(f"('{r}', cast({w} as double), cast({s} as double), cast({e} as double), cast({n} as double))" for r, w, s, e, n in REGIONS)
REGION = f"region(id, west, south, east, north) as (values {_regions})"
_score = "(lat - cast({0} as double)) * (lat - cast({0} as double)) + (lon - cast({1} as double)) * (lon - cast({1} as double))"


def _nearest(lat: float, lon: float, where: str = "true") -> str:
    return f"select id, {_score.format(lat, lon)} as score from fx_node where {where} and lat between cast({lat - 0.1!r} as double) and cast({lat + 0.1!r} as double) order by score, id limit 1"


def _layer(row: tuple) -> str:
    return "(" + ", ".join("null" if v is None else repr(v) for v in row) + ")"


PLACES = """
pl as (select concat('n', id) as id, lat, lon, coalesce(nullif(name, ''), nullif(name_ko, '')) as n, coalesce(name_ko, '') as name_ko, amenity as c, brand from fx_node where amenity is not null),
place as (select id, n as name, name_ko, '' as name_en, c as subtitle, lat as latitude, lon as longitude,
  concat_ws(' ', n, nullif(name_ko, ''), c, brand) as "searchTerms" from pl where n is not null)"""

_pairs = (
    "select source, target, coalesce(coalesce(a.component, source) = coalesce(b.component, target), false) as connected from "
    "(select c_custkey as source, c_custkey + 60 * (1 + c_custkey % 2) + c_custkey % 3 as target from customer) "
    "left join comp a on a.node = source left join comp b on b.node = target"
)
_terms = "list_filter(regexp_split_to_array(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _kept(ways: str, nodes: str) -> str:
    """A tag filter's rows: ways that match, and nodes that match or that they refer to."""
    return q(
        f"keep as (select id from fx_way where ({ways}) and id in (select way_id from fx_ref))"
        f" select 'n' as kind, id from fx_node where {nodes} or id in (select ref from fx_ref where way_id in (select id from keep))"
        " union all select 'w', id from keep"
    ).replace("\nkeep as", ",\nkeep as")


ORACLE: dict[str, str] = {
    "opl_nodes": q("select id, round(lat, 7) as lat, round(lon, 7) as lon, amenity, name, name_ko, brand from fx_node"),
    "opl_ways": q(
        f"select w.id, r.n as n_refs, r.total as ref_sum, {', '.join('w.' + c for c in WAY_TAGS)} from fx_way w "
        "join (select way_id, count(*) as n, cast(sum(ref * pos) as bigint) as total from fx_ref group by 1) r on r.way_id = w.id"
    ),
    "decode_opl": "select item_id, text from benchmark",
    "tags_lookup": q("select * from (" + " union all ".join(f"select id, '{'oneway:bicycle' if c == 'oneway_bicycle' else c}' as k, {c} as v from fx_way where {c} is not null" for c in WAY_TAGS) + ") where id in (select way_id from fx_ref)"),
    "tags_dup_last_wins": "select p_partkey as id, p_type as v from part",
    "profile_detail": q("select id, weight as cost, is_cycleway from prof where weight is not null and id in (select way_id from fx_ref)", PROFILE),
    "profile_compact": q("select id, weight as cost, is_cycleway from prof where weight is not null and id in (select way_id from fx_ref)", PROFILE, compact=True),
    "dismount_flag": q("select id, is_dismount from prof where id in (select way_id from fx_ref)", PROFILE),
    "oneway_class": q("select id, dir from prof where id in (select way_id from fx_ref)", PROFILE),
    "way_segments": q("select way_id, pos, ref as src, b as dst from (select *, lead(ref) over (partition by way_id order by pos) as b from fx_ref) where b is not null"),
    "edges_raw": q(f"select {EDGE_COLUMNS} from raw", PROFILE, EDGES),
    "edges_final": q(f"select {EDGE_COLUMNS} from edge", PROFILE, EDGES),
    "edges_compact": q(f"select {EDGE_COLUMNS} from edge", PROFILE, EDGES, compact=True),
    "nodes_first_wins": q("select id, round(lat, 7) as lat, round(lon, 7) as lon from fx_node"),
    "amenities": q("select id as node_id, amenity as kind, name, round(lat, 7) as lat, round(lon, 7) as lon from fx_node where amenity in ('drinking_water', 'toilets')"),
    "haversine": q("select way_id, pos, round(meters, 3) as meters from geo", PROFILE, EDGES),
    "grid_cells": q("select id, cast(trunc(lat / cast(0.002 as double)) as bigint) as cy, cast(trunc(-lon / cast(0.002 as double)) as bigint) as cx from fx_node"),
    "tile_names": q("select distinct cast(floor(lat) as bigint) as y, cast(floor(lon) as bigint) as x, format('N{:02d}E{:03d}', cast(floor(lat) as bigint), cast(floor(lon) as bigint)) as tile from fx_node"),
    "official_nearest": q("select idx, node_id from near", OFFICIAL_NODES),
    "official_nodes": q("select node_id, cast(route_id as int) as route_id, cast(sequence as int) as sequence from onode", OFFICIAL_NODES),
    "edges_discounted": q(
        "select src, dst, round(meters, 3) as meters, round(case when src in (select node_id from onode) and dst in (select node_id from onode) then cost * cast(0.45 as double) else cost end, 3) as cost, is_cycleway, is_dismount from edge",
        PROFILE, EDGES, OFFICIAL_NODES,
    ),
    "nearest_node": q(" union all ".join(f"select {i} as point, * from (select id, round(score, 9) as score from ({_nearest(*p)}))" for i, p in enumerate(POINTS))),
    "nearest_node_multi": q(
        "select id, cast(graph as int) as graph, round(score, 9) as score from ("
        + " union all ".join(f"select {g} as graph, * from ({_nearest(*POINTS[0], where=f'id % 3 = {g}')})" for g in range(3))
        + ") order by score, graph, id limit 1"
    ),
    "components": q("select node, component from comp", PROFILE, EDGES, COMPONENTS, recursive=True),
    "connected_pairs": q(_pairs, PROFILE, EDGES, COMPONENTS, recursive=True),
    "connected_across": q(_pairs, PROFILE, EDGES, COMPONENTS, recursive=True),
    "way_centroids": q("select way_id as id, round(avg(lat), 7) as lat, round(avg(lon), 7) as lon from fx_ref join fx_node on fx_node.id = ref where way_id in (select id from fx_way) group by way_id"),
    "places": q('select id, name, name_ko, name_en, subtitle, round(latitude, 7) as latitude, round(longitude, 7) as longitude, "searchTerms" from place', PLACES),
    "place_tokens": q("""select term, 'searchTerms' as "column", id, cast(pos - 1 as bigint) as pos from (
        select id, unnest(ts) as term, generate_subscripts(ts, 1) as pos from (
          select id, """ + _terms.format('"searchTerms"') + """ as ts from place))""", PLACES),
    "place_match": q("select id from (select id, " + _terms.format("concat_ws(' ', name, name_ko, subtitle, \"searchTerms\")") + """ as ts from place)
        where list_contains(ts, 'toilets') and len(list_filter(ts, lambda x: starts_with(x, '아라1'))) > 0""", PLACES),
    "folded_terms": f"select term, count(*) as n from (select unnest({_terms.format('text')}) as term from documents) group by term",
    "opl_files": q("select 'n' as kind, id, cast((amenity is not null)::int + (name is not null)::int + (name_ko is not null)::int + (brand is not null)::int as bigint) as n_tags, cast(0 as bigint) as n_refs from fx_node union all "
        f"select 'w', w.id, cast({' + '.join(f'(w.{c} is not null)::int' for c in WAY_TAGS)} as bigint), r.n from fx_way w join (select way_id, count(*) as n from fx_ref group by 1) r on r.way_id = w.id"),
    "route_points": q("select cast(row_number() over (order by idx) - 1 as bigint) as idx, cast(route_id as int) as route_id, cast(sequence as int) as sequence, lat, lon from fx_official where route_id between 1 and 13 and idx % 9 <> 4"),
    "elevation_files": q("select id, case when lat < 38 and lon < 128 then cast(round_even(3 * ((floor(lat) + 1 - lat) * 1200) + 2 * ((lon - floor(lon)) * 1200), 0) as int) else 0 end as ele from fx_node"),
    "region_assign": q("select r.id as region, n.id from fx_node n join region r on n.lon between west and east and n.lat between south and north", REGION),
    "region_complete_ways": q(
        "inside as (select r.id as region, n.id from fx_node n join region r on n.lon between west and east and n.lat between south and north),"
        " touched as (select distinct region, way_id from inside join fx_ref on ref = inside.id where way_id in (select id from fx_way))"
        " select region, 'n' as kind, id from (select region, id from inside union select region, ref from touched join fx_ref using (way_id) where ref in (select id from fx_node))"
        " union all select region, 'w', way_id from touched",
        REGION,
    ).replace("\ninside as", ",\ninside as"),
    "tag_filter_compact": _kept(f"{_in('highway', COMPACT_HIGHWAYS)} or bicycle in ('designated', 'official')", "amenity in ('drinking_water', 'toilets')"),
    "tag_filter_detail": _kept("highway is not null", "amenity in ('drinking_water', 'toilets')"),
    "tag_filter_named": _kept("false", "name is not null"),
    "region_quadrants": f"""with {REGION}, m as (select *, round((west + east) / 2, 6) as x, round((south + north) / 2, 6) as y from region)
        select id, 'SW' as quadrant, west as q_west, south as q_south, x as q_east, y as q_north from m union all select id, 'SE', x, south, east, y from m
        union all select id, 'NW', west, y, x, north from m union all select id, 'NE', x, y, east, north from m""",
    "tile_layers": f"""with l(layer, lo, hi, write_to, below, level, algo) as (values {', '.join(map(_layer, LAYERS))})
        select layer, coalesce(write_to, layer) as target, cast(z as int) as zoom, coalesce(z < below, false) as simplified
        from (select *, unnest(generate_series(lo, hi)) as z from l)""",
    "elevation_bilinear": q("select id, cast(round_even(3 * ((floor(lat) + 1 - lat) * 1200) + 2 * ((lon - floor(lon)) * 1200), 0) as int) as ele from fx_node"),
    "dem_catalogue": "select lat, lon, format('N{:02d}E{:03d}', lat, lon) as tile from (select unnest(range(33, 39)) as lat) cross join (select unnest(range(125, 131)) as lon)",
    "manifest_assets": """with n as (select n_nationkey as k, n_name as id from nation) select 'regional' as grp, id, concat(id, '.routing.sqlite') as file, cast(1000 + k * 10 as bigint) as size, cast(400 + k as bigint) as "downloadSize" from n
        union all select 'search', id, concat(id, '.places.sqlite'), cast(500 + k * 7 as bigint), cast(200 + k as bigint) from n
        union all select 'nationwide', null, 'all.routing.sqlite', 99999, 44444""",
    "manifest_totals": """with n as (select n_nationkey as k from nation), a as (select 1000 + k * 10 as size, 400 + k as d from n union all select 500 + k * 7, 200 + k from n union all select 99999, 44444)
        select count(*) as assets, cast(sum(size) as bigint) as original, cast(sum(d) as bigint) as transfer, format('{:.3f}', sum(d) / sum(size)) as ratio from a""",
    "asset_sha256": "select page_id, cast(octet_length(encode(html)) as bigint) as size, sha256(html) as sha256 from pages",
}
