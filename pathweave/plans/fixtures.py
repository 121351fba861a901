"""Nodes, ways, refs and curated points derived from the TPC-H-like tables.

The SQL runs unchanged in Spark and DuckDB, so an oracle can inline it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import prepare
from pathweave.sources import opl

NODE = """
select c_custkey as id,
  cast(37.41 as double) + cast((c_custkey % 60)*50 + (c_custkey*7919) % 50 as double)/cast(10000 as double) as lat,
  cast(126.76 as double) + cast((c_custkey % 60)*70 + (c_custkey*104729) % 70 as double)/cast(10000 as double) as lon,
  case c_custkey % 10 when 0 then 'drinking_water' when 1 then 'toilets' when 2 then 'cafe' end as amenity,
  case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then c_name end as name,
  case when c_custkey % 7 < 3 then concat('아라', cast(c_custkey as varchar(20))) end as name_ko,
  case when c_custkey % 5 = 0 then c_mktsegment end as brand
from customer
"""

WAY = """
select o_orderkey as id,
  case o_orderkey % 16 when 0 then 'cycleway' when 1 then 'path' when 2 then 'track' when 3 then 'footway'
    when 4 then 'pedestrian' when 5 then 'living_street' when 6 then 'residential' when 7 then 'service'
    when 8 then 'unclassified' when 9 then 'tertiary' when 10 then 'secondary' when 11 then 'primary'
    when 12 then 'trunk' when 13 then 'motorway' when 14 then 'steps' else 'primary_link' end as highway,
  case o_custkey % 8 when 0 then 'yes' when 1 then 'designated' when 2 then 'no' when 3 then 'dismount'
    when 4 then 'permissive' end as bicycle,
  case o_orderpriority when '1-URGENT' then 'asphalt' when '2-HIGH' then 'gravel' when '3-MEDIUM' then 'ground' end as surface,
  case cast(floor(o_totalprice) as bigint) % 6 when 0 then 'no' when 1 then 'private' end as access,
  case cast(floor(o_totalprice) as bigint) % 5 when 0 then 'yes' when 1 then 'no' when 2 then 'designated' end as foot,
  case cast(floor(o_totalprice) as bigint) % 7 when 0 then 'bad' when 1 then 'impassable' end as smoothness,
  case cast(floor(o_totalprice) as bigint) % 11 when 0 then 'lane' when 1 then 'track' end as cycleway,
  case when o_custkey % 3 = 0 then 'yes' end as bridge,
  case o_orderstatus when 'F' then 'yes' when 'P' then '-1' end as oneway,
  case cast(floor(o_totalprice) as bigint) % 13 when 0 then 'no' when 1 then 'yes' when 2 then '-1' when 3 then '' end as oneway_bicycle
from orders
"""

REF = """
select l_orderkey as way_id,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as bigint) as pos,
  (l_partkey % (select cast(floor(cast(count(*) as double)/cast(60 as double)) as bigint) + 2 from customer))*60 + l_orderkey % 60 as ref
from lineitem
"""

OFFICIAL = """
select s_suppkey as idx, s_suppkey % 15 as route_id, s_suppkey as sequence,
  cast(37.41 as double) + cast((s_suppkey % 60)*50 + (s_suppkey*31) % 50 as double)/cast(10000 as double)
    + case when s_suppkey % 4 = 0 then cast(1 as double) else cast(0 as double) end as lat,
  cast(126.76 as double) + cast((s_suppkey % 60)*70 + (s_suppkey*37) % 70 as double)/cast(10000 as double) as lon
from supplier
"""

WAY_TAGS = ("highway", "bicycle", "surface", "access", "foot", "smoothness", "cycleway", "bridge", "oneway", "oneway_bicycle")
NODE_TAGS = ("amenity", "name", "name_ko", "brand")
KEYS = {"oneway_bicycle": "oneway:bicycle", "name_ko": "name:ko"}
TABLES = ("customer", "orders", "lineitem", "supplier")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A fixture's SQL over the tables of a folder, without leaving names in the catalog."""
    prepare(spark)
    names = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"from {t}" in sql}
    return spark.sql(sql.replace("from ", "from {").replace("{customer", "{customer}").replace("{orders", "{orders}").replace("{lineitem", "{lineitem}").replace("{supplier", "{supplier}"), **names)


def _tag_text(columns: tuple[str, ...]):
    return F.concat_ws(",", *[F.concat(F.lit(f"{KEYS.get(c, c)}="), opl.encode(F.col(c))) for c in columns])


def node_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes as OPL lines (value, ord)."""
    at = lambda c: F.col(c).cast("decimal(10,7)").cast("string")
    value = F.concat(F.lit("n"), F.col("id").cast("string"), F.lit(" v1 dV c1 t i0 u T"), _tag_text(NODE_TAGS), F.lit(" x"), at("lon"), F.lit(" y"), at("lat"))
    return view(spark, sf_dir, NODE).select(value.alias("value"), F.col("id").alias("ord"))


def way_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ways as OPL lines (value, ord)."""
    refs = view(spark, sf_dir, REF).groupBy(F.col("way_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "ref"))).alias("r"))
    text = F.array_join(F.transform("r", lambda x: F.concat(F.lit("n"), x["ref"].cast("string"))), ",")
    value = F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" v1 dV c1 t i0 u T"), _tag_text(WAY_TAGS), F.lit(" N"), F.coalesce(text, F.lit("")))
    return view(spark, sf_dir, WAY).join(refs, "id", "left").select(value.alias("value"), F.col("id").alias("ord"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opl.nodes(node_lines(spark, sf_dir))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opl.ways(way_lines(spark, sf_dir))


def official(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, OFFICIAL).withColumns({"route_id": F.col("route_id").cast("int"), "sequence": F.col("sequence").cast("int")})
