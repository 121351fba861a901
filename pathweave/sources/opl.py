"""OPL text (one element a line) as columns: escapes, tag bags, node and way scans.

Everything is a column expression. Input frames have `value` (the line) and `ord`, which orders
lines as the file does; read_lines() makes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "%[0-9a-fA-F]+%"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines with their place: file, block and row in the block."""
    text = spark.read.text(list(paths))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return text.select("value", place.alias("ord"))


def decode(text: Column) -> Column:
    """Each %hex% becomes its code point, from left to right; other % stay.

    A code point that does not exist (over 10FFFF, or a surrogate) makes the result null.
    """
    tokens = F.regexp_extract_all(text, F.lit(f"({ESCAPE}|%|[^%]+)"), F.lit(1))
    digits = lambda t: F.ltrim(F.substring(t, F.lit(2), F.length(t) - 2), F.lit("0"))
    code = lambda t: F.conv(digits(t), 16, 10).cast("bigint")
    escaped = lambda t: (F.length(t) > 2) & t.startswith("%") & t.endswith("%")
    bad = lambda t: escaped(t) & ((F.length(digits(t)) > 6) | (code(t) > 0x10FFFF) | code(t).between(0xD800, 0xDFFF))
    char = lambda t: F.decode(F.unhex(F.lpad(digits(t), 8, "0")), "UTF-32")
    whole = F.array_join(F.transform(tokens, lambda t: F.when(escaped(t), char(t)).otherwise(t)), "")
    return F.when(~F.contains(text, F.lit("%")), text).when(~F.exists(tokens, bad), whole)


#: What encode() leaves as it is.
PLAIN = "[A-Za-z0-9_:.;/-]"


def encode(text: Column) -> Column:
    """The inverse of decode: all but ASCII letters, digits and a few signs as %hex%."""
    chars = F.split(text, "")
    code = lambda c: F.ltrim(F.lower(F.hex(F.encode(c, "UTF-32"))), F.lit("0"))
    coded = F.array_join(F.transform(chars, lambda c: F.when(c.rlike(f"^{PLAIN}?$"), c).otherwise(F.concat(F.lit("%"), code(c), F.lit("%")))), "")
    return F.when(text.rlike(rf"\A{PLAIN}*\z"), text).otherwise(coded)


def tags(raw: Column) -> Column:
    """`k=v,k=v` as a map; items without = are dropped, the last of equal keys stays.

    Text without an escape, which is most of it, is split and no more.
    """
    pairs = F.map_filter(F.str_to_map(raw, F.lit(","), F.lit("=")), lambda k, v: v.isNotNull())
    items = F.transform(F.map_entries(pairs), lambda e: F.struct(decode(e["key"]).alias("key"), decode(e["value"]).alias("value")))
    decoded = F.map_from_entries(F.filter(items, lambda e: e["key"].isNotNull()))
    return F.when(~F.contains(raw, F.lit("%")), pairs).otherwise(decoded)


def tag(bag: Column, key: str) -> Column:
    """A tag, or the empty string."""
    return F.coalesce(F.try_element_at(bag, F.lit(key)), F.lit(""))


def only(df: DataFrame, carried: list[str], good: Column, **fields: Column) -> DataFrame:
    """carried and fields of the rows where good holds.

    The rows pass through a generator, not a filter: a filter would be pushed below the projections
    that it reads, which would then be computed once more for each use.
    """
    row = F.struct(*[c.alias(n) for n, c in fields.items()])
    return df.select(*carried, F.inline(F.array_compact(F.array(F.when(good, row)))))


def elements(lines: DataFrame, kind: str) -> DataFrame:
    """The lines of nodes (n) or ways (w); relations and others have no reader."""
    return lines.where(F.left("value", F.lit(1)) == kind)


def nodes(lines: DataFrame, quarantined: bool = False) -> DataFrame:
    """(ord, id, lat, lon, tags). Nodes without a coordinate field vanish.

    With quarantined: the lines (ord, value) whose id or coordinates are no numbers.
    """
    fields = F.split(F.trim("value"), r"(?U)\s+")
    first = lambda p: F.get(F.filter("fields", lambda f: f.startswith(p)), F.lit(0))
    own = elements(lines, "n").withColumn("fields", fields)
    own = own.withColumns({"x": first("x"), "y": first("y"), "t": F.substring(first("T"), 2, 1 << 30)})
    number = lambda c: F.substring(c, F.lit(2), F.lit(1 << 30)).try_cast("double")
    own = own.withColumns({"id": F.substring(F.get("fields", F.lit(0)), 2, 1 << 30).try_cast("bigint"), "lat": number("y"), "lon": number("x")})
    located = F.col("x").isNotNull() & F.col("y").isNotNull()
    good = F.col("id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    if quarantined:
        return own.where(located & ~good).select("ord", "value")
    bag = tags(F.coalesce("t", F.lit("")))
    return only(own, ["ord"], located & good, id=F.col("id"), lat=F.col("lat"), lon=F.col("lon"), tags=bag)


WAY = r"(?d)^w(-?[0-9]+) .* T(.*?) N(.*)$"


def ways(lines: DataFrame, quarantined: bool = False) -> DataFrame:
    """(ord, id, tags, refs). A line needs a metadata field between its id and its tags.

    With quarantined: the lines that match but have no or malformed refs.
    """
    part = lambda n: F.regexp_extract("value", WAY, n)
    own = elements(lines, "w").withColumn("value", F.rtrim("value")).withColumns({"w": part(1), "t": part(2), "r": part(3)})
    refs = F.transform(F.split("r", ","), lambda r: F.regexp_replace(r, "^n+", "").try_cast("bigint"))
    own = own.withColumn("refs", refs)
    matched, good = F.col("w") != "", ~F.exists("refs", lambda r: r.isNull())
    if quarantined:
        return own.where(matched & ~good).select("ord", "value")
    return only(own, ["ord"], matched & good, id=F.col("w").cast("bigint"), tags=tags(F.col("t")), refs=F.col("refs"))


def field_map(value: Column) -> Column:
    """S3: {first character: rest} of the space-separated fields longer than 1; the last wins."""
    fields = F.filter(F.split(value, " "), lambda f: F.length(f) > 1)
    return F.map_from_entries(F.transform(fields, lambda f: F.struct(F.left(f, F.lit(1)), F.substring(f, F.lit(2), F.length(f)))))


def place_elements(lines: DataFrame) -> DataFrame:
    """The place job's scan: (ord, kind, id, lat, lon, tags, refs) of nodes and ways.

    A coordinate field without a value does not count as one; refs must begin with n.
    """
    own = lines.where(F.left("value", F.lit(1)).isin("n", "w")).withColumn("f", field_map(F.rtrim("value")))
    get = lambda k: F.try_element_at("f", F.lit(k))
    kind = F.left("value", F.lit(1))
    refs = F.transform(F.filter(F.split(F.coalesce(get("N"), F.lit("")), ","), lambda r: r.startswith("n")), lambda r: F.substring(r, F.lit(2), F.length(r)).try_cast("bigint"))
    known = own.select(
        "ord",
        kind.alias("kind"),
        F.coalesce(F.when(kind == "n", get("n")), get("w")).try_cast("bigint").alias("id"),
        get("y").try_cast("double").alias("lat"),
        get("x").try_cast("double").alias("lon"),
        tags(F.coalesce(get("T"), F.lit(""))).alias("tags"),
        refs.alias("refs"),
    )
    rest = {c: F.col(c) for c in known.columns if c != "ord"}
    return only(known, ["ord"], F.col("id").isNotNull(), **rest)
