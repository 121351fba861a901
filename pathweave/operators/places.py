"""The place index and its postings."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.operators.dedup import last_wins
from pathweave.session import cut

# Keys that make an object a place; the order is our priority for its category.
ACCEPTED = ("amenity", "shop", "tourism", "leisure", "place", "building", "office", "healthcare", "public_transport", "railway")
INDEXED = ("name", "name_ko", "name_en", "subtitle", "searchTerms")


def centroids(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, lat, lon) of ways (id, refs): the mean of the known vertices, repeats included."""
    refs = ways.select("id", F.explode("refs").alias("ref"))
    found = refs.join(nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref")
    return found.groupBy("id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def places(elements: DataFrame) -> DataFrame:
    """The place rows of (ord, kind, id, lat, lon, tags, refs); nodes without coordinates vanish.

    Elements are parsed once, into a table: nodes as places, nodes as coordinates and ways read it.
    """
    elements = cut(elements)
    located = elements.where("kind = 'n' and lat is not null and lon is not null")
    ways = elements.where("kind = 'w'")
    middle = centroids(ways.select("id", "refs"), last_wins(located.select("id", "lat", "lon", "ord"), ["id"], F.col("ord")))
    on_ways = ways.drop("lat", "lon").join(middle, "id")
    both = located.select("kind", "id", "lat", "lon", "tags").unionByName(on_ways.select("kind", "id", "lat", "lon", "tags"))
    return described(both)


def described(rows: DataFrame) -> DataFrame:
    """F6 and P14-P19 over (kind, id, lat, lon, tags)."""
    get = lambda k: F.try_element_at("tags", F.lit(k))
    full = lambda c: F.nullif(c, F.lit(""))
    name = F.coalesce(full(get("name")), full(get("name:ko")), full(get("name:en")))
    address = full(F.concat_ws(" ", *[full(get(f"addr:{k}")) for k in ("city", "district", "street", "housenumber")]))
    category = F.coalesce(*[get(k) for k in ACCEPTED])
    own = rows.withColumns({"__n": name, "__a": address, "__c": category}).where("__n is not null and __c is not null")
    terms = F.concat_ws(" ", "__n", full(get("name:ko")), full(get("name:en")), "__a", full(F.col("__c")), full(get("brand")))
    return own.select(
        F.concat("kind", F.col("id").cast("string")).alias("id"),
        F.col("__n").alias("name"),
        F.coalesce(get("name:ko"), F.lit("")).alias("name_ko"),
        F.coalesce(get("name:en"), F.lit("")).alias("name_en"),
        F.coalesce("__a", "__c").alias("subtitle"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        terms.alias("searchTerms"),
    )


@lru_cache(maxsize=1)
def _bare_letters() -> tuple[str, str]:
    """Letters with marks and, at the same place, the letter alone; then the marks, which go."""
    pairs, marks = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base, *rest = unicodedata.normalize("NFD", char)
        if rest and all(unicodedata.category(c) == "Mn" for c in rest):
            pairs.append((char, base))
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


def folded(text: Column) -> Column:
    """Lower case without diacritics."""
    low = F.lower(text)
    return F.when(low.rlike(r"[^\x00-\x7f]"), F.translate(low, *_bare_letters())).otherwise(low)


def terms(text: Column) -> Column:
    """Runs of letters and digits, case folded, without diacritics."""
    return F.filter(F.split(folded(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def postings(index: DataFrame, columns: tuple[str, ...] = INDEXED) -> DataFrame:
    """(term, column, id, pos) of the indexed columns."""
    parts = [F.struct(F.lit(c).alias("column"), terms(F.coalesce(F.col(c), F.lit(""))).alias("terms")) for c in columns]
    own = index.select("id", F.explode(F.array(*parts)).alias("p"))
    own = own.select("id", "p.column", F.posexplode("p.terms").alias("pos", "term"))
    return own.select("term", "column", "id", F.col("pos").cast("bigint").alias("pos"))


def bm25(index: DataFrame, query: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) of the rows that hold a term of the query, over searchTerms (ours)."""
    own = postings(index, ("searchTerms",))
    asked = [t for t in dict.fromkeys(_split(query)) if t]
    sizes = own.groupBy("id").agg(F.count("*").alias("size"))
    n, mean = sizes.agg(F.count("*"), F.avg("size")).first()
    hits = own.where(F.col("term").isin(*asked)).groupBy("term", "id").agg(F.count("*").alias("tf"))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    scored = hits.join(df, "term").join(sizes, "id")
    idf = F.log((F.lit(float(n or 0)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / (mean or 1.0)))
    return scored.withColumn("part", part).groupBy("id").agg(F.sum("part").alias("score"))


def _split(query: str) -> list[str]:
    plain = "".join(c for c in unicodedata.normalize("NFD", query.casefold()) if unicodedata.category(c) != "Mn")
    return "".join(c if c.isalnum() else " " for c in unicodedata.normalize("NFC", plain)).split()


def match(posted: DataFrame, query: str) -> DataFrame:
    """(id) of the rows that hold every term of the query in any column; a last `*` asks for a prefix.

    posted: postings(), which a table sorted by term serves with a range scan for each term.
    """
    asked, prefix = _split(query), query.rstrip().endswith("*")
    own = None
    for i, term in enumerate(asked):
        hit = F.col("term").startswith(term) if prefix and i + 1 == len(asked) else F.col("term") == term
        ids = posted.where(hit).select("id").distinct()
        own = ids if own is None else own.join(ids, "id", "left_semi")
    return posted.select("id").limit(0) if own is None else own


def write_index(index: DataFrame, folder: str) -> None:
    """The place rows, and their postings range sorted by term."""
    index.write.mode("overwrite").parquet(f"{folder}/places")
    postings(index).repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{folder}/postings")
