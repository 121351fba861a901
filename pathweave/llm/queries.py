"""The queries of the corpus operators, one for each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup as op

    found = op.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "lines_in", "lines_dropped")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid as op

    docs = read(spark, sf_dir, "documents")
    found = op.predict(docs.select("doc_id", "text"), op.fit(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import collision_ann as op

    return op.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe as op

    coded = op.decode(op.encode(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids"))
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import hilbert_shards as op

    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    docs = read(spark, sf_dir, "documents").select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), "source", "lang", F.log2(size).alias("log_size"))
    found = op.shards(docs, ["source", "lang", "log_size"], ["text_crc32", "doc_id"])
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing as op

    planned = op.plan(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity as op

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = op.predict(docs, op.fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat as op

    said = r"r'\### Assistant: </turn> ok'"
    extra = spark.sql(f"select -7L conv_id, 0L turn, 'user' role, {said} text union all select -7L, 1L, 'assistant', {said}")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = op.format_chats(rows)
    turns = op.read_turns(F.col("formatted"))
    read_back = chats.select("conv_id", "formatted", turns.alias("turns"), op.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
with r as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</', '\l') as body,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</', '\l'), ':', '\c') as name,
    lag(role) over w as before
  from r window w as (partition by conv_id order by turn, role, text)),
b as (
  select *, length(body) + case when before is null then length(name) + 6 when before <> role then length(name) + 14 else 7 end as chars
  from e)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) + 8 as bigint) as formatted_chars
from b group by conv_id
"""


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import syncmers as op

    return op.edited_likeness(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash_dedup as op

    found = op.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", op.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def queries() -> dict:
    return {f.__name__: f for f in (op1_line_dedup, op2_language_id, op3_collision_ann, op4_bpe_roundtrip, op5_hilbert_sharding, op6_source_mixing, op7_toxicity, op8_chat_format, op9_syncmer_fingerprints, op10_simhash_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_format": OP8_SQL}
