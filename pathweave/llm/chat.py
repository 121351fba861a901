"""Chat formatting with Spark expressions only (operator 8).

A conversation's turns are collected as structs and sorted by turn; adjacent turns of one role
share a block (`### role: `, the texts with `</part>` between them, `</turn>` and a line feed). In
texts and roles a backslash, `###` and `</` (and a role's colon) are written as backslash and a
letter, so no control string can stand in a text and everything can be read back. The loss mask is
a list of (start, length) in code points of the formatted text: the text of each assistant turn.

Defined cases: a null text or role is empty; rows of one turn number are ordered by role and text;
a null conv_id is a conversation of its own; a conversation without an assistant has an empty
mask; an empty table gives no rows; other columns are ignored. A conversation is one row, so its
turns meet in one task, as its text must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, COLON, PART, END = "### ", ": ", "</part>", "</turn>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for raw, code in (("\\", "\\b"), ("###", "\\h"), ("</", "\\l")):
        out = F.replace(out, F.lit(raw), F.lit(code))
    return out


def unescape(text: Column) -> Column:
    for raw, code in ((":", "\\c"), ("</", "\\l"), ("###", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, n_blocks) from (conv_id, turn, role, text)."""
    own = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    n, t = F.size("turns"), F.col("turns")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
    chats = chats.withColumn("starts", starts)

    def block(s: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1), n)
        return F.struct(F.get(t, s)["role"].alias("role"), F.transform(F.slice(t, s + 1, end - s), lambda x: escape(x["text"])).alias("parts"))

    chats = chats.withColumn("blocks", F.transform("starts", block))
    head = lambda b: F.concat(F.lit(HEAD), F.replace(escape(b["role"]), F.lit(":"), F.lit("\\c")), F.lit(COLON))
    text = F.array_join(F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["parts"], PART), F.lit(END))), "")

    def parts(acc: Column, b: Column) -> Column:
        """Adds the block's parts' spans to acc, a struct of the offset so far and the spans."""
        spans = F.aggregate(
            b["parts"],
            F.struct((acc["at"] + F.length(head(b))).cast("int").alias("at"), acc["spans"].alias("spans")),
            lambda a, p: F.struct(
                (a["at"] + F.length(p) + len(PART)).cast("int").alias("at"),
                F.when(b["role"] == LOSS_ROLE, F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(p).alias("length"))))).otherwise(a["spans"]).alias("spans"),
            ),
        )
        return F.struct((spans["at"] - len(PART) + len(END)).cast("int").alias("at"), spans["spans"].alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))
    spans = F.aggregate("blocks", zero, parts)["spans"]
    return chats.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"), F.size("blocks").alias("n_blocks"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def turns(b: Column) -> Column:
        at = F.instr(b, COLON)
        role = unescape(F.substring(b, F.lit(len(HEAD) + 1), at - len(HEAD) - 1))
        body = F.substring(b, at + len(COLON), F.length(b))
        return F.transform(F.split(body, PART), lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
