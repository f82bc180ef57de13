"""Chat formatting of conversations with typed content parts.

Every turn becomes ``<s>role[INST]content</s>``, a reply ``<s>assistant[/INST]content</s>``. A visitor
goes through a turn's parts in order: text is escaped, images, audio and documents leave a
placeholder and an entry in ``attachments`` with the number of tokens that the placeholder expands to.
A control string in a text or role gets a backslash after its first character (and one more if
it has some), so it is none in the output, and taking one away again restores it exactly.

The loss mask is a list of spans of the output, one for each reply's content. Only DataFrame
functions; a conversation is one output row, and only its own turns meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = ["s>", "/s>", "INST]", "/INST]", "image>", "audio>", "document>"]
REPLY = "assistant"
# Tokens that one unit of an attachment expands to: image tiles, seconds of audio, pages of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

_REST = "|".join(CONTROLS).replace("]", r"\]")
PARTS = "array<struct<kind:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?=(?:{_REST}))", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?=(?:{_REST}))", r"$1$2")


def text_parts(text: Column) -> Column:
    """The parts of a plain text; a null text is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))).cast(PARTS)


def _visit(parts: Column) -> Column:
    """One text for all parts: runs of text escaped as a whole, a placeholder for each attachment."""
    def step(acc: Column, part: Column) -> Column:
        placed = part["kind"].isin(*TOKENS_PER_UNIT)
        return F.when(placed, F.struct(
            F.concat(acc["done"], escape(acc["text"]), F.lit("<"), part["kind"], F.lit(">")).alias("done"), F.lit("").alias("text"))
        ).otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["text"], F.coalesce(part["text"], F.lit(""))).alias("text")))

    return F.aggregate(parts, F.struct(F.lit("").alias("done"), F.lit("").alias("text")), step,
                       lambda acc: F.concat(acc["done"], escape(acc["text"])))


def turns(rows: DataFrame) -> DataFrame:
    """Each row of ``(conv_id, turn, role, parts)`` as formatted text. Kinds not known count as text."""
    parts = F.filter(F.coalesce("parts", F.array().cast(PARTS)), lambda p: p.isNotNull())
    parts = F.transform(parts, lambda p: F.struct(F.coalesce(p["kind"], F.lit("text")).alias("kind"), *[p[c].alias(c) for c in ("text", "ref", "units")]))
    content = _visit(parts)
    placed = F.filter(parts, lambda p: p["kind"].isin(*TOKENS_PER_UNIT))
    per_unit = F.create_map(*[F.lit(x) for kv in TOKENS_PER_UNIT.items() for x in kv])
    attached = F.transform(placed, lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), (F.coalesce(p["units"], F.lit(1)) * per_unit[p["kind"]]).cast("long").alias("tokens")))
    role = F.coalesce("role", F.lit(""))
    reply = role == REPLY
    head = F.concat(F.lit("<s>"), escape(role), F.when(reply, "[/INST]").otherwise("[INST]"))
    return rows.select("conv_id", "turn", reply.alias("reply"), head.alias("head"), content.alias("content"), attached.alias("attached"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans, attachments, attachment_tokens`` for each conversation.

    ``rows(conv_id, turn, role, parts)``; turns in order, null first, equal ones by their text. A null
    conv_id is a conversation too. Spans are ``(start, length)`` in characters, from 0.
    """
    made = turns(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "head", "content", "reply", "attached"))).alias("turns"))
    text = lambda t: F.concat(t["head"], t["content"], F.lit("</s>"))
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(text(t))).alias("at"),
        F.when(t["reply"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["content"]).alias("length")))))
        .otherwise(acc["spans"]).alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    attachments = F.flatten(F.transform("turns", lambda t: t["attached"]))
    return made.select(
        "conv_id", F.array_join(F.transform("turns", text), "").alias("formatted"), F.aggregate("turns", start, step)["spans"].alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, unescaped; placeholders stay."""
    ended = F.split(formatted, "</s>")
    def turn(x: Column) -> Column:
        marked = F.regexp_extract(x, r"(?s)^<s>(.*?)\[/?INST\](.*)$", 1)
        return F.struct(unescape(marked).alias("role"), unescape(F.regexp_extract(x, r"(?s)^<s>(.*?)\[/?INST\](.*)$", 2)).alias("text"))
    return F.transform(F.slice(ended, 1, F.size(ended) - 1), turn)


def report(made: DataFrame) -> DataFrame:
    """The digests of ``format_conversations``, read back from its output."""
    back = read_turns(F.col("formatted"))
    lost = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return made.select("conv_id", "formatted", back.alias("turns"), lost.alias("lost")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
