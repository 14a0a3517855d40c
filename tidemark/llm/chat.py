r"""Chat formatting: every assistant turn is an example of its own.

A conversation is written once in the template

    ### role: text</turn>

one line per turn. An example is a prefix of that text: all turns up to and
including one assistant turn, of which only the reply's text is trainable. Examples are therefore stored as spans over the
conversation, so that their number and size grow with the turns and not with
their square; ``example_texts`` writes the prefixes out where they are wanted.

The characters that control strings are made of are escaped inside texts and
roles: ``\`` as ``\b``, ``<`` as ``\l``, ``#`` as ``\h``, and in roles ``:`` as
``\c``. An escaped text thus holds neither ``</turn>`` nor ``###``, and reading
back gives the very text.

Defined cases: null texts and roles are empty; turns sort by (turn, role,
text), nulls first, repeated rows stay; rows without a conversation id form one
conversation; a conversation without assistant turns has no examples; other
columns are not read. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
HEAD = "### "
COLON = ": "


def escaped(text: Column) -> Column:
    for plain, code in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("\\c"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\c"), F.lit(":")))


def formatted(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted (the text) and examples, an
    array of (turn_index, context_chars, reply_chars), offsets in code points.
    Reply characters follow the context's; nothing else of an example is trained.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit(COLON)).alias("head"),
        escaped(F.col("text")).alias("reply"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select(
        "conv_id", (F.row_number().over(order) - 1).alias("at"), F.concat("head", "reply", F.lit(END)).alias("piece"),
        (F.sum(F.length("head") + F.length("reply") + len(END)).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("reply") - len(END)).alias("context_chars"),
        F.length("reply").cast("long").alias("reply_chars"), (F.col("role") == trained_role).alias("trained"),
    )
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "piece", "context_chars", "reply_chars", "trained"))).alias("turns"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["trained"]),
            lambda t: F.struct(t["at"].alias("turn_index"), t["context_chars"].alias("context_chars"), t["reply_chars"].alias("reply_chars")),
        ).alias("examples"),
    )


def examples(chats: DataFrame) -> DataFrame:
    """One row per assistant turn of :func:`formatted`: its spans."""
    return chats.select("conv_id", F.posexplode("examples").alias("example", "span")).select("conv_id", "example", "span.*")


def example_texts(chats: DataFrame) -> DataFrame:
    """Examples with context and target written out; their size is that of all
    prefixes, so ask for it on the conversations that need it."""
    one = chats.select("conv_id", "formatted", F.posexplode("examples").alias("example", "span"))
    return one.select(
        "conv_id", "example",
        F.expr("substring(formatted, 1, CAST(span.context_chars AS INT))").alias("context"),
        F.expr("substring(formatted, CAST(span.context_chars AS INT) + 1, CAST(span.reply_chars AS INT))").alias("target"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and trained texts as read from the formatted text alone: conv_id,
    turns (array of role, text) and trained (array of text, in order)."""
    pieces = F.split("formatted", END)
    parsed = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescaped_role(F.regexp_extract(p, r"(?s)^### ([^:]*): ", 1)).alias("role"),
            unescaped(F.regexp_extract(p, r"(?s)^### [^:]*: (.*)$", 1)).alias("text"),
        ),
    )
    return chats.select("conv_id", "formatted", "examples", parsed.alias("turns")).select(
        "conv_id", "formatted", "examples", "turns", F.transform("examples", lambda e: F.get("turns", e["turn_index"])["text"]).alias("trained"),
    )


def trained_texts(chats: DataFrame, keep: list[str]) -> DataFrame:
    """Each example's reply, cut out of the formatted text by the example's own offsets
    and unescaped: the columns to ``keep``, example and target. A conversation
    without examples has one row without a target."""
    one = chats.select(*keep, "formatted", F.posexplode_outer("examples").alias("example", "span"))
    target = F.expr("substring(formatted, CAST(span.context_chars AS INT) + 1, CAST(span.reply_chars AS INT))")
    return one.select(*keep, "example", unescaped(target).alias("target"))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of the turns that :func:`read_back` finds and of all
    text under the loss masks of the exploded examples, in order. Examples stay in the
    partition of their conversation, so bringing them together needs no exchange."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = read_back(chats).select(
        "conv_id", "formatted", "examples", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    keep = ["conv_id", "n_turns", "turns_sha256", "formatted_chars"]
    replies = F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "target"))))
    gathered = trained_texts(whole, keep).groupBy(*keep).agg(F.array_join(F.transform(replies, lambda r: r["target"]), "").alias("trained"))
    return gathered.select(
        "conv_id", "n_turns", "turns_sha256", F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"), "formatted_chars",
    )
