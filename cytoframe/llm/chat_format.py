"""Chat formatting from event logs: fold the events of a conversation, render, read back. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END, STOP = "<|im_start|>", "<|im_end|>", "</s>"
#: Strings that a text may not hold as they are.
CONTROLS = (START, END, "<|endoftext|>", "<s>", STOP, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ANY = "|".join("\\Q" + c + "\\E" for c in CONTROLS)
TAIL = "\n" + END + "\n"


def escape(text: Column) -> Column:
    """One more backslash before every control string and the backslashes that lead up to it."""
    return F.regexp_replace(text, rf"(\\*+(?:{_ANY}))", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*+(?:{_ANY}))", "$1")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, ord, role, text): the final messages of each conversation.

    events: conv_id, seq (whole numbers), kind, message_id, role, text. Kinds: 'message' and 'delta' (null counts as
    'message'): a message's text and further pieces of it; 'edit' replaces all that came before it in the
    message; 'regenerate' does so too, and drops the messages that began after this one and before the event.
    A null message_id stands for a message of its own. Messages stand in the order of their first events,
    equal places in the order of role and text. Null texts are empty, null roles too; events of an unknown
    kind are passed over. Each row counts, repeated ones as well; rows with a null conv_id are one conversation. An
    empty log gives no message; texts are folded whole; other columns are not read.
    The pieces of a message are aggregated before the conversation is put together; regenerations are looked up by a
    running maximum, so a long conversation costs no more for each of its rows.
    """
    e = events.select("conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "message_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    e = e.where(F.col("kind").isin("message", "delta", "edit", "regenerate"))
    whole = e.where("message_id is null").select("conv_id", F.col("seq").alias("first"), "role", "text", F.lit(None).cast(e.schema["seq"].dataType).alias("again"))
    parts = e.where("message_id is not null").groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("first"),
        F.min_by("role", "seq").alias("role"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", "text"))).alias("log"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.max(F.when(F.col("kind") != "delta", F.col("seq"))).alias("reset"),
    )
    parts = parts.select(
        "conv_id", "first", "role",
        F.array_join(F.transform(F.filter("log", lambda x: F.col("reset").isNull() | (x["seq"] >= F.col("reset"))), lambda x: x["text"]), "").alias("text"),
        "again",
    )
    every = whole.unionByName(parts)
    by = Window.partitionBy("conv_id")
    # a message is dropped if one that began before it was regenerated after it began
    before = by.orderBy("first").rangeBetween(Window.unboundedPreceding, -1)
    kept = every.withColumn("last", F.max("again").over(before)).where("last is null or last <= first")
    return kept.select("conv_id", F.row_number().over(by.orderBy("first", "role", "text")).cast("long").alias("ord"), "role", "text")


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, n_turns, formatted, loss): one text for each conversation and its loss mask.

    A turn is START, the role (percent-encoded), a line end, the escaped text and TAIL. loss: spans
    (start, length) in code points of the texts to learn from, without markers. A conversation without
    messages has no row.
    """
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    body = escape(F.col("text"))
    m = messages.select("conv_id", "ord", F.col("role").isin(*loss_roles).alias("learn"), head.alias("head"), body.alias("body"))
    m = m.select("*", F.concat("head", "body", F.lit(TAIL)).alias("piece"))
    by = Window.partitionBy("conv_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    m = m.select("*", (F.coalesce(F.sum(F.length("piece").cast("long")).over(by), F.lit(0)) + F.length("head")).alias("start"))
    turns = F.array_sort(F.collect_list(F.struct("ord", "piece", "learn", "start", F.length("body").cast("long").alias("length"))))
    g = m.groupBy("conv_id").agg(F.count("*").alias("n_turns"), turns.alias("turns"))
    return g.select(
        "conv_id", "n_turns",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    parts = F.split(formatted, "\\Q" + TAIL + "\\E", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(p: Column) -> Column:
        nl = F.instr(p, "\n")
        return F.struct(
            F.url_decode(F.substr(p, F.lit(len(START) + 1), nl - len(START) - 1)).alias("role"),
            unescape(F.substr(p, nl + 1)).alias("text"),
        )

    return F.transform(parts, turn)


def learned(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
