"""Chat formatting with a grammar round trip, on built-in functions only.

    conversation := turn*
    turn         := "<s>[INST]" role "[/INST]" text "</s>"

A conversation is rendered as it is, read back by a parser that knows nothing but the
grammar, and compared with its turns. Where they differ, its content holds something that
reads like the grammar or like an escape; then it is rendered with such content escaped, read
back and compared again, and a difference now is an error.

What is escaped: ``<`` or ``[``, any number of backslashes, then ``s>``, ``/s>``, ``INST]`` or
``/INST]``. Escaping puts one backslash more after the bracket, reading back takes one away.
Neither makes or breaks a place of this form, and content without one stays as it is, so the
second round always succeeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values of the template
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LEARNED = "assistant"
_CONTROL = r"([<\[])(\\*+)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*+)(/?(?:s>|INST\]))"


def escape(content: Column) -> Column:
    return F.regexp_replace(content, _CONTROL, r"$1\\$2$3")


def unescape(content: Column) -> Column:
    return F.regexp_replace(content, _ESCAPED, r"$1$2$3")


def render(turns: Column, content=lambda c: c) -> Column:
    def turn(t):
        return F.concat(F.lit(OPEN), content(t["role"]), F.lit(MIDDLE), content(t["text"]), F.lit(CLOSE))

    return F.array_join(F.transform(turns, turn), "")


def segments(formatted: Column) -> Column:
    """The turns as they stand in a rendered conversation: array of (role, text), still
    escaped; null where a turn does not follow the grammar."""
    turns = F.split(formatted, CLOSE)
    # the last turn is closed too, so nothing follows the last mark
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def turn(t):
        at = F.locate(MIDDLE, t)
        role = F.substr(t, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        text = F.substr(t, at + len(MIDDLE))
        return F.when(
            t.startswith(OPEN) & (at > len(OPEN)), F.struct(role.alias("role"), text.alias("text"))
        )

    return F.transform(turns, turn)


def parse(formatted: Column) -> Column:
    """The turns a rendered conversation says: array of (role, text)."""
    return F.transform(
        segments(formatted),
        lambda s: F.when(
            s.isNotNull(),
            F.struct(unescape(s["role"]).alias("role"), unescape(s["text"]).alias("text")),
        ),
    )


def format_conversations(
    rows: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """(id_col, formatted, turns, mask) per conversation.

    Rows go by turn, then role, then text; null turns first; a repeated row is a turn of its
    own. Null roles and texts count as empty, null ids as one conversation. ``turns`` are read
    back from ``formatted``: (role, text, raw), ``raw`` as it stands there. ``mask`` cuts
    ``formatted`` into stretches: (chars, learned), learned only for assistants' texts. Other
    columns are not read. A conversation is one string, so its rows must meet in one task;
    nothing else does.
    """
    own = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    talks = rows.select(F.col(id_col).alias("_id"), own.alias("t"))
    talks = talks.groupBy("_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    talks = talks.select("_id", F.transform("t", lambda t: F.struct(t["role"], t["text"])).alias("source"))
    # each step is a column of its own, so that none is worked out twice
    plain = talks.select("*", render(F.col("source")).alias("plain"))
    plain = plain.select("*", parse(F.col("plain")).eqNullSafe(F.col("source")).alias("same"))
    done = plain.select(
        "_id",
        "source",
        F.when(F.col("same"), F.col("plain")).otherwise(render(F.col("source"), escape)).alias("formatted"),
    )
    done = done.select("*", segments(F.col("formatted")).alias("raw"))
    turns = F.transform(
        "raw",
        lambda s: F.struct(
            unescape(s["role"]).alias("role"),
            unescape(s["text"]).alias("text"),
            F.length(s["role"]).alias("role_chars"),
            s["text"].alias("raw"),
        ),
    )
    done = done.select("_id", "source", "formatted", turns.alias("turns"))
    recovered = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    checked = F.when(recovered.eqNullSafe(F.col("source")), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a rendered conversation does not read back as its turns"))
    )
    mask = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(
                    (F.lit(len(OPEN) + len(MIDDLE)) + t["role_chars"]).alias("chars"),
                    F.lit(False).alias("learned"),
                ),
                F.struct(F.length(t["raw"]).alias("chars"), (t["role"] == LEARNED).alias("learned")),
                F.struct(F.lit(len(CLOSE)).alias("chars"), F.lit(False).alias("learned")),
            ),
        )
    )
    return done.select(
        F.col("_id").alias(id_col),
        checked.alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["role"], t["text"], t["raw"])).alias("turns"),
        mask.alias("mask"),
    )


def digests(talks: DataFrame, id_col="conv_id") -> DataFrame:
    """Counts and digests of what ``format_conversations`` gave, read back from it."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = F.array_join(
        F.transform(F.filter("turns", lambda t: t["role"] == LEARNED), lambda t: t["text"]), ""
    )
    read = talks.select(id_col, "formatted", "turns", learned.alias("learned"))
    return read.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
