"""Chat formatting: a finite-state machine checks the order of turns, a declarative template emits text segments with loss flags.

DataFrame functions only. A conversation is one row of the result, so its turns meet in one group by conv_id.

Control strings inside texts and roles are escaped reversibly: a backslash is put between ``<`` and ``|`` wherever
only backslashes, or nothing, stand between the two; so no escaped text holds ``<|``, and the reader takes one away.

Defined results: null texts and roles count as empty strings, null conv_ids form one conversation, repeated turns all
stay (ordered by turn, role, text), an order that the machine rejects is formatted all the same with ``valid`` false
and ``bad_turn`` set, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import let


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the roles that are learnt, and the machine: (state, role, next state); ``accept`` are final states."""

    open: str = "<|turn|>"
    mid: str = "<|text|>"
    close: str = "<|end|>\n"
    learn: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"),
        ("start", "user", "asked"),
        ("ready", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    )
    accept: tuple[str, ...] = ("answered",)


DEFAULT = Template()
ERROR = "error"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def machine(roles: Column, t: Template = DEFAULT) -> Column:
    """struct(state, n, bad): the state after all roles and the number of the first turn without a move (null: none)."""
    moves = F.create_map(*[F.lit(x) for s, r, e in t.moves for x in (f"{s} {r}", e)])
    zero = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, role: Column) -> Column:
        after = F.coalesce(F.try_element_at(moves, F.concat_ws(" ", acc["state"], role)), F.lit(ERROR))
        bad = F.coalesce(acc["bad"], F.when(after == ERROR, acc["n"]))
        return F.struct(after.alias("state"), (acc["n"] + 1).alias("n"), bad.alias("bad"))

    return F.aggregate(roles, zero, step)


def format_chats(rows: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """``conv_id, segments array<struct<text, loss>>, formatted, valid, bad_turn`` from rows ``conv_id, turn, role, text``."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def emit(x: Column) -> Column:
        head = F.concat(F.lit(t.open), escape(x["role"]), F.lit(t.mid))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(x["text"]).alias("text"), x["role"].isin(*t.learn).alias("loss")),
                       F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))

    out = chats.select("conv_id", F.flatten(F.transform("turns", emit)).alias("segments"),
                       machine(F.transform("turns", lambda x: x["role"]), t).alias("m"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return out.select("conv_id", "segments", joined.alias("formatted"),
                      F.col("m.state").isin(*t.accept).alias("valid"), F.col("m.bad").alias("bad_turn"))


def read_turns(formatted: Column, t: Template = DEFAULT) -> Column:
    """array<struct<role, text>> read back from formatted text."""
    quoted = "\\Q" + t.open + "\\E"
    pieces = F.split(formatted, quoted)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, t.mid, 1)
        body = F.substr(p, F.length(head) + len(t.mid) + 1)
        return F.struct(unescape(head).alias("role"), unescape(F.substr(body, F.lit(1), F.length(body) - len(t.close))).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def learnt_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """The columns that the query returns, read back from ``formatted`` and ``segments``."""
    turns = read_turns(F.col("formatted"), t)
    told = let(turns, lambda a: F.struct(F.size(a).cast("long").alias("n"), F.sha2(F.array_join(F.transform(
        a, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("h")))
    read = chats.select("conv_id", "valid", "bad_turn", "formatted", told.alias("told"), learnt_text(F.col("segments")).alias("learnt"))
    return read.select("conv_id", F.col("told.n").alias("n_turns"), F.col("told.h").alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", "bad_turn")
