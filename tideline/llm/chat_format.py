"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions.

A template gives every role its header, whether its text is learned, and the roles that may follow. The
output is text with marks, and segments (text, loss) that concatenate to it. Inside texts the backslash and
the characters marks begin with are written as codes, so that no text can form a mark; ``unescaped``
reverses it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

START = ""


@dataclass(frozen=True)
class Template:
    before: str = "### "                 # begins a turn
    between: str = ": "                  # after the role
    after: str = "</turn>\n"             # ends a turn
    learned: tuple[str, ...] = ("assistant",)
    #: state (the last role) -> roles allowed next
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    ends: tuple[str, ...] = ("assistant",)
    #: character -> code behind a backslash. The backslash comes first; marks begin with coded characters.
    codes: tuple[tuple[str, str], ...] = (("\\", "b"), ("#", "h"), ("<", "l"), (":", "c"))


CHAT = Template()


def escaped(text: Column, template: Template = CHAT) -> Column:
    for character, code in template.codes:
        text = F.replace(text, F.lit(character), F.lit("\\" + code))
    return text


def unescaped(text: Column, template: Template = CHAT) -> Column:
    for character, code in reversed(template.codes):
        text = F.replace(text, F.lit("\\" + code), F.lit(character))
    return text


def formatted(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation: conv_id, segments array<struct<text, loss>>, formatted, valid.

    Turns are taken by turn number (nulls first), ties by role and text. A null text or role is empty. Rows
    with a null conv_id are one conversation. Conversations that the machine refuses are formatted all the
    same and marked ``valid`` = false. A conversation becomes one value, so it must fit one. Other columns
    are ignored; an empty table gives no rows."""
    held = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    moves = F.array(*[F.lit(f"{state}\n{role}") for state, roles in template.follows.items() for role in roles])
    refused = F.lit("\n")  # a state no move leaves
    state = F.aggregate("turns", F.lit(START), lambda s, t: F.when(
        F.array_contains(moves, F.concat(s, F.lit("\n"), t["role"])), t["role"]).otherwise(refused))
    part = lambda text, loss: F.struct(text.alias("text"), F.coalesce(loss, F.lit(False)).alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        part(F.concat(F.lit(template.before), escaped(t["role"], template), F.lit(template.between)), F.lit(False)),
        part(escaped(t["text"], template), t["role"].isin(*template.learned)),
        part(F.lit(template.after), F.lit(False)))))
    return (held.select("conv_id", segments.alias("segments"), state.isin(*template.ends).alias("valid"))
            .select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "valid"))


def read_back(formatted_rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id and turns array<struct<role, text>> parsed from ``formatted`` alone, and ``learned``: the
    unescaped texts of the segments with a loss."""
    ended = F.split("formatted", _literal(template.after))
    body = F.slice(ended, 1, F.size(ended) - 1)
    one = lambda x: F.substring(x, len(template.before) + 1, 2147483647)
    cut = lambda x: F.instr(x, template.between)
    role = lambda x: unescaped(F.substring(x, F.lit(1), cut(x) - 1), template)
    text = lambda x: unescaped(F.substring(x, cut(x) + len(template.between), F.lit(2147483647)), template)
    turns = F.transform(F.transform(body, one), lambda x: F.struct(role(x).alias("role"), text(x).alias("text")))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    return formatted_rows.select("conv_id", "formatted", "valid", turns.alias("turns"), learned.alias("learned"))


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def digests(formatted_rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid; all read back from the output."""
    rows = read_back(formatted_rows, template)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(whole, "utf-8"), 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(F.encode(learned, "utf-8"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")
