"""Chat formatting: a declarative template, a role machine and loss segments.

A template lists, per role, the marker before and after a turn's text and
whether the text counts for the loss. A finite-state machine over the roles
checks the turn order. Control strings inside a text are escaped (backslash
doubled, ``\\-`` put after a control string's first character), so no marker can
be forged and the output reads back to the turns exactly. All of it is
DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``roles``: (role, before, after, loss). ``other``: the markers around the
    role name and the text of a role not listed. ``moves``: (state, role, state);
    a conversation is valid when it ends in one of ``final``."""

    roles: tuple[tuple[str, str, str, bool], ...]
    other: tuple[str, str, str]
    moves: tuple[tuple[str, str, str], ...]
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> list[str]:
        return sorted({m for _, a, b, _ in self.roles for m in (a, b)} | set(self.other))


INSTRUCT = ChatTemplate(
    roles=(("system", "<<SYS>>", "<</SYS>>", False),
           ("user", "[INST]", "[/INST]", False),
           ("assistant", "<s>", "</s>", True)),
    other=("[ROLE]", "[TEXT]", "[/TEXT]"),
    moves=(("start", "system", "system"), ("start", "user", "user"), ("system", "user", "user"),
           ("user", "assistant", "assistant"), ("assistant", "user", "user")))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def _any(controls: list[str]) -> str:
    return "(" + "|".join(_literal(c) for c in sorted(controls, key=len, reverse=True)) + ")"


def escape(text: Column, template: ChatTemplate) -> Column:
    pairs = "|".join(f"(?<={_literal(c[0])})(?={_literal(c[1:])})" for c in template.controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), pairs, r"\\-")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|-)", "$1")


def format_conversations(rows: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """``(conv_id, turn, role, text)`` -> one row per conversation: ``conv_id``,
    ``valid`` (turn order accepted by the machine), ``segments``
    (array of text and loss) and ``formatted`` (their concatenation).

    Turns are ordered by turn, NULL last, ties by role and text; repeated rows
    are turns of their own. A NULL text or role is empty; a NULL conv_id is one
    conversation. A conversation out of order is formatted all the same, with
    ``valid`` false. An empty table gives an empty result; other columns are
    ignored. A conversation is one output row, so its turns meet in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = (rows.select("conv_id", F.struct(F.col("turn").isNull().alias("late"), "turn",
                                             role.alias("role"), text.alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    moves = F.create_map(*[F.lit(x) for s, r, to in template.moves for x in (f"{s}>{r}", to)])
    state = F.aggregate("turns", F.lit(template.start), lambda s, t: F.coalesce(
        F.try_element_at(moves, F.concat(s, F.lit(">"), t["role"])), F.lit("")))

    def segment(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    def of_turn(t: Column) -> Column:
        body = escape(t["text"], template)
        named, mark, end = template.other
        out = F.array(segment(F.lit(named), False), segment(escape(t["role"], template), False),
                      segment(F.lit(mark), False), segment(body, False),
                      segment(F.lit(end), False))
        for name, before, after, loss in template.roles:
            out = F.when(t["role"] == name, F.array(
                segment(F.lit(before), False), segment(body, loss),
                segment(F.lit(after), False))).otherwise(out)
        return out

    segments = F.flatten(F.transform("turns", of_turn))
    return (turns.select("conv_id", state.isin(*template.final).alias("valid"),
                         segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_back(formatted: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """Adds ``turns`` (role, text), parsed from ``formatted`` alone, and ``loss_text``,
    the unescaped text of the segments under the loss mask."""
    marker = _any(template.controls)
    marks = F.regexp_extract_all("formatted", F.lit(marker), 1)
    pieces = F.split("formatted", marker, -1)
    named, mark, _ = template.other
    opening = {before: role for role, before, _, _ in template.roles}
    role_of = F.create_map(*[F.lit(x) for pair in opening.items() for x in pair])
    found = F.transform(
        F.arrays_zip(F.col("_marks").alias("m"),
                     F.slice("_pieces", F.lit(1), F.size("_marks")).alias("before"),
                     F.slice("_pieces", F.lit(2), F.size("_marks")).alias("after")),
        lambda x: F.when(x["m"].isin(mark, *opening), F.struct(
            F.coalesce(F.try_element_at(role_of, x["m"]), unescape(x["before"])).alias("role"),
            unescape(x["after"]).alias("text"))))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return (formatted.withColumns({"_marks": marks, "_pieces": pieces})
            .withColumns({"turns": F.filter(found, lambda t: t.isNotNull()),
                          "loss_text": F.array_join(loss, "")})
            .drop("_marks", "_pieces"))


def chat_digest(rows: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """Per conversation, read back from the output: conv_id, valid, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(format_conversations(rows, template), template).select(
        "conv_id", "valid", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    text, '\', '\\'), '<<SYS>>', '<\-<SYS>>'), '<</SYS>>', '<\-</SYS>>'), '[INST]', '[\-INST]'),
    '[/INST]', '[\-/INST]'), '<s>', '<\-s>'), '</s>', '<\-/s>'), '[ROLE]', '[\-ROLE]'),
    '[TEXT]', '[\-TEXT]'), '[/TEXT]', '[\-/TEXT]'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 END AS n
  FROM c)
SELECT conv_id,
       regexp_full_match(string_agg(role, '>' ORDER BY turn),
                         '(system>)?user>assistant(>user>assistant)*') AS valid,
       count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
