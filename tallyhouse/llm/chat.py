r"""Chat formatting by a finite-state machine over roles and a declarative template.

A turn becomes three segments: the opening with its role, the text, and the
closing. Inside texts and roles the first characters of all control strings
and the escape character are replaced by two-character codes (``\`` by
``\b``, ``<`` by ``\l``, ``#`` by ``\h``, and ``:`` by ``\c`` in roles), so a
control string cannot occur there and every text can be read back.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Template(NamedTuple):
    """How turns are marked, which roles may follow which, and whose texts carry the loss."""
    opens: str = "### "
    names: str = ": "
    closes: str = "</turn>\n"
    codes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
    role_codes: tuple[tuple[str, str], ...] = ((":", "\\c"),)
    trained: tuple[str, ...] = ("assistant",)
    start: str = ""
    follows: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)))
    final: tuple[str, ...] = ("assistant",)


def _coded(text: Column, codes: tuple[tuple[str, str], ...]) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _decoded(text: Column, codes: tuple[tuple[str, str], ...]) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def conversations_of(turns: DataFrame, buckets: int = 16) -> DataFrame:
    """``conv_id`` and ``turns``, the array of (turn, role, text) in order.

    Rows of one conversation meet in two steps, first dealt by a hash of the
    row, so that a conversation with very many rows is gathered by several
    tasks. Ties of ``turn`` are ordered by role and text; a null turn comes
    first; null roles and texts are empty.
    """
    rows = turns.select("conv_id", F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    parts = dealt.groupBy(F.struct("conv_id", "bucket").alias("part")).agg(F.collect_list("row").alias("rows"))
    return parts.groupBy("part.conv_id").agg(F.array_sort(F.flatten(F.collect_list("rows"))).alias("turns"))


def formatted(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id``, ``valid``, ``segments`` (text, loss) and ``formatted``.

    ``valid`` says whether the machine accepts the order of roles; other
    conversations are formatted as well. Rows that repeat are turns of their
    own; a null ``conv_id`` is one conversation; columns other than conv_id,
    turn, role and text are not looked at. An empty table gives no rows.
    """
    allowed = F.create_map(*(x for state, roles in template.follows
                             for x in (F.lit(state), F.array(*map(F.lit, roles)))))
    ends = F.aggregate(
        "turns", F.lit(template.start),
        lambda state, t: F.when(F.array_contains(F.element_at(allowed, state), t["role"]), t["role"]))
    of_turn = lambda t: F.array(
        F.struct(F.concat(F.lit(template.opens), _coded(t["role"], template.codes + template.role_codes),
                          F.lit(template.names)).alias("text"), F.lit(False).alias("loss")),
        F.struct(_coded(t["text"], template.codes).alias("text"),
                 t["role"].isin(*template.trained).alias("loss")),
        F.struct(F.lit(template.closes).alias("text"), F.lit(False).alias("loss")))
    made = conversations_of(turns).select(
        "conv_id", F.coalesce(ends.isin(*template.final), F.lit(False)).alias("valid"),
        F.flatten(F.transform("turns", of_turn)).alias("segments"))
    return made.withColumn("formatted", F.array_join("segments.text", ""))


def read_back(made: DataFrame, template: Template = Template()) -> DataFrame:
    """``made`` with ``turns`` (role, text) parsed from ``formatted`` and ``loss_text`` from the masked segments."""
    closed = F.split("formatted", rf"\Q{template.closes}\E", -1)
    start, gap = len(template.opens), len(template.names)
    role_codes = template.codes + template.role_codes

    def turn(piece: Column) -> Column:
        end = F.instr(piece, F.lit(template.names))
        return F.struct(
            _decoded(F.substring(piece, F.lit(start + 1), end - (start + 1)), role_codes).alias("role"),
            _decoded(F.substring(piece, end + gap, F.length(piece)), template.codes).alias("text"))

    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: _decoded(s["text"], template.codes)), "")
    return made.withColumns({
        "turns": F.transform(F.filter(closed, lambda piece: piece != ""), turn), "loss_text": loss})
