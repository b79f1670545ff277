"""Conversations as one text, proved by reading it back.

Grammar: a conversation is a row of turns ``### role: text</turn>\\n``.  Neither ``### `` nor ``</turn>`` may occur
inside a role or a text.  Reading a text turns ``\\t``, ``\\h`` and ``\\b`` back into ``</turn>``, ``### `` and a
backslash (in roles also ``\\c`` into a colon).

Every turn is rendered and read by the parser.  Where the turn read differs from the source, its conflicting content is
escaped and it is rendered again: first unescaped, then with the control strings escaped, then with every backslash
escaped too, which always reads back as it was.  The loss mask names the code points of the assistant's texts.

Defined results: null roles and texts are empty; turns are ordered by (turn, role, text), nulls first, so ties and
repeated rows have one order; rows without conversation id form one conversation; an empty table gives an empty
result.  Columns other than the four are not read.  A conversation is one row of the result, so it has to fit in one,
as a document has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.llm.tables import let
from tillsight.session import tune

# The control strings of the template and their escapes.
OPEN, CLOSE, COLON, END = "### ", "</turn>", ": ", "</turn>\n"
CONTROLS = ((CLOSE, "\\t"), (OPEN, "\\h"))
BACKSLASH = ("\\", "\\b")
ROLE_COLON = (":", "\\c")


def _replaced(text: Column, pairs) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column) -> Column:
    """Escaped as far as any text can need."""
    return _replaced(text, (BACKSLASH, *CONTROLS))


def unescape(text: Column) -> Column:
    return _replaced(text, [(b, a) for a, b in (*CONTROLS, BACKSLASH)])


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), _replaced(escape(role), (ROLE_COLON,)), F.lit(COLON), text, F.lit(END))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text, raw>> as the grammar reads it; null where it isn't grammatical."""
    def turn(piece: Column) -> Column:
        head = F.substring(piece, len(OPEN) + 1, 1 << 30)
        colon = F.instr(head, COLON)
        role = F.replace(F.substr(head, F.lit(1), colon - 1), F.lit(ROLE_COLON[1]), F.lit(ROLE_COLON[0]))
        raw = F.substr(head, colon + len(COLON))
        right = (F.startswith(piece, F.lit(OPEN)) & (colon > 0) & ~F.contains(head, F.lit(OPEN))
                 & ~F.contains(head, F.lit(CLOSE)))
        return F.when(right, F.struct(unescape(role).alias("role"), unescape(raw).alias("text"), raw.alias("raw")))

    def turns(pieces: Column) -> Column:
        read = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
        whole = (F.element_at(pieces, -1) == "") & ~F.exists(read, lambda t: t.isNull())
        return F.when(whole, read)

    return let(F.split(formatted, END), turns)


def _reads_back(role: Column, text: Column, escaped: Column) -> Column:
    read = let(read_turns(_rendered(role, escaped)), lambda t: F.when(
        F.size(t) == 1, (F.get(t, F.lit(0))["role"] == role) & (F.get(t, F.lit(0))["text"] == text)))
    return F.coalesce(read, F.lit(False))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns read back, loss_spans): spans are code points [start, end) of ``formatted``."""
    tune(turns.sparkSession)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    raw, controls, full = F.col("text"), _replaced(F.col("text"), CONTROLS), escape(F.col("text"))
    ladder = (F.when(_reads_back(F.col("role"), raw, raw), raw)
              .when(_reads_back(F.col("role"), raw, controls), controls).otherwise(full))
    rows = rows.withColumn("escaped", ladder)
    rows = rows.withColumn("piece", _rendered(F.col("role"), F.col("escaped"))).drop("escaped")
    upto = (Window.partitionBy("conv_id").orderBy("turn", "role", "text")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("upto", F.sum(F.char_length("piece")).over(upto)).withColumn("at", F.count("*").over(upto))
    pieces = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "upto", "piece", "role"))).alias("p"))
    # The text of a turn ends before the closing mark and begins after the colon.
    span = lambda t: F.struct(
        (t["upto"] - F.char_length(t["piece"]) + F.instr(t["piece"], COLON) + len(COLON) - 1).cast("long").alias("start"),
        (t["upto"] - len(END)).cast("long").alias("end"))
    said = F.transform(F.filter("p", lambda t: t["role"] == "assistant"), span)
    formatted = F.array_join(F.transform("p", lambda t: t["piece"]), "")
    out = pieces.select("conv_id", formatted.alias("formatted"), said.alias("loss_spans"))
    return out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), "loss_spans")
