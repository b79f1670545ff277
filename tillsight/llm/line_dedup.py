"""Repeated multi-line chunks, cut where the content says so.

A text is split into lines; lines without a word are passed over.  A rolling hash over the hashes of ``WINDOW`` = 2 lines
runs down the text.  Chunks begin where it turns from a value found once in the corpus to one that occurs again, and end
where it turns back, so what stands before or after a passage shifts none of its boundaries, and a passage of two lines
is a chunk like one of fifty.  The windows inside the chunks are compared byte by byte, after their hashes have met; the
lines of all but the first occurrence, by (id, text, line), are removed, with the lines without words between them.

Boundaries by a residue of the hash, the customary choice, leave most passages of a few lines whole (README).

Defined results: a null text has no lines and stays null; a text with fewer than two lines that hold words loses nothing;
a document whose lines are all removed becomes an empty text; rows without id come first; repeated rows of one id and text
count as one document and are cut alike.  Other columns are carried along unread; one already called removed_spans is
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.llm.tables import let
from tillsight.session import stage, tune

WINDOW = 2

# Fixed value: a word, that is anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def windows(text: Column) -> Column:
    """array<struct<start, end, h>> of all two lines with words that follow each other; lines from 0, end excluded."""
    def of(lines: Column) -> Column:
        numbered = F.transform(lines, lambda line, i: F.struct(i.alias("i"), F.rlike(line, F.lit(WORD)).alias("word"), F.xxhash64(line).alias("h")))
        return let(F.filter(numbered, lambda x: x["word"]), pairs)

    def pairs(kept: Column) -> Column:
        return F.transform(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), lambda y, j: F.struct(
            F.get(kept, j)["i"].alias("start"), (y["i"] + 1).alias("end"), F.xxhash64(F.get(kept, j)["h"], y["h"]).alias("h")))

    return let(_lines(text), of)


def without(text: Column, spans: Column) -> Column:
    """The lines of ``text`` outside the spans, which are sorted and don't overlap."""
    def of(lines: Column) -> Column:
        gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"])).alias("a"),
                            F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(lines))).alias("b"))
        kept = F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"]))
        return F.array_join(F.flatten(kept), "\n")

    return F.when(F.size(spans) == 0, text).otherwise(let(_lines(text), of))


def united(windows: Column) -> Column:
    """Sorted windows as spans: those that share a line become one."""
    def of(w: Column) -> Column:
        opens = F.filter(w, lambda x, i: (i == 0) | (F.get(w, i - 1)["end"] <= x["start"]))
        closes = F.filter(w, lambda x, i: (i == F.size(w) - 1) | (F.get(w, i + 1)["start"] >= x["end"]))
        return F.arrays_zip(F.transform(opens, lambda x: x["start"]).alias("start"), F.transform(closes, lambda x: x["end"]).alias("end"))

    return let(windows, of)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and removed_spans (array of struct<start, end>, in lines)."""
    tune(docs.sparkSession)
    # Names a document in the joins: rows of one id with different texts differ.
    key = F.concat_ws(":", F.coalesce(docs[id_col].cast("string"), F.lit("-")), F.hex(F.xxhash64(docs[text_col])))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    found = stage(rows.select("key", F.explode(windows(F.col("text"))).alias("w")).select("key", "w.*"), "windows")
    again = stage(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "again")
    candidates = found.join(again, "h", "left_semi").groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("w"))

    # The text of each window is taken while a document's lines are at hand.
    def told(lines: Column) -> Column:
        return F.transform("w", lambda w: F.struct(
            w["start"].alias("start"), w["end"].alias("end"),
            F.concat_ws("\n", F.get(lines, w["start"]), F.get(lines, w["end"] - 1)).alias("two")))

    texts = rows.select("key", "id", "text").join(candidates, "key").select(
        "key", "id", F.explode(let(_lines(F.col("text")), told)).alias("t"))
    texts = stage(texts.select("key", "id", "t.*").distinct(), "candidates")
    # Grouping and joining by the lines themselves compares their bytes.
    firsts = stage(texts.groupBy("two").agg(F.count("*").alias("n"), F.min(F.struct("id", "key", "start")).alias("first"))
                   .filter("n > 1").select("two", "first"), "firsts")
    later = texts.join(firsts, "two").filter(
        ~((F.col("key") == F.col("first.key")) & (F.col("start") == F.col("first.start"))))
    cuts = later.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("w"))
    cuts = cuts.select("key", united(F.col("w")).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.coalesce("spans", none)
    kept = [F.col("row").getField(c).alias(c) if c != text_col else without(F.col("text"), spans).alias(c)
            for c in docs.columns if c != "removed_spans"]
    return rows.join(cuts, "key", "left").select(*kept, spans.alias("removed_spans"))
