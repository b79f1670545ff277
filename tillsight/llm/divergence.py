"""How the sources of each language differ in their words, over all terms that three documents of the language share.

Iceberg prefix refinement.  A term can only be in ``least`` documents if every prefix of it is.  Prefixes are counted
level by level, at 8, 16, 32, ... bytes: a prefix, or a term that ends before the next level, counts only where the prefix
before it was kept, and what stays below ``least`` distinct documents goes with all that begins with it.  A task counts
its documents in dictionaries by language (a document counts once for each prefix, whatever its number of terms under
it), so rows shrink to one for each task, language and prefix before they are shuffled; totals by source travel with the
complete terms and are only unpacked for those that are kept.

Kept terms are dealt into blocks of bounded size.  A block meets the totals of its language's sources and compares all of
them on its terms in integer arithmetic; sums and the first terms of every block are then combined.

Defined results: null text, language and source are ''.  Each row is a document, also where rows repeat or have no id.
Every (language, source) that occurs is a group, with or without terms.  Ties go by the bytes of the item.  An empty
table gives no row.  Columns other than text, lang and source are not read, so their names may clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillsight.llm.words import pieces, slices
from tillsight.session import scratch_path, stage

# Bytes of the first prefix; each level doubles them: ``FIRST << k`` at level ``k``.
FIRST = 8

# A task hands on its counts once it holds so many entries.
HELD = 1_000_000

# Cells (terms times sources) of one block.
BLOCK = 1 << 19

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _level(size: int) -> int:
    """The level at which a term of ``size`` bytes is complete."""
    return max(0, (size - 1) // FIRST).bit_length()


class _Counts:
    """What a task has counted: documents by (language, term) and (language, prefix), occurrences by group and term."""

    def __init__(self):
        self.terms: dict[str, Counter] = {}
        self.prefixes: dict[str, Counter] = {}
        self.groups: dict[tuple[str, str], Counter] = {}

    def add(self, lang: str, source: str, text: bytes) -> None:
        found = self.groups.setdefault((lang, source), Counter())
        distinct: set[bytes] = set()
        for part in pieces(text):
            terms = _TERM.findall(part.lower())
            found.update(terms)
            distinct.update(terms)
        self.terms.setdefault(lang, Counter()).update(distinct)
        prefixes, size, longer = self.prefixes.setdefault(lang, Counter()), FIRST, distinct
        while longer := [t for t in longer if len(t) > size]:
            prefixes.update({t[:size] for t in longer})
            size *= 2

    def held(self) -> int:
        return sum(map(len, self.groups.values())) + sum(map(len, self.prefixes.values()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """All counts as rows: a term with its occurrences by source, a prefix without."""
        for lang, terms in self.terms.items():
            own = [(s, c) for (x, s), c in self.groups.items() if x == lang]
            number = dict(zip(terms, range(len(terms))))
            at = [np.fromiter(map(number.__getitem__, c), np.int32, len(c)) for _, c in own]
            order = np.argsort(np.concatenate(at), kind="stable")
            ends = np.cumsum(np.bincount(np.concatenate(at), minlength=len(terms)))
            source = np.repeat(np.arange(len(own), dtype=np.int32), [len(c) for _, c in own])[order]
            counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for _, c in own])[order]
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            names = pa.array([s for s, _ in own]).take(pa.array(source))
            yield from _rows(lang, terms, True, pa.ListArray.from_arrays(offsets, names),
                             pa.ListArray.from_arrays(offsets, counts))
            prefixes = self.prefixes[lang]
            none = np.zeros(len(prefixes) + 1, np.int32)
            yield from _rows(lang, prefixes, False, pa.ListArray.from_arrays(none, pa.array([], pa.string())),
                             pa.ListArray.from_arrays(none, pa.array([], pa.int64())))


def _rows(lang: str, counter: Counter, complete: bool, sources: pa.Array, counts: pa.Array) -> Iterator[pa.RecordBatch]:
    size = np.fromiter(map(len, counter), np.int64, len(counter))
    level = np.zeros(len(counter), np.int32)
    for k in range(_level(int(size.max(initial=1)))):
        level += size > FIRST << k
    rows = pa.RecordBatch.from_arrays(
        [pa.array([lang]).take(pa.array(np.zeros(len(counter), np.int8))), pa.array(level), pa.array(list(counter), pa.binary()),
         pa.array(np.full(len(counter), complete)), pa.array(np.fromiter(counter.values(), np.int64, len(counter))), sources, counts],
        names=["lang", "level", "item", "complete", "docs", "sources", "counts"])
    for at in range(0, len(rows), 20_000):
        yield rows.slice(at, 20_000)


def _counted(docs: DataFrame) -> DataFrame:
    """Written by level and read again: (level, lang, item, complete, docs, sources, counts), one row for each task and item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for some in slices(batch, 8 << 20):
                columns = [some.column(i).to_pylist() for i in (0, 1)]
                for lang, source, text in zip(*columns, some.column(2).cast(pa.large_binary())):
                    counts.add(lang, source, text.as_buffer().to_pybytes())
                if counts.held() > HELD:
                    yield from counts.batches()
                    counts = _Counts()
        yield from counts.batches()

    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    out = named.mapInArrow(run, "lang string, level int, item binary, complete boolean, docs long, "
                                "sources array<string>, counts array<long>")
    path = scratch_path(docs.sparkSession, "prefixes")
    out.write.partitionBy("level").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def kept_terms(counted: DataFrame, least: int = 3) -> DataFrame:
    """(lang, item): the terms in ``least`` documents of their language or more, by refinement of prefixes."""
    found, survivors, level = None, None, 0
    while True:
        rows = counted.filter(F.col("level") == level).select("lang", "item", "complete", "docs")
        if survivors is not None:
            parent = F.substring(rows["item"], 1, FIRST << (level - 1))
            rows = rows.join(survivors.hint("shuffle_hash"),
                             (rows["lang"] == survivors["_lang"]) & (parent == survivors["_prefix"]), "left_semi")
        enough = stage(rows.groupBy("lang", "item", "complete").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
                       .select("lang", "item", "complete"), "level")
        terms = enough.filter("complete").select("lang", "item")
        found = terms if found is None else found.unionByName(terms)
        survivors = enough.filter("NOT complete").select(F.col("lang").alias("_lang"), F.col("item").alias("_prefix"))
        if survivors.isEmpty():
            return found
        level += 1


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """floor(1000000000 * count / total), exact in 64 bits: long division by thousands."""
    out, rest = count // total, count % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out


def _compare(cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """One block: f summed over its terms for each two sources, and each source's first terms against the language."""
    if not len(cells):  # a block that no term fell into
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in zip(("lang", "source", "part", "item", "value"), "OOOOl")})
    groups = groups.sort_values("source", ignore_index=True)
    sources, terms = groups["source"].to_numpy(), np.unique(cells["item"].to_numpy())
    count = np.zeros((len(terms), len(sources)), np.int64)
    count[np.searchsorted(terms, cells["item"].to_numpy()), np.searchsorted(sources, cells["source"].to_numpy())] = cells["n"]
    kept = int(groups["v"].iloc[0])
    p = 1 + share(count + 1, groups["total"].to_numpy() + kept)
    whole = 1 + share(count.sum(axis=1) + 1, int(groups["lang_total"].iloc[0]) + kept)
    f = lambda a, b: (a - b) * (a - b) // b
    out, top, lang = [], int(groups["top"].iloc[0]), groups["lang"].iloc[0]
    for i, source in enumerate(sources):
        others = np.arange(len(sources)) != i
        out.append(pd.DataFrame({"source": source, "part": "pair", "item": sources[others],
                                 "value": f(p[:, i:i + 1], p[:, others]).sum(axis=0)}))
        above = np.flatnonzero((count[:, i] > 0) & (p[:, i] > whole))
        value = f(p[above, i], whole[above])
        first = np.argsort(-value, kind="stable")[:top]  # terms ascend, so ties do
        out.append(pd.DataFrame({"source": source, "part": "term", "item": terms[above[first]], "value": value[first]}))
    out = pd.concat(out, ignore_index=True)
    out.insert(0, "lang", lang)
    return out


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` compares with each other source, ``term`` with the language."""
    counted = _counted(docs)
    kept = stage(kept_terms(counted, least), "kept")
    whole = counted.filter("complete").select("lang", "item", "sources", "counts").join(kept.hint("shuffle_hash"), ["lang", "item"], "left_semi")
    cells = whole.select("lang", "item", F.explode(F.arrays_zip("sources", "counts")).alias("z"))
    cells = stage(cells.groupBy("lang", "item", F.col("z.sources").alias("source")).agg(F.sum("z.counts").alias("n"))
                  .withColumn("item", F.col("item").cast("string")), "cells")
    # Small tables: a row for each language, or for each of its sources.
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v"])
    by_lang = Window.partitionBy("lang")
    groups = stage(groups.withColumn("lang_total", F.sum("total").over(by_lang)).withColumn(
        "blocks", F.ceil(F.col("v") * F.count("*").over(by_lang) / BLOCK).cast("int")), "groups")
    blocks = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    dealt = cells.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    repeated = groups.filter("v > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = (dealt.select("lang", "block", "source", "item", "n").groupBy("lang", "block")
             .cogroup(repeated.select("lang", "block", "source", "total", "v", "lang_total", F.lit(top).alias("top"))
                      .groupBy("lang", "block"))
             .applyInPandas(_compare, "lang string, source string, part string, item string, value long"))
    found = stage(found, "compared")  # both parts read it
    # Blocks share no term, so each term has one row; languages without kept terms have their pairs at 0.
    none = groups.filter("v = 0").select("lang", "source")
    others = none.join(none.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    found = found.unionByName(others.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")))
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    # Apart, so that the limit on terms cuts each group before it is shuffled.
    pairs = summed.filter("part = 'pair'").withColumn("rank", F.row_number().over(order))
    terms = summed.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
