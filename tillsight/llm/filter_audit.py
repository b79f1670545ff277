"""How five filters act together, in every order: what each removes, what it finds gone, and what only it finds.

Filters A and B need the number of words and of different words of each document: row sums and nonzero counts of the
sparse document-term matrix (``term_matrix``).  The remaining flags ride along with the matrix's rows.  Documents are
then counted by the set of filters that they fail - at most 32 sets for each source - and all orders follow from these
counts.  Copies are met by a digest of the text: rows shrink to one for each digest, source and label before they meet,
so a text in a third of all rows stays small.

Defined results: a null text is empty and fails A only (and E as a later copy); a null source is ''.  A row without id
has no smaller id: it never fails E, nor makes another row fail.  Repeated rows share one id, so neither fails E by the
other; each counts as a document.  Labels that contradict each other count if any is 1.  An empty table gives no row.
Columns other than doc_id, text and source are not read, so their names may clash.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillsight.llm import term_matrix

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_LATER = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that don't begin a character


def _attributes(batch: pa.RecordBatch, texts: list[bytes]) -> pa.Array:
    capitals = [100 * (len(t) - len(t.translate(None, _UPPER))) > 2 * len(t.translate(None, _LATER)) for t in texts]
    signs = [len(t.translate(None, _SIGNS)) < len(t) for t in texts]
    digest = [hashlib.sha256(t).digest() for t in texts]
    return pa.StructArray.from_arrays([batch.column(0), batch.column(1), pa.array(digest), pa.array(capitals), pa.array(signs)],
                                      names=["doc_id", "part", "digest", "c", "d"])


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, n_words, n_distinct, mask): bits 0 to 3 of ``mask`` for a failure of A to D."""
    used = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    kind = used.schema["doc_id"].dataType.simpleString()
    cut = term_matrix.shards(used, _attributes, f"doc_id: {kind}, part: string, digest: binary, c: boolean, d: boolean")
    numbers, _ = term_matrix.dictionary(cut)
    rows = term_matrix.row_figures(term_matrix.matrix(cut, numbers))
    fails = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"), F.col("c"), F.col("d")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", "digest", "n_words", "n_distinct", mask.alias("mask"))


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail, E as bit 4."""
    rows = failures(docs)
    marked = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows without id have no label; their keys are spread by digest.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none "), F.hex("digest")))
    rows = rows.withColumn("_key", key).join(marked.select(F.col("doc_id").cast("string").alias("_key"), "good", "toxic"),
                                             "_key", "left")
    by = ["digest", "part", "mask", "good", "toxic"]
    rows = rows.select("doc_id", "digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                       F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # Rows of one id first, so that the rows with the smallest id of a digest can be told from the later ones.
    ids = rows.groupBy(*by, "doc_id").agg(F.count("*").alias("n"))
    groups = ids.groupBy(*by).agg(F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("at_first"), F.sum("n").alias("n"),
                                  F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    texts = groups.groupBy("digest").agg(
        F.min("first").alias("first"),
        F.collect_list(F.struct("part", "mask", "good", "toxic", F.col("first").alias("own"), "at_first", "n", "no_id")).alias("g"))
    told = texts.select("first", F.explode("g").alias("g")).select("first", "g.*")
    kept = F.col("no_id") + F.when(F.col("own") == F.col("first"), F.col("at_first")).otherwise(0)
    split = told.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), kept.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - kept).alias("n")))).alias("s"))
    sums = [F.sum(F.col("s.n") * x).alias(name) for name, x in (("n", 1), ("good", F.col("good")), ("toxic", F.col("toxic")))]
    return split.groupBy("part", F.col("s.mask").alias("mask")).agg(*sums)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: (part, filter_order, step, filter, kept, removed, redundant, ...)."""
    counts = failure_sets(docs, labels)
    # A step is a filter and the set of those before it: 5 x 16 different ones, which the 120 orders share.
    steps: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in ORDERS:
        for k, name in enumerate(order):
            before = sum(1 << FILTERS.index(f) for f in order[:k])
            steps.setdefault((1 << FILTERS.index(name), before), []).append((order, k + 1))
    kinds = F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before")) for bit, before in sorted(steps)])
    cells = counts.select("part", "mask", "n", "good", "toxic", F.explode(kinds).alias("k")).select("part", "mask", "n", "good", "toxic", "k.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda c, x: F.coalesce(F.sum(F.when(c, x)), F.lit(0)).cast("long")
    n, here = F.col("n"), fails & ~gone
    # A document that fails s filters is removed by each of them in 120 / s orders.
    figures = cells.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone, n).alias("kept"), total(here, n).alias("removed"), total(fails & gone, n).alias("redundant"),
        total(F.col("mask") == F.col("bit"), n).alias("unique_fails"), total(here, F.col("good")).alias("good_lost"),
        total(here, F.col("toxic")).alias("toxic_lost"),
        total(fails, n * F.expr(f"{len(ORDERS)} div bit_count(mask)")).alias("shapley"))
    arms = [F.when((F.col("bit") == bit) & (F.col("before") == before),
                   F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step")) for o, k in places]))
            for (bit, before), places in sorted(steps.items())]
    listed = figures.withColumn("o", F.explode(F.coalesce(*arms)))
    return listed.select("part", "o.filter_order", "o.step", F.substring("o.filter_order", F.col("o.step"), F.lit(1)).alias("filter"),
                         "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
