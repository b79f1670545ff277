"""Near copies by SimHash: 64-bit fingerprints, linked when few bits differ.

Pigeonhole blocks: a fingerprint is cut into ``max_bits + 2`` blocks.  Two fingerprints that differ in at most
``max_bits`` bits agree on two blocks at least, so every such pair meets under one of the block pairs.  Within such a
bucket the distances are compared in numpy, and one edge for each linked fingerprint, to the first one of its
cluster, goes on to the connected components: edges grow with the fingerprints, not with their pairs.

Defined results: a null or empty text, or one of white space, has fingerprint zero, which links like any other.  A
document without id gets the class of its text but never names it.  Repeated rows stay.  An empty table gives an empty
result.  Columns other than id and text are not read, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillsight.llm.components import components
from tillsight.session import stage, tune

BITS = 64


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Bitwise majority over the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()  # on bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:len(words) - width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:].tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text",
                 keep: Sequence[str] = ()) -> DataFrame:
    """(id_col, *keep, fingerprint): the 64 bits as a signed long, from the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                                  for t in batch.column(len(names)).cast(pa.large_binary())), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(prints.view(np.int64))],
                                             names=[*names, "fingerprint"])

    names = [id_col, *keep]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in names)
    return docs.select(*names, text_col).mapInArrow(run, f"{kinds}fingerprint long")


def _block_keys(print_col: Column, max_bits: int) -> Column:
    """One key for each pair of blocks: the number of the pair above the bits of both blocks."""
    count = max_bits + 2
    edges = [BITS * i // count for i in range(count + 1)]
    block = [F.shiftrightunsigned(print_col, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
             for a, b in zip(edges, edges[1:])]
    wide = -(-BITS // count)
    return F.array(*[
        F.lit(n << (2 * wide)).cast("long").bitwiseOR(F.shiftleft(block[i], wide)).bitwiseOR(block[j])
        for n, (i, j) in enumerate(combinations(range(count), 2))])


def bucket_edges(prints: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star edges (centre, member) that connect what is linked inside one bucket, without listing the pairs."""
    found = []
    left = prints
    while len(left) > 1:
        centre, left = left[0], left[1:]
        queue = [centre]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= max_bits
            if near.any():
                hits, left = left[near], left[~near]
                found.append((np.full(len(hits), centre), hits))
                queue.extend(hits)
    return found


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b) between distinct values of column ``fingerprint`` that connect all pairs within ``max_bits``."""
    keyed = (prints.select("fingerprint", F.explode(_block_keys(F.col("fingerprint"), max_bits)).alias("key"))
             .repartition("key").sortWithinPartitions("key", "fingerprint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(keys, values):
            cuts = np.flatnonzero(np.diff(keys)) + 1
            first, size = np.concatenate(([0], cuts)), np.diff(np.concatenate(([0], cuts, [len(keys)])))
            two = first[size == 2]
            two = two[np.bitwise_count(values[two] ^ values[two + 1]) <= max_bits] if len(two) else two
            found = [(values[two], values[two + 1])]
            for at, n in zip(first[size > 2], size[size > 2]):
                found += bucket_edges(values[at:at + n], max_bits)
            a, b = (np.concatenate(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            values = np.concatenate((values, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0  # the last bucket may go on
            if whole:
                yield edges(keys[:whole], values[:whole])
                keys, values = keys[whole:], values[whole:]
        if len(keys):
            yield edges(keys, values)

    return keyed.select("key", "fingerprint").mapInArrow(run, "a long, b long").distinct()


def _rooted(classes: DataFrame, max_bits: int) -> DataFrame:
    """The rows of ``classes``, one for each fingerprint, with the ``root`` fingerprint of their class; written once."""
    classes = stage(classes, "classes")
    roots = components(links(classes, max_bits))
    found = classes.join(roots, classes["fingerprint"] == roots["node"], "left")
    return stage(found.select(*classes.columns, F.coalesce("root", "fingerprint").alias("root")), "rooted")


def near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id): the smallest id that can be reached over links, for every row."""
    tune(docs.sparkSession)
    prints = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rooted = _rooted(prints.groupBy("fingerprint").agg(F.min(id_col).alias("first_id")), max_bits)
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents with one row left of each class of near copies: the smallest by ``doc_id`` and a hash of the text.

    Texts of one id that are unlike each other are classes of their own, so one row of each stays.  Rows without
    ``doc_id`` all stay.
    """
    tune(docs.sparkSession)
    named = docs.filter(F.col("doc_id").isNotNull())
    keyed = named.select("doc_id", "text", F.xxhash64("text").alias("_th"))
    prints = stage(fingerprints(keyed, shingle, keep=["_th"]), "fingerprints")
    first = F.min(F.struct("doc_id", "_th")).alias("first")
    rooted = _rooted(prints.groupBy("fingerprint").agg(first), max_bits)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    one = named.alias("d").join(kept, [F.col("d.doc_id") == kept["doc_id"], F.xxhash64("d.text") == kept["_th"]], "left_semi")
    # Repeated rows of one id and text.
    name = "_th"
    while name in docs.columns:
        name += "_"
    one = one.withColumn(name, F.xxhash64("text")).dropDuplicates(["doc_id", name])
    return one.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
