"""Sparse document-term matrix in CSR shards over a global dictionary of words.

A task counts the words of its documents into shards: rows of local word numbers and counts.  Its shards share one list of
words, of bounded size, and each hands on the words that are new since the shard before.  The words of all lists are dealt
into buckets by hash and numbered inside each, equal words alike; prefix sums over the buckets' sizes make the numbers
global and gapless.  Words travel once for each list that holds them, not once for each document, and the numbers come
back in blocks, one for each bucket and list.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillsight.llm.offsets import part_offsets
from tillsight.llm.words import pieces, slices
from tillsight.session import scratch_path

# A shard ends once it holds so many entries; a list of words with so many words or entries of its shards.
SHARD, WORDS, ENTRIES = 1 << 18, 1 << 20, 1 << 22

# Words of one bucket of the dictionary, about; numbers of one block.
BUCKET, BLOCK = 250_000, 500_000

# The low bits of a list's number count the lists of one task.
LIST_BITS = 24

_MATRIX = "indptr array<long>, columns binary, counts binary"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _freed() -> None:
    """Give memory back at a task's end: workers live on, and others share the executor."""
    pa.default_memory_pool().release_unused()


class _List:
    """One list of words and the shard that is being filled."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.told = self.entries = 0
        self.start()

    def start(self) -> None:
        self.indptr, self.columns, self.counts = [0], [], []

    def add(self, text: bytes) -> None:
        number, found = self.words, Counter()
        for part in pieces(text):
            found.update(part.split())
        self.columns.append(np.array([number.setdefault(w, len(number)) for w in found], np.int32))
        self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.indptr.append(self.indptr[-1] + len(found))
        self.entries += len(found)

    def shard(self) -> list[pa.Array]:
        """(first, words, indptr, columns, counts) of the shard, and a new one begins."""
        one = lambda x: pa.array([x])
        out = [pa.array([self.told], pa.int32()), pa.array([list(islice(self.words, self.told, None))], pa.list_(pa.binary())),
               pa.array([self.indptr], pa.list_(pa.int64())), one(np.concatenate(self.columns).tobytes()),
               one(np.concatenate(self.counts).tobytes())]
        self.told = len(self.words)
        self.start()
        return out


def shards(docs: DataFrame, told: Callable[[pa.RecordBatch, list[bytes]], pa.StructArray], kind: str,
           text_col: str = "text") -> DataFrame:
    """Written and read again: (list, rows, first, words, indptr, columns, counts).

    ``told`` makes of a batch and its texts what ``rows`` holds for each document; ``kind`` is the DDL of its fields.
    ``columns`` are numbers of words in the list as int32, in any order within a row; ``words`` are those from ``first`` on.
    """
    out = f"list long, rows array<struct<{kind}>>, first int, words array<binary>, {_MATRIX}"
    docs_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, words, rows = TaskContext.get().partitionId() << LIST_BITS, _List(), []

        def close():
            held = pa.concat_arrays(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), *words.shard()],
                names=["list", "rows", "first", "words", "indptr", "columns", "counts"])

        for batch in batches:
            for some in slices(batch, 4 << 20):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in some.column(docs_at).cast(pa.large_binary())]
                known, at = told(some, texts), 0
                for i, text in enumerate(texts, 1):
                    words.add(text)
                    if words.indptr[-1] >= SHARD:
                        rows.append(known[at:i])
                        yield close()
                        rows, at = [], i
                        if len(words.words) >= WORDS or words.entries >= ENTRIES:
                            number, words = number + 1, _List()
                if at < len(texts):
                    rows.append(known[at:])
        if rows:
            yield close()
        _freed()

    return _written(docs.mapInArrow(run, out), "shards")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers for the words of one bucket, in blocks for each list of words."""
    bucket, number, told = TaskContext.get().partitionId(), {}, 0
    lists, places, numbers = [], [], []

    def blocks() -> pa.RecordBatch:
        nonlocal told, lists, places, numbers
        of, i, n = (np.concatenate(x) for x in (lists, places, numbers))
        order = np.argsort(of, kind="stable")
        of, i, n = of[order], i[order], n[order]
        cuts = np.flatnonzero(np.diff(of, prepend=of[0] - 1)).tolist()
        ends = cuts[1:] + [len(of)]
        # The new words ride with the first block.
        words = [list(islice(number, told, None))] + [[]] * (len(cuts) - 1)
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cuts), bucket, np.int32)), pa.array(of[cuts]),
             pa.array([i[a:b].tobytes() for a, b in zip(cuts, ends)]), pa.array([n[a:b].tobytes() for a, b in zip(cuts, ends)]),
             pa.array([told] + [0] * (len(cuts) - 1), pa.int32()), pa.array(words, pa.list_(pa.binary())),
             pa.array([len(words[0])] + [0] * (len(cuts) - 1), pa.int32())],
            names=["bucket", "list", "i", "n", "first", "words", "fresh"])
        told, lists, places, numbers = len(number), [], [], []
        return out

    for batch in batches:
        if not len(batch):
            continue
        lists.append(batch.column(0).to_numpy())
        places.append(batch.column(1).to_numpy())
        numbers.append(np.array([number.setdefault(w, len(number)) for w in batch.column(2).to_pylist()], np.int32))
        if sum(map(len, places)) >= BLOCK:
            yield blocks()
    if places:
        yield blocks()
    _freed()


def dictionary(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list, base, i, n): blocks of global ids ``base + n`` for words ``i`` of a list; (word, word_id): all words, ids 0, 1, ..."""
    words = cut.select("list", "first", F.posexplode("words").alias("at", "word"))
    total = cut.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    buckets = max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    dealt = words.select("list", (F.col("first") + F.col("at")).alias("i"), "word").repartition(buckets, "word")
    blocks = _written(dealt.mapInArrow(
        _numbered, "bucket int, list long, i binary, n binary, first int, words array<binary>, fresh int"), "dictionary")
    sizes = blocks.groupBy("bucket").agg(F.sum(F.col("fresh").cast("long")).alias("words"))
    # One row for each bucket.
    placed = blocks.join(F.broadcast(part_offsets(sizes, "bucket", "words", "base")), "bucket")
    all_words = placed.filter("fresh > 0").select((F.col("base") + F.col("first")).alias("_first"), F.posexplode("words").alias("_at", "word"))
    return placed.select("list", "base", "i", "n"), all_words.select("word", (F.col("_first") + F.col("_at")).alias("word_id"))


def matrix(cut: DataFrame, numbers: DataFrame) -> DataFrame:
    """(rows, indptr, columns, counts): the shards with global word ids (int64), in any order within a row.

    A list of words and its shards, all of bounded size, meet in one group.
    """
    schema = f"rows {cut.schema['rows'].dataType.simpleString()}, {_MATRIX}"

    def run(own: pa.Table, ids: pa.Table) -> pa.Table:
        blocks = [(b, np.frombuffer(i, np.int32), np.frombuffer(n, np.int32))
                  for b, i, n in zip(*(ids.column(c).to_pylist() for c in ("base", "i", "n")))]
        number = np.zeros(sum(len(i) for _, i, _ in blocks), np.int64)
        for base, i, n in blocks:
            number[i] = base + n.astype(np.int64)
        columns = [number[np.frombuffer(c, np.int32)].tobytes() for c in own.column("columns").to_pylist()]
        return pa.Table.from_arrays([own.column("rows"), own.column("indptr"), pa.array(columns, pa.binary()), own.column("counts")],
                                    names=["rows", "indptr", "columns", "counts"])

    return (cut.select("list", "rows", "indptr", "columns", "counts").groupBy("list")
            .cogroup(numbers.groupBy("list")).applyInArrow(run, schema))


def row_figures(csr: DataFrame) -> DataFrame:
    """One row per document: its attributes, ``n_words`` (row sum) and ``n_distinct`` (nonzero entries)."""
    kind = csr.schema["rows"].dataType.elementType
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + ", n_words long, n_distinct long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(len(batch))):
                get = dict(zip(one.schema.names, one.columns))
                indptr = get["indptr"].flatten().to_numpy()
                counts = np.frombuffer(get["counts"][0].as_buffer(), np.int32)
                sums = np.diff(np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[indptr])
                filled = np.diff(np.concatenate(([0], np.cumsum(counts != 0)))[indptr])
                yield pa.RecordBatch.from_arrays([*get["rows"].flatten().flatten(), pa.array(sums), pa.array(filled)],
                                                 names=[*(f.name for f in kind), "n_words", "n_distinct"])
        _freed()

    return csr.select("rows", "indptr", "counts").mapInArrow(run, schema)
