"""Packing: all documents in one row of tokens, cut into windows of a fixed width.

Concatenate and cut.  Each partition is tokenised once and written with the running count of its tokens; the totals of
the partitions give every partition's place in the whole (two levels of prefix sums, ``offsets.part_offsets``), and a
document's place is its partition's plus its own.  Window ``k`` holds the tokens from ``k * width`` on.  A document that
lies in several windows has one record for each: those after the first (``start > 0``) are the boundary records.  Only
the last window can be short, so padding is less than one window over the whole corpus.

A text is tokenised word by word: the tokenizer drops white space and no token spans it, so equal words have equal ids.
Closing signs behind an ASCII letter have tokens of their own and the tokenizer ignores case, so a bounded cache in each
worker keeps stems.  ``tests/llm/test_packing.py`` holds this against whole texts.

Defined results: a null or empty text is the end id alone.  Rows without id, repeated rows and rows of one id are packed
each for itself.  A text longer than a window is cut as often as needed; a long text is tokenised in parts that end at
white space.  An empty table gives no sequence.  Columns other than id and text are not read, so their names may clash.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillsight.llm.offsets import part_offsets
from tillsight.llm.words import pieces, slices
from tillsight.session import scratch_path

# Bytes of one id: little-endian, unsigned.
ID = 4

# Stems in a worker's cache, and their bytes, at the start of a batch at most.
CACHED, CACHED_BYTES = 600_000, 16 << 20

# Words that are encoded as one text.
ROW = 5_000

# Fixed value: signs that make tokens of their own behind an ASCII letter.
_TAIL = ".,;:!?"

_known: dict[str, _Words] = {}


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + size]``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]


class _Words:
    """The ids of texts, through a cache of stems: words in lower case without closing signs."""

    def __init__(self, path: str):
        # Spark's tasks are the parallel part.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Ids that end a word, and the id of a sign that parts words in a row.
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[ends] = True
        self.part = self._one("\0")
        self.clear()

    def clear(self) -> None:
        self.stems, self.ids = pa.array([""], pa.large_string()), np.zeros(0, "<u4")
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._one(t) for t in texts]
        return np.concatenate(found), np.array([len(x) for x in found])

    def _letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words of letters: the ids that end a word part them."""
        ids = self._one(" ".join(texts))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        # Every word has one end at least, so equal numbers mean one each.
        if len(cuts) != len(texts) or cuts[-1] != len(ids):
            return self._each(texts)
        return ids, np.diff(cuts, prepend=0)

    def _others(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words with signs: a sign that none of them holds parts them."""
        if len(self.part) != 1 or any("\0" in t for t in texts):
            return self._each(texts)
        ids = self._one(" \0 ".join([*texts, ""]))
        cuts = np.flatnonzero(ids == self.part[0])
        if len(cuts) != len(texts) or cuts[-1] != len(ids) - 1:
            return self._each(texts)
        return np.delete(ids, cuts), np.diff(cuts, prepend=-1) - 1

    def _add(self, stems: pa.Array) -> None:
        letters = pc.utf8_is_alpha(stems)
        for some, encode in ((stems.filter(letters), self._letters), (stems.filter(pc.invert(letters)), self._others)):
            for at in range(0, len(some), ROW):
                ids, sizes = encode(some[at:at + ROW].to_pylist())
                self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
                self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)
            self.stems = pa.concat_arrays([self.stems, some])

    def _places(self, stems: pa.Array) -> np.ndarray:
        """Places of different stems in the cache; new ones are encoded together."""
        at = pc.index_in(stems, value_set=self.stems)
        if at.null_count:
            self._add(stems.filter(pc.is_null(at)))
            at = pc.index_in(stems, value_set=self.stems)
        return at.to_numpy()

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end`` behind it, and their offsets."""
        if len(self.stems) > CACHED or self.stems.nbytes > CACHED_BYTES:
            self.clear()
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        different = words.dictionary
        # Case goes before accents are joined only where there are none, and not in the names of special tokens.
        plain = pc.and_(pc.string_is_ascii(different), pc.invert(pc.match_substring(different, "<")))
        closed = pc.match_substring_regex(different, f"[A-Za-z][{_TAIL}]+$")
        bare = pc.if_else(closed, pc.utf8_rtrim(different, _TAIL), different)
        signs = pc.if_else(closed, pc.replace_substring_regex(different, f"^.*[^{_TAIL}]", ""), "")
        bare = pc.if_else(plain, pc.ascii_lower(bare), bare).dictionary_encode()
        signs = signs.dictionary_encode()
        # Stem and closing signs of each word, then the words of all texts, then the ends.
        stem = self._places(bare.dictionary)[bare.indices.to_numpy()]
        sign = self._places(signs.dictionary)[signs.indices.to_numpy()]
        both = np.stack([stem, sign], axis=1).ravel()
        own = np.append(_gather(self.ids, self.starts[both], self.sizes[both]), np.uint32(end))
        sizes = self.sizes[stem] + self.sizes[sign]
        starts, sizes = np.append(np.cumsum(sizes) - sizes, len(own) - 1), np.append(sizes, 1)
        cuts = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        order = np.insert(words.indices.to_numpy().astype(np.int64), cuts, len(different))
        ends = np.cumsum(sizes[order])[cuts + np.arange(len(cuts))]
        return _gather(own, starts[order], sizes[order]), np.concatenate(([0], ends))


def _words(path: str) -> _Words:
    """One for each worker and file: Spark's workers live on from task to task."""
    if path not in _known:
        _known[path] = _Words(path)
    return _known[path]


def _long(encode: _Words, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Long texts in parts, so that the numbers of one part only are held beside the ids."""
    ids, offsets = [], [0]
    for text in texts.cast(pa.large_binary()):
        parts = [encode(pa.array([p.decode("utf-8", "replace")], pa.large_string()), end)[0][:-1]
                 for p in pieces(text.as_buffer().to_pybytes(), 4 << 20)]
        ids.append(np.concatenate([*parts, np.array([end], "<u4")]))
        offsets.append(offsets[-1] + len(ids[-1]))
    return np.concatenate(ids), np.array(offsets)


def tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written and read again: (part, before, id_col, doc_tokens, ids), where ``before`` counts the partition's earlier tokens.

    ``tokenizer`` names a file of the ``tokenizers`` library that ignores case, drops white space, and whose tokens span
    neither ASCII white space nor the border between a letter and signs; it must be there on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = _words(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, 8 << 20):
                texts = some.column(1).cast(pa.large_string()).fill_null("")
                if texts.nbytes <= 16 << 20:
                    ids, offsets = encode(texts, end_id)
                else:
                    ids, offsets = _long(encode, texts, end_id)
                sizes, ends = np.diff(offsets), before + offsets[1:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), part, np.int32)), pa.array(ends - sizes), some.column(0), pa.array(sizes),
                     pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(offsets * ID), pa.py_buffer(ids)])
                     .cast(pa.binary())], names=["part", "before", id_col, "doc_tokens", "ids"])
                before = int(ends[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(
        run, f"part int, before long, `{id_col}` {kind}, doc_tokens long, ids binary")
    # The upper bytes of ids are zero, which this codec makes the most of.
    path = scratch_path(docs.sparkSession, "tokens")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def pack(docs: DataFrame, tokenizer: str, end_id: int, width: int = 4096, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: (id_col, start, length, doc_tokens, sequence_id, offset, ids).

    ``start`` counts the document's tokens before the piece, ``offset`` the sequence's; ``ids`` holds the piece's ids,
    four bytes each.
    """
    rows = tokens(docs, tokenizer, end_id, id_col, text_col)
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row for each partition of the scan.
    placed = rows.join(F.broadcast(part_offsets(totals, "part", "total", "base")), "part")
    placed = placed.select(id_col, "doc_tokens", "ids", (F.col("base") + F.col("before")).alias("a"),
                           (F.col("base") + F.col("before") + F.col("doc_tokens")).alias("b"))

    def piece(k):
        low, high = F.greatest(F.col("a"), k * width), F.least(F.col("b"), (k + 1) * width)
        own = F.substring("ids", (ID * (low - F.col("a")) + 1).cast("int"), (ID * (high - low)).cast("int"))
        return F.struct((low - F.col("a")).alias("start"), (high - low).alias("length"), k.alias("sequence_id"),
                        (low - k * width).alias("offset"), own.alias("ids"))

    windows = F.sequence(F.expr(f"a div {width}"), F.expr(f"(b - 1) div {width}"))
    cut = placed.select(id_col, "doc_tokens", F.explode(F.transform(windows, piece)).alias("p"))
    return cut.select(id_col, "p.start", "p.length", "doc_tokens", "p.sequence_id", "p.offset", "p.ids")


def sequences(packed: DataFrame, width: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, n_tokens, padded_tokens, ids, documents): the sequences themselves, with the documents inside.

    A sequence is padded to ``width``, except where its length is a power of two.  Groups hold ``width`` ids at most.
    """
    part = F.struct("offset", "length", "start", F.col(id_col).alias("id"), "ids")
    told = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum("length").alias("n_tokens"))
    power = F.bit_count("n_tokens") == 1
    return told.select(
        "sequence_id", "n_tokens", F.when(power, F.col("n_tokens")).otherwise(width).alias("padded_tokens"),
        F.aggregate("parts", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["length"].alias("length"),
                                                p["start"].alias("start"), p["id"].alias(id_col))).alias("documents"))
