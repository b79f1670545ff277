"""Benchmark passages inside documents, found by edit distance on words.

An item matches a document where some window of as many words as the item has is at most ``EDITS`` (a share of the
item's words, rounded down) word edits away from it.  At the end of a text the window may be shorter.

1. Count filter, which loses nothing: k edits spoil at most 2 k of an item's p word pairs (those of a word with itself
   left out), so a window that holds fewer than p - 2 k word pairs of items of its size is passed over.  The pairs of all
   items are kept in a table with 16 places for each, within bounds (``slots``); false hits only let more windows through.
2. CGK embedding: a random walk copies words of the window, moving on or staying by a random bit of step and word, so a
   small edit distance becomes a small Hamming distance.  Several times, some steps of a fresh walk are sampled and
   hashed to a key: the share of steps that differ grows with the item, so longer items have fewer steps in a key
   (``sampled``) and more walks (``repeats``); windows and items that share a key meet in a join.  Windows whose keys no
   item has are dropped beforehand by a second table of that size.
3. Every pair that met is verified by the exact edit distance of its words.

At the largest distance allowed, the share of matches that meets a key is above 0.95 (tests measure it on items of 10 to
800 words); it rises to practically 1 for fewer edits, and is 1 for verbatim passages, which take the same path.

Items of ``SHORTEST`` to ``LEAST`` - 1 words match verbatim only: an edit in so few words is another sentence.  Their key is
a hash of the whole window, and they join and are verified like the others.

Defined results: words are runs of letters, digits and non-ASCII characters in lower case; null and empty texts and items
match nothing, and neither do items of fewer than ``SHORTEST`` words, which chance produces; repeated items match each;
repeated rows of a document are reported once; other columns are not read, so they may clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillsight.llm.words import mix, slices, text_bytes
from tillsight.session import stage, tune

EDITS = 0.2
LEAST = 8
SHORTEST = 4
REPEATS = 40
SAMPLED = 4
WALKS = 1 << 22  # walks that a task takes at once, about
SLOTS = 1 << 20, 1 << 24  # least and most places of the filters

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_RUN = re.compile(rb"[0-9a-z\x80-\xff]+")
_POWERS, _PAIR, _STEP = mix(64, 5), mix(2, 6), mix(4096, 7)
_PAD = np.uint64(0)


def _scrambled(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _PAIR[0]
        return (x ^ (x >> np.uint64(29))) * _PAIR[1]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of each word, and for each text the number of its first word (one more at the end)."""
    inside = _WORD[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[firsts], closes[firsts[1:] - 1] = inside[firsts], inside[firsts[1:] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum()) - np.repeat(before, lengths)
    with np.errstate(over="ignore"):
        chars = data[at + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
        hashes = np.add.reduceat(chars * _POWERS[at & 63], before) ^ (lengths.astype(np.uint64) << np.uint64(40))
    return _scrambled(hashes) | np.uint64(1), starts, ends, first


def size_class(n: int) -> np.uint64:
    """Sizes in 64 classes; two sizes in one class only make the count filter let more through."""
    return np.uint64(n % 64)


def pair_slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Place of each word pair; 0, which stands for none, where a word follows itself."""
    with np.errstate(over="ignore"):
        mixed = _scrambled(hashes[:-1] * _PAIR[0] + hashes[1:])
    places = (mixed >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)
    return np.where(hashes[:-1] == hashes[1:], 0, np.maximum(places, 1))


def edits(n: int) -> int:
    return int(EDITS * n + 1e-9) if n >= LEAST else 0


def exact_keys(hashes: np.ndarray, n: int) -> np.ndarray:
    """Key of the ``n`` words from each word on."""
    count = max(0, len(hashes) - n + 1)
    keys = np.full(count, np.uint64(n))
    with np.errstate(over="ignore"):
        for k in range(n):
            keys = _scrambled(keys * _PAIR[1] + hashes[k:k + count])
    return keys


def repeats(n: int) -> int:
    """Walks over an item of ``n`` words."""
    return min(max(REPEATS, n // 4), len(_STEP))


def sampled(n: int) -> int:
    """Steps of a walk over ``n`` words that make up a key."""
    return SAMPLED if n <= 48 else 3 if n <= 72 else 2


@cache
def sampled_steps(n: int) -> np.ndarray:
    """For each repeat which steps of a walk over ``n`` words make up the key: ``sampled`` of the first 2 n."""
    out = np.zeros((repeats(n), 2 * n), bool)
    for repeat in range(len(out)):
        out[repeat, np.argsort(mix(2 * n, 1000 + 64 * n + repeat), kind="stable")[:sampled(n)]] = True
    return out


def walk_keys(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Keys of the windows [start, end) of ``hashes``: one row for each of the random walks."""
    steps = sampled_steps(n)
    walks = np.arange(len(steps))
    at = np.tile(starts, (len(steps), 1))
    with np.errstate(over="ignore"):
        keys = np.repeat(_STEP[walks] * np.full(len(steps), n, np.uint64), len(starts)).reshape(len(steps), -1)
        for j in range(int(np.flatnonzero(steps.any(axis=0))[-1]) + 1):
            if j % 64 == 0:
                bits = _scrambled(hashes * _STEP[(walks * 67 + 131 * (j // 64)) % len(_STEP), None])
            inside = at < ends
            safe = np.where(inside, at, starts)
            taken = steps[:, j]
            if taken.any():
                word = np.where(inside[taken], hashes[safe[taken]], _PAD)
                keys[taken] = _scrambled(keys[taken] * _PAIR[1] + word)
            move = (np.take_along_axis(bits, safe, axis=1) >> np.uint64(j % 64)) & np.uint64(1)
            at += inside & (move == 1)
    return keys


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places that windows cover, and the windows' starts and ends counted among them."""
    places = np.unique(np.minimum(starts[:, None] + np.arange(n), ends[:, None] - 1))
    return places, np.searchsorted(places, starts), np.searchsorted(places, ends - 1) + 1


class Filters:
    """What tasks need of the benchmark: word pairs by size class, the sizes, and which keys occur; of bounded size."""

    def __init__(self, pairs: np.ndarray, sizes: dict[int, int], keys: np.ndarray):
        """``sizes``: the pairs that a window of each size needs."""
        self.pairs, self.keys = pairs, keys
        self.sizes = {n: need for n, need in sizes.items() if n >= LEAST}
        self.short = [n for n in sizes if n < LEAST]

    def exact(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, keys) of the windows of short items' sizes whose key occurs."""
        text_end = np.repeat(first[1:], np.diff(first))
        for n in self.short:
            keys = exact_keys(hashes, n)
            whole = np.arange(len(keys)) + n <= text_end[:len(keys)]
            at = np.flatnonzero(whole & self.hits(keys))
            if len(at):
                yield n, at, keys[at]

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, ends) of the windows that pass the count filter."""
        if len(hashes) < 2 or not self.sizes:
            return
        mask = np.append(self.pairs[pair_slots(hashes, len(self.pairs))], np.uint64(0))
        lasts = first[1:][first[1:] > first[:-1]] - 1
        mask[lasts] = 0  # a pair never runs over the end of a text
        # Some stretch of g pairs inside a passing window has at least this many hits.
        g = min(self.sizes) - 1
        least = min(max(-(-need // -(-(n - 1) // g)), need - (n - 1 - g)) for n, need in self.sizes.items())
        upto = np.concatenate(([0], np.cumsum(mask != 0)))
        dense = np.flatnonzero(upto[np.minimum(np.arange(len(mask)) + g, len(mask))] - upto[:-1] >= least)
        if not len(dense):
            return
        text_end = np.repeat(first[1:], np.diff(first))
        reach = max(self.sizes)
        # Only around such stretches windows are looked at.
        edge = np.zeros(len(mask) + 1, np.int64)
        np.add.at(edge, np.maximum(dense - reach, 0), 1)
        np.add.at(edge, np.minimum(dense + max(g, reach), len(mask)), -1)
        near = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        # From here on only those places count; windows are runs of them, as whole stretches are kept.
        for n, need in self.sizes.items():
            hits = np.concatenate(([0], np.cumsum((mask[near] >> size_class(n)) & np.uint64(1), dtype=np.int64)))
            ends = np.minimum(near + n, text_end[near])
            # Pairs of the window that lie in the stretch: the last pair begins one word before its end.
            inside = hits[np.searchsorted(near, np.maximum(ends - 1, near))] - hits[:-1]
            good = (inside >= need) & (ends - near >= n - edits(n))
            lo, hi, block = near[good], ends[good], max(1, WALKS // repeats(n))
            for at in range(0, len(lo), block):
                yield n, lo[at:at + block], hi[at:at + block]

    def hits(self, keys: np.ndarray) -> np.ndarray:
        return self.keys[(keys >> np.uint64(64 - len(self.keys).bit_length() + 1)).astype(np.int64)]


def distances(pairs: list[tuple[list[bytes], list[bytes]]]) -> np.ndarray:
    """Edit distances of pairs of word lists, row by row of the usual table for all pairs at once."""
    number: dict[bytes, int] = {}
    longest = [max((len(p[i]) for p in pairs), default=0) for i in (0, 1)]
    a, b = (np.full((len(pairs), longest[i]), -1 - i, np.int64) for i in (0, 1))
    for row, p in enumerate(pairs):
        for table, side in ((a, p[0]), (b, p[1])):
            table[row, :len(side)] = [number.setdefault(w, len(number)) for w in side]
    la, lb = (np.array([len(p[i]) for p in pairs], np.int64) for i in (0, 1))
    ramp = np.arange(longest[1] + 1)
    row = np.broadcast_to(ramp, (len(pairs), longest[1] + 1)).copy()
    out = np.where(la == 0, lb, 0)
    for i in range(longest[0]):
        now = np.empty_like(row)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (a[:, i:i + 1] != b))
        row = np.minimum.accumulate(now - ramp, axis=1) + ramp
        done = la == i + 1
        out[done] = row[done, lb[done]]
    return out


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, 2 << 20):
            data, offsets = text_bytes(part.column(column))
            yield (part, data, *words(data, offsets))


def slots(items: DataFrame) -> int:
    """Places of the filters: 16 for each word or key of the items, within ``SLOTS``; a power of two."""
    n = F.size(F.split("text", " "))
    found = items.agg(F.sum(n.cast("long")).alias("w"), F.sum(F.greatest(F.lit(REPEATS), n / 4)).cast("long").alias("k")).first()
    wanted = 16 * max(found["w"] or 0, found["k"] or 0, 1)
    return min(max(SLOTS[0], 1 << (wanted - 1).bit_length()), SLOTS[1])


def _item_rows(items: DataFrame, places: int) -> DataFrame:
    """(item, words, n, places, keys) of every item that is long enough; its keys as windows of its size have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, hashes, starts, ends, first in _batches(batches, 1):
            out = {"item": [], "words": [], "n": [], "places": [], "keys": []}
            for i in range(len(part)):
                a, b = first[i], first[i + 1]
                n = int(b - a)
                if n < SHORTEST:
                    continue
                lo, hi = np.array([0]), np.array([n])
                out["item"].append(part.column(0)[i].as_py())
                out["words"].append(b" ".join(_RUN.findall(data[starts[a]:ends[b - 1]].tobytes())).decode())
                out["n"].append(n)
                out["places"].append([p for p in pair_slots(hashes[a:b], places).tolist() if p] if n >= LEAST else [])
                keys = walk_keys(hashes[a:b], lo, hi, n)[:, 0] if n >= LEAST else exact_keys(hashes[a:b], n)
                out["keys"].append(keys.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([
                pa.array(out["item"], part.schema.field(0).type), pa.array(out["words"], pa.string()),
                pa.array(out["n"], pa.int32()), pa.array(out["places"], pa.list_(pa.int64())),
                pa.array(out["keys"], pa.list_(pa.int64()))], names=list(out))

    kind = items.schema["item"].dataType.simpleString()
    return items.mapInArrow(run, f"item {kind}, words string, n int, places array<long>, keys array<long>")


def _filters(items: DataFrame, places: int) -> Filters:
    """Both tables, at most ``places`` rows each on the driver."""
    by_class = F.expr("shiftleft(1L, n % 64)")
    pairs, keys = np.zeros(places, np.uint64), np.zeros(places, bool)
    found = items.select(F.explode("places").alias("place"), by_class.alias("mask")).groupBy("place").agg(
        F.bit_or("mask").alias("mask")).toPandas()
    pairs[found["place"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    place = F.shiftrightunsigned("key", 64 - places.bit_length() + 1).alias("place")
    seen = items.select(F.explode("keys").alias("key")).select(place).distinct().toPandas()
    keys[seen["place"].to_numpy(np.int64)] = True
    sizes = {r["n"]: max(1, r["p"] - 2 * edits(r["n"])) for r in
             items.groupBy("n").agg(F.min(F.size("places")).alias("p")).orderBy("n").collect()}
    return Filters(pairs, sizes, keys)


def document_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a document with its text: rows of one id with different texts differ."""
    return F.concat_ws(":", F.coalesce(docs[id_col].cast("string"), F.lit("-")), F.hex(F.xxhash64(docs[text_col])))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(key, id_col, item_col, n_words, distance, first_word): the nearest window for each document and item."""
    tune(docs.sparkSession)
    named = items.select(F.col(item_col).alias("item"), F.lower(item_text_col).alias("text"))
    places = slots(named)
    prepared = stage(_item_rows(named, places), "items")
    shared = docs.sparkSession.sparkContext.broadcast(_filters(prepared, places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, hashes, starts, ends, first in _batches(batches, 2):
            found = [[] for _ in range(5)]

            def keep(a, b, n, keys):
                row = int(np.searchsorted(first, a, side="right")) - 1
                window = b" ".join(_RUN.findall(data[starts[a]:ends[b - 1]].tobytes())).decode(errors="replace")
                for box, value in zip(found, (row, int(a - first[row]), n, window, keys.astype(np.uint64).view(np.int64).tolist())):
                    box.append(value)

            for n, lo, hi in shared.value.windows(hashes, first):
                near, begin, end = _covered(lo, hi, n)
                keys = walk_keys(hashes[near], begin, end, n).T
                hit = shared.value.hits(keys)
                for w in np.flatnonzero(hit.any(axis=1)):
                    keep(lo[w], hi[w], n, keys[w][hit[w]])
            for n, lo, keys in shared.value.exact(hashes, first):
                for a, key in zip(lo, keys):
                    keep(a, a + n, n, np.array([key]))
            if found[0]:
                taken = pa.array(found[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(taken), part.column(1).take(taken), pa.array(found[1], pa.int64()),
                     pa.array(found[2], pa.int32()), pa.array(found[3], pa.string()),
                     pa.array(found[4], pa.list_(pa.int64()))], names=["key", "id", "at", "n", "window", "keys"])

    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    rows = docs.select(document_key(docs, id_col, text_col).alias("key"), F.col(id_col).alias("id"),
                       F.lower(text_col).alias("text"))
    windows = rows.mapInArrow(run, f"key string, id {kind}, at long, n int, window string, keys array<long>")
    windows = stage(windows, "windows")
    by_key = prepared.select("item", "words", F.col("n").alias("size"), F.explode("keys").alias("k"))
    met = windows.select("key", "id", "at", "n", "window", F.explode("keys").alias("k")).join(by_key, "k")
    met = met.filter("n = size").select("key", "id", "at", "n", "window", "item", "words").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                sides = [[t.encode().split() for t in part.column(c).to_pylist()] for c in (4, 6)]
                d = distances(list(zip(*sides)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in (0, 1, 2, 3, 5)), pa.array(d)], names=["key", "id", "at", "n", "item", "d"])

    near = met.mapInArrow(verify, f"key string, id {kind}, at long, n int, item {item_kind}, d long")
    near = near.filter(F.col("d") <= F.when(F.col("n") < LEAST, 0).otherwise(F.floor(F.col("n") * EDITS + 1e-9)))
    best = near.groupBy("key", "id", "item", "n").agg(F.min(F.struct("d", "at")).alias("b"))
    return best.select("key", F.col("id").alias(id_col), F.col("item").alias(item_col),
                       F.col("n").cast("long").alias("n_words"), F.col("b.d").alias("distance"),
                       F.col("b.at").alias("first_word"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item was found, unchanged."""
    leaks = matches(docs, items, id_col, text_col).select("key").distinct()
    rows = docs.select(F.struct("*").alias("row"), document_key(docs, id_col, text_col).alias("key"))
    return rows.join(leaks, "key", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
