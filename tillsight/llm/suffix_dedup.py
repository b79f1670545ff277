"""Byte runs that occur earlier in the corpus, by common prefixes of suffixes up to a minimum length.

A byte is removed when a string of ``length`` bytes covers it that also starts earlier: in a document with a smaller id,
or in the same one at an earlier byte.

1. Candidates, losing nothing: among the ``GRAM``-byte strings inside a window of ``length`` bytes, the one with the least
   hash is its anchor, so equal windows have equal anchors at the same place.  Consecutive windows with one anchor form a
   segment.  Anchors that occur once in the corpus can't belong to a repeated window; only the segments of the others go
   on, grouped by anchor.  Equal segments are combined, in each task before the shuffle and in each group after it: all
   but the first are repeats, and the next step works on what differs.  Anchors are counted together with the hashes of
   their segments, so it is known which of them have one segment only, however often it comes: there nothing is left for
   the next step, and its copies travel as a digest of their bytes and a place.  The others travel with their bytes.
2. Within each group of anchors the segments are sorted as a suffix array, whose Burrows-Wheeler transform gives backward
   steps.  Breadth first, intervals of suffixes that begin with the same string are extended by one byte in front.  Every
   extension that ends where no common prefix is known yet fixes that value, so common prefixes come out in increasing
   order, and the search stops at ``length``: places still open have at least that much in common.  Windows that no
   smaller value separates are equal, and all but the first are marked.
3. Marked windows are united by document.

An anchor with more than ``HEAVY`` different segments is not one group: each of its windows goes on alone, grouped by its
own hash, so no task has to take all of them, at any size of the corpus.  A group that is left with one segment needs no
second step.

Defined results: null texts are empty; texts below ``length`` bytes lose nothing; rows without id come before the others;
rows of one id with different texts are ordered by a hash of the text; repeated rows of one id and text count as one
document and are cut alike; other columns are not read, so they may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tillsight.llm.words import mix, slices, text_bytes
from tillsight.session import stage, tune

LENGTH = 100
GRAM = 32
FILTER_BITS = 27  # the filter of repeated anchors has 2 ** FILTER_BITS bits, whatever the corpus
HEAVY_BITS = 24  # that of the few heavy ones
HEAVY = 5_000  # different segments of one anchor, from which on its windows go alone
BLOCK = 1 << 19
BUCKET = 100_000  # segments in a bucket, about
HELD = 32 << 20  # bytes that a task gathers before it packs its segments
DIGEST = 8  # bytes that stand for a segment whose bytes nobody needs; less than any segment has
ANCHORS = 1 << 20  # anchors that a task gathers before it hands them on
SLICE = 1 << 19  # bytes that are hashed together; longer texts go in parts
PLACE_BITS = 22  # a place in a slice; the same for all, so that equal windows compare equal hashes
_BYTE, _STEP = mix(256, 11), mix(8, 12)


# Candidates ---------------------------------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each byte on (GRAM is a power of two)."""
    with np.errstate(over="ignore"):
        h, width, step = _BYTE[data], 1, 0
        while width < GRAM:
            h = h[:-width] * _STEP[step] + h[width:]
            width, step = 2 * width, step + 1
        h ^= h >> np.uint64(31)
        h *= _STEP[7]
        h ^= h >> np.uint64(29)
    return h


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, text number, first window, last window, hash of all its bytes) of every segment.

    Windows are counted from ``data``'s start.
    """
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.uint64))
    if len(data) < length:
        return none
    h = gram_hashes(data)
    places = np.arange(len(h), dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (h & ~low) | places  # the leftmost of equal values wins
    width, reach = 1, length - GRAM + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[:width - reach], least[reach - width:])
    anchor = (least & low).astype(np.int64)
    # A window lies in one text.
    text = np.flatnonzero(np.diff(offsets) >= length)
    opens = offsets[:-1][text]
    closes = offsets[1:][text] - length
    inside = np.zeros(len(anchor) + 1, np.int8)
    inside[opens] += 1
    np.add.at(inside, closes + 1, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    starts = inside.copy()
    starts[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts[opens] = True
    first = np.flatnonzero(starts)
    if not len(first):
        return none
    of = np.searchsorted(offsets, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(anchor)) - 1, offsets[1:][of] - length)
    end = last + length - GRAM  # the last string of GRAM bytes in a segment
    with np.errstate(over="ignore"):
        look = (end - first).astype(np.uint64) * _STEP[4] + h[first]
        for at in range(GRAM, 2 * length - GRAM, GRAM):
            look = look * _STEP[5] + h[np.minimum(first + at, end)]
        look ^= look >> np.uint64(32)
    return h[anchor[first]], of, first, last, look


# Common prefixes ----------------------------------------------------------------------------------------------------

def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate(([False], ordered[1:] != ordered[:-1]))
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new)
    return order, ranks


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes, by doubling; the text counts as ending in zeros."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    order, ranks = _ranks(key)
    known = 8
    while known < depth and ranks[order[-1]] < n - 1:
        step = min(known, depth - known)
        after = np.zeros(n, np.int64)
        after[:n - step] = ranks[step:] + 1
        order, ranks = _ranks(ranks * (n + 1) + after)
        known += step
    return order


def open_places(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix has ``length`` bytes or more in common with the one before it; zeros separate texts.

    Strings with a zero are not followed, so places between suffixes that share one may stay open too.
    """
    n = len(text)
    bwt = text[order - 1]  # the byte before the first one is the last, a zero
    by_byte = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)
    step[by_byte] = np.arange(n)  # the backward step of each place
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    low, high = np.array([0]), np.array([n])
    table = _Counts(bwt)
    for _ in range(length):
        size = high - low
        small = size <= 1024
        a, b = low[small], high[small]
        # Small intervals: look at every place in them.
        count = b - a
        of = np.repeat(np.arange(len(a)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
        byte = bwt[place].astype(np.int64)
        real = byte > 0
        of, byte, to = of[real], byte[real], step[place[real]]
        single = len(of) < 2 or bool((np.diff(of) > 0).all())
        if not single:
            by = np.argsort(of * 256 + byte, kind="stable")
            of, byte, to = of[by], byte[by], to[by]
        key = of * 256 + byte
        last = np.append(key[1:] != key[:-1], True) if len(key) else np.zeros(0, bool)
        first = np.append(True, last[:-1]) if len(key) else last
        lows, highs = [to[first]], [to[last] + 1]
        # Large ones: counts of each byte before both ends.
        for x, y in zip(low[~small], high[~small]):
            p, q = table.before(x), table.before(y)
            has = np.flatnonzero((q > p)[1:]) + 1
            lows.append(table.start[has] + p[has])
            highs.append(table.start[has] + q[has])
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = open_[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        # Several intervals may end at one place; one of them is enough.
        high, one = np.unique(high, return_index=True)
        low = low[one]
        open_[high] = False
    return open_[:n]


class _Counts:
    """How often each byte occurs before a place."""

    def __init__(self, bwt: np.ndarray, every: int = 4096):
        self.bwt, self.every = bwt, every
        blocks = -(-len(bwt) // every)
        table = np.bincount(np.arange(len(bwt)) // every * 256 + bwt, minlength=blocks * 256).reshape(blocks, 256)
        self.table = np.concatenate((np.zeros((1, 256), np.int64), np.cumsum(table, axis=0)))
        self.start = np.concatenate(([0], np.cumsum(self.table[-1])[:-1]))

    def before(self, place: int) -> np.ndarray:
        block = place // self.every
        return self.table[block] + np.bincount(self.bwt[block * self.every:place], minlength=256)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, given in order of precedence, which of its windows occur earlier in the list."""
    if not parts:
        return []
    # Bytes are shifted up by one so that zero separates; 255 does not occur in UTF-8.
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(text, length)
    group = np.cumsum(~open_places(text, order, length))
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, np.maximum(begin + sizes - length + 1, begin), -1)
    window = (np.cumsum(edge[:-1]) > 0)[order]
    at, group = order[window], group[window]
    found = np.zeros(len(text), bool)
    if len(at):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least = np.repeat(np.minimum.reduceat(at, first), np.diff(np.append(first, len(at))))
        found[at[at > least]] = True
    return [found[b:b + max(0, s - length + 1)] for b, s in zip(begin, sizes)]


# Numbers that travel ------------------------------------------------------------------------------------------------

def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of 64-bit numbers, all first bytes, then all second ones: like bytes compress well."""
    return values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view(np.uint64)


def _joined(held: list[tuple]) -> list[np.ndarray]:
    """Columns from tuples of arrays, which are given up."""
    columns = [list(x) for x in zip(*held)]
    held.clear()
    return [np.concatenate(columns.pop(0)) for _ in range(len(columns))]


# Spark --------------------------------------------------------------------------------------------------------------

def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """(rows, bytes, offsets, bytes of the text before these, segments) of the texts; parts of a long one share windows' ends."""
    for batch in batches:
        for part in slices(batch, SLICE):
            data, offsets = text_bytes(part.column(2))
            if len(data) <= 2 * SLICE:
                yield (part, data, offsets, 0, *segments(data, offsets, length))
                continue
            for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                # Every window begins in one part; a text below ``length`` bytes has none.
                for at in range(begin, max(begin + 1, end - length + 1), SLICE):
                    some = data[at:min(end, at + SLICE + length - 1)]
                    ends = np.array([0, len(some)])
                    yield (part.slice(row, 1), some, ends, at - begin, *segments(some, ends, length))


def _anchor_counts(rows: DataFrame, length: int) -> DataFrame:
    """(h, c, d): anchors that occur again, how often, and how many different segments they have.

    Hashes travel as blocks of numbers, one for each bucket of anchors, and are counted bucket by bucket.  Of an anchor's
    hash the first 40 bits do: anchors that share them count as one, so more of them go on, never fewer.  A segment's hash
    has 55 bits, and one more that tells that the segment occurs again in the block.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 16 * parts

    def blocks(held: list) -> pa.RecordBatch:
        h, look = _joined(held)
        h >>= np.uint64(24)
        look >>= np.uint64(9)
        bucket = (h % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((look, h, bucket)).astype(np.int32)
        h, look = h[order], look[order]
        at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (look[1:] != look[:-1])))
        more = np.diff(np.append(at, len(h))) > 1
        bucket, h, look = bucket[order][at], h[at], (look[at] << np.uint64(1)) | more
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts]), pa.array([_planes(h[x:y], 5) + _planes(look[x:y], 7) for x, y in zip(cuts, cuts[1:] + [len(bucket)])], pa.binary())],
            names=["bucket", "block"])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, _, _, _, h, _, _, _, look in _slices(batches, length):
            held.append((h, look))
            n += len(h)
            if n > ANCHORS:
                yield blocks(held)
                held, n = [], 0
        if n:
            yield blocks(held)

    def counts(held: list) -> pa.RecordBatch:
        h = np.concatenate([_numbers(x[:len(x) // 12 * 5], 5) for x in held]) << np.uint64(24)
        look = np.concatenate([_numbers(x[len(x) // 12 * 5:], 7) for x in held])
        look, times = look >> np.uint64(1), 1 + (look & np.uint64(1)).astype(np.int64)
        order = np.lexsort((look, h))
        h, look = h[order], look[order]
        new = np.append(True, h[1:] != h[:-1])
        other = new | np.append(True, look[1:] != look[:-1])
        at = np.flatnonzero(new)
        c, d = np.add.reduceat(times[order], at), np.add.reduceat(other.astype(np.int64), at)
        more = c > 1
        return pa.RecordBatch.from_arrays([pa.array(h[at][more].view(np.int64)), pa.array(c[more]), pa.array(d[more])], names=["h", "c", "d"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and held:
                    yield counts(held)
                    held = []
                now = bucket
                held.append(block.as_py())
        if held:
            yield counts(held)

    dealt = rows.mapInArrow(anchors, "bucket int, block binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(again, "h long, c long, d long")


def _bits(hashes: DataFrame, size: int = FILTER_BITS) -> np.ndarray:
    """A filter of 2 ** size bits that knows the hashes in the only column; others may pass by chance."""
    h = F.col(hashes.columns[0])
    word = F.shiftrightunsigned(h, 64 - size + 6).alias("w")
    bit = F.shiftrightunsigned(h, 64 - size).bitwiseAND(F.lit(63)).cast("int")
    found = hashes.select(word, bit.alias("b")).groupBy("w").agg(
        F.expr("bit_or(shiftleft(1L, b))").alias("bits")).toPandas()
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - 5 - len(bits).bit_length())  # of 64 * len(bits) bits
    return ((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)) == 1


def _alone(data, h, of, first, last, whole, heavy, length):
    """Segments of heavy anchors as single windows, grouped by a hash of the window.

    The filter may take others for heavy, but the same ones in every task.  ``whole`` tells whose bytes are needed: those
    of a single window never, as different windows share nothing.
    """
    hot = _known(heavy, h)
    if not hot.any():
        return h, of, first, last, whole
    count = (last - first + 1)[hot]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[hot], count)
    keys = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            keys = keys * _STEP[6] + _BYTE[data[at + k]]
        keys ^= keys >> np.uint64(32)
    cold = ~hot
    return (np.concatenate((h[cold], keys)), np.concatenate((of[cold], np.repeat(of[hot], count))),
            np.concatenate((first[cold], at)), np.concatenate((last[cold], at)),
            np.concatenate((whole[cold], np.zeros(len(at), bool))))


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _packed(columns: list[np.ndarray], sizes: np.ndarray, piece, buckets: int) -> pa.RecordBatch:
    """Rows (g, whether it has an id, id, th, a, b) and their pieces as one compressed block for each bucket.

    A piece is the bytes of a segment, their digest, or nothing for a span that is known to repeat; its size is then -1.
    """
    bucket = (columns[0] % buckets).astype(np.int32)
    order = np.lexsort((columns[0], bucket))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    names, blocks = [], []
    press = zstandard.ZstdCompressor(level=3)
    for part in np.split(order, cuts):
        body = [_planes(c[part].astype(np.int64), 8) for c in (*columns, sizes)] + [piece(k) for k in part.tolist()]
        names.append(int(bucket[part[0]]))
        blocks.append(press.compress(len(part).to_bytes(8, "little") + b"".join(body)))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "block"])


def _unpacked(block: bytes) -> list[tuple]:
    """Rows (g, id, th, a, b, piece)."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(raw[:8], "little")
    at = 8 + 7 * 8 * n
    g, named, ids, th, a, b, sizes = (_numbers(raw[x:x + 8 * n], 8).view(np.int64).tolist() for x in range(8, at, 8 * n))
    out = []
    for k in range(n):
        piece = None
        if sizes[k] >= 0:
            piece = raw[at:at + sizes[k]]
            at += sizes[k]
        out.append((g[k], ids[k] if named[k] else None, th[k], a[k], b[k], piece))
    return out


def _combined(held: list[tuple], docs: list[tuple], body: bytearray, buckets: int) -> pa.RecordBatch:
    """The first place of each different segment held, and the others' places as spans that repeat."""
    named, ids, th = _joined(docs)
    order = np.lexsort((th, ids, named))
    new = np.append(False, np.any([x[order][1:] != x[order][:-1] for x in (named, ids, th)], axis=0))
    place = np.empty(len(order), np.int32)
    place[order] = np.cumsum(new)
    g, one, two, doc, a, n, text = _joined(held)
    place = place[doc]
    order = np.lexsort((a, place, two, one, g)).astype(np.int32)
    new = np.append(True, np.any([x[order[1:]] != x[order[:-1]] for x in (g, one, two)], axis=0))
    del two
    first = order[new]
    of = first[np.cumsum(new, dtype=np.int32) - 1]
    # Repeated rows of one id and text have the same place: they speak with one voice.
    later = order[(place[order] != place[of]) | (a[order] != a[of])]
    del order, new, of
    # Spans of one text are united; texts lie far apart.
    far = np.int64(1 << 40)
    begin = place[later] * far + a[later]
    order = np.argsort(begin)
    later, begin = later[order], begin[order]
    end = np.maximum.accumulate(begin + n[later])
    opens = np.flatnonzero(np.append(True, begin[1:] > end[:-1])[:len(begin)])
    late, end = later[opens], end[np.append(opens[1:], len(end))[:len(opens)] - 1]
    end = np.concatenate((a[first] + n[first], end - place[late] * far))
    key = np.concatenate((g[first], th[doc[late]] ^ a[late]))
    size = np.concatenate((np.where(text[first] < 0, DIGEST, n[first]), np.full(len(late), -1, np.int32)))
    one, text = one[first], text[first]
    rows = np.concatenate((first, late))
    doc, a = doc[rows], a[rows]
    del g, place, n, later, begin, opens, order

    def piece(k: int) -> bytes:
        if size[k] < 0:
            return b""
        return bytes(body[text[k]:text[k] + size[k]]) if text[k] >= 0 else one[k].tobytes()

    return _packed([key, named[doc], ids[doc], th[doc], a, end], size, piece, buckets)


def _candidates(batches: Iterator[pa.RecordBatch], shared, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Segments with repeated anchors; those that equal an earlier one among the segments held are given as finished spans.

    Segments held are equal if their anchors' hashes and 128 bits of their digests are.  An anchor's segments all come with
    their bytes, or all as digests: of these 64 bits travel, as all the anchor's segments have one hash already.
    """
    bits, several, heavy = shared.value
    held, docs, body = [], [], bytearray()
    rows = size = 0

    for part, data, offsets, shift, h, of, first, last, _ in _slices(batches, length):
        keep = _known(bits, h)
        h, of, first, last = h[keep], of[keep], first[keep], last[keep]
        if not len(h):
            continue
        h, of, first, last, whole = _alone(data, h, of, first, last, _known(several, h), heavy, length)
        raw, end = data.tobytes(), last + length
        digests = b"".join([blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(first.tolist(), end.tolist())])
        one, two = np.frombuffer(digests, np.int64).reshape(-1, 2).T
        n = (end - first).astype(np.int32)
        text = np.full(len(h), -1, np.int32)
        text[whole] = len(body) + np.cumsum(n[whole]) - n[whole]
        body += b"".join([raw[x:y] for x, y in zip(first[whole].tolist(), end[whole].tolist())])
        # Texts are below 2 GB, as arrays of them are.
        held.append((h.view(np.int64), one, two, (of + rows).astype(np.int32), (first - (offsets - shift)[of]).astype(np.int32), n, text))
        ids = part.column(0)
        docs.append((ids.is_valid().cast(pa.int64()).to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False)))
        rows += len(part)
        size += 40 * len(h) + int(n[whole].sum())
        if size > HELD:
            yield _combined(held, docs, body, buckets)
            held, docs, body = [], [], bytearray()
            rows = size = 0
    if held:
        yield _combined(held, docs, body, buckets)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each bucket, sorted by group; blocks come sorted by bucket."""
    rows, now = [], None
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != now and rows:
                yield sorted(rows, key=lambda r: r[0])
                rows = []
            now = bucket
            rows += _unpacked(block.as_py())
    if rows:
        yield sorted(rows, key=lambda r: r[0])


def _marked(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated spans from the segments of whole buckets."""
    spans: list[tuple] = []
    group: dict[bytes, tuple] = {}  # the first place of each different segment, by its bytes or digest
    block: list[tuple] = []  # segments of groups that have several
    size, last, longest = 0, None, 0

    def span(where, a, b):
        spans.append((where[1] if where[0] else None, where[2], a, b))

    def close_group():
        nonlocal size, longest
        if len(group) > 1:  # one segment alone has nothing left to share
            if len(next(iter(group))) > DIGEST:
                block.extend((where, piece) for piece, where in group.items())
                size += sum(map(len, group))
            elif longest > length:  # different windows share nothing, but longer segments may
                raise RuntimeError("different segments of one anchor have the same hash")
        group.clear()
        longest = 0

    def solve():
        nonlocal size
        block.sort()
        for (where, piece), marks in zip(block, repeated_windows([piece for _, piece in block], length)):
            edges = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
            for x, y in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
                span(where, where[3] + x, where[3] + y - 1 + length)
        block.clear()
        size = 0

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array([s[k] for s in spans], pa.int64()) for k in range(4)],
                                         names=["id", "th", "a", "b"])
        spans.clear()
        return out

    for rows in _buckets(batches):
        for g, i, th, a, b, piece in rows:
            if g != last:
                close_group()
                last = g
                if size > BLOCK:
                    solve()
            where = (i is not None, i or 0, th, a)
            if piece is None:
                span(where, a, b)
                continue
            longest = max(longest, b - a)
            before = group.setdefault(piece, where)
            if before != where:
                group[piece], late = min(before, where), max(before, where)
                span(late, late[3], late[3] + b - a)
        if len(spans) > 20_000:
            yield flush()
    close_group()
    solve()
    yield flush()


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, spans): byte spans [a, b) that repeat earlier text, not yet united, by id and hash of the text."""
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    again = stage(_anchor_counts(rows, length), "anchors")
    several = _bits(again.filter(F.col("d") > 1).select("h"))
    heavy = _bits(again.filter(F.col("d") > HEAVY).select("h"), HEAVY_BITS)
    shared = docs.sparkSession.sparkContext.broadcast((_bits(again.select("h")), several, heavy))
    repeats = again.agg(F.sum("c")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), repeats // BUCKET)
    found = rows.mapInArrow(lambda batches: _candidates(batches, shared, length, buckets), "bucket int, block binary")
    found = found.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    spans = found.mapInArrow(lambda batches: _marked(batches, length), "id long, th long, a long, b long")
    return stage(spans.groupBy("id", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, spans, kept): the united spans that go, and the remaining bytes, for every row."""
    spans = repeated_spans(docs, length, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("t"),
                       F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    # Only texts that may have spans are shuffled to meet them.
    shared = docs.sparkSession.sparkContext.broadcast(_bits(spans.select("th")))

    @F.arrow_udf("boolean")
    def touched(hashes: pa.Array) -> pa.Array:
        return pa.array(_known(shared.value, hashes.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))

    same = F.col("i").eqNullSafe(F.col("id")) & (F.col("t") == F.col("th"))
    met = rows.filter(touched("t")).join(spans, same, "left").select("i", "text", "spans")
    alone = rows.filter(~touched("t")).select("i", "text", F.lit(None).cast("array<struct<a:long,b:long>>").alias("spans"))
    joined = met.unionByName(alone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 4 * SLICE)):
            spans, kept, sizes = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                cuts = _united([(s["a"], s["b"]) for s in found.as_py() or ()])
                spans.append([{"a": a, "b": b} for a, b in cuts])
                ends = [0, *[b for _, b in cuts]]
                kept.append(b"".join(text[x:y] for x, y in zip(ends, [*[a for a, _ in cuts], len(text)])))
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "spans", "kept"])

    return joined.select("i", "text", "spans").mapInArrow(
        run, f"`{id_col}` long, n_bytes long, spans array<struct<a:long,b:long>>, kept binary")
