"""SimHash classes, line chunks and repeated byte runs against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from rows_for_tests import SCHEMA, messy_rows, prose

from tillsight.llm import line_dedup, simhash, suffix_dedup
from tillsight.llm.components import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_is_brute_force(messy):
    rows = messy_rows()
    prints = [brute_print(r[1]) for r in rows]
    classes = brute_classes(prints)
    least = {}
    for r, c in zip(rows, classes):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((str(r[0]), p, least.get(c)) for r, p, c in zip(rows, prints, classes))
    got = sorted((str(r.doc_id), r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_copies(messy).collect())
    assert got == want


def test_links_lose_no_pair(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << bit
            prints.append(p)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    root = {r.node: r.root for r in components(simhash.links(df)).collect()}
    same = {}
    for p, c in zip(signed, brute_classes(prints)):
        same.setdefault(c, set()).add(root.get(p, p))
    assert all(len(roots) == 1 for roots in same.values())
    assert len({r for roots in same.values() for r in roots}) == len(same)


def test_one_of_each_class_stays(messy, empty):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    named = [(r.doc_id, r.text) for r in rows if r.doc_id is not None]
    # One row of each class that has an id, the smallest, whatever other rows its id has.
    given = [r for r in messy_rows() if r[0] is not None]
    classes = {}
    for r, c in zip(given, brute_classes([brute_print(r[1]) for r in given])):
        classes.setdefault(c, set()).add((r[0], r[1]))
    assert len(named) == len(classes) and [r.doc_id for r in rows].count(None) == 2
    for members in classes.values():
        (one,) = members & set(named)
        assert one[0] == min(i for i, _ in members)
    assert sum(i == 9 for i, _ in named) == 2
    assert simhash.keep_one(empty).count() == 0


def test_unlike_texts_of_one_id_both_stay(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 60) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, c), (3, b)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == sorted([(1, a), (1, b), (2, c)])
    clash = docs.withColumn("_th", docs["doc_id"])
    assert sorted(r._th for r in simhash.keep_one(clash).collect()) == [1, 1, 2]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(1001, 1300)]
    root = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(root.values()) == {0, 1000} and len(root) == 501
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows):
    """Windows of two lines with words, in order; those met before go, with what lies between their lines."""
    seen, out = set(), {}
    for i, text in sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: r[0]):
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for a, b in zip(full, full[1:]):
            if (lines[a], lines[b]) in seen:
                gone.update(range(a, b + 1))
            seen.add((lines[a], lines[b]))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_chunks(spark, messy, empty):
    rows = [r for r in messy_rows() if r[0] is not None and r[0] != 9]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: t for i, t in got.items() if t is not None} == brute_lines(rows) and got[0] is None
    out = line_dedup.dedup_lines(messy)
    assert set(out.columns) == {*messy.columns, "removed_spans"} and out.count() == messy.count()
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("size", [2, 3, 5, 8, 12, 60])
def test_passages_of_any_number_of_lines_go(spark, size):
    """Forty passages, each in two documents with other lines around them: the second occurrence goes whole, nothing else."""
    rng = random.Random(size)
    line = lambda: prose(rng, 9).replace("\n", " ")
    rows, want = [], {}
    for n in range(40):
        passage = [line() for _ in range(size)]
        if n % 2:
            passage.insert(1, "")  # a blank line inside
        for k in range(2):
            before, after = ([line() for _ in range(rng.randint(0, 4))] for _ in range(2))
            rows.append((2 * n + k, "\n".join(before + passage + after)))
            want[2 * n + k] = "\n".join(before + (passage if k == 0 else []) + after)
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out} == want


def test_single_lines_and_blank_ones_stay(spark):
    rows = [(1, "one line\n\n\nother"), (2, "one line\n\n\nanother"), (3, "\n\n\n"), (4, "\n\n\n"), (5, "one line"), (6, "one line")]
    out = {r.doc_id: (r.text, len(r.removed_spans)) for r in
           line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: (t, 0) for i, t in rows}


def test_repeated_rows_of_one_document_are_cut_alike(spark):
    rows = [(1, "a b\nc d\ne f"), (1, "a b\nc d\ne f"), (2, "x y\nc d\ne f"), (2, "x y\nc d\ne f"), (None, "c d\ne f\nz")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted([(0, "c d\ne f\nz"), (1, "a b"), (1, "a b"), (2, "x y"), (2, "x y")])


def brute_bytes(rows, length):
    seen, out = set(), {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for i, text in sorted(rows, key=key):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if raw[a:a + length] in seen:
                gone[a:a + length] = b"\1" * length
            seen.add(raw[a:a + length])
        out[i] = bytes(b for b, g in zip(raw, gone) if not g)
    return out


@pytest.mark.parametrize("length", [100, 40])
def test_byte_runs(spark, length):
    rows = [(r[0], r[1]) for r in messy_rows() if r[0] not in (None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_repeats(df, length).collect()}
    assert got == brute_bytes(rows, length)


@pytest.mark.parametrize("parts", [1, 5])
def test_byte_runs_of_repeated_rows(spark, parts):
    rows = [(r[0], r[1]) for r in messy_rows() if r[0] is not None and r[1] != "same id, other text"]
    assert len(rows) > len(set(rows))
    rows += [r for r in rows if r[0] in (7, 12)]
    out = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    want = brute_bytes(set(rows), 100)
    assert sorted((r.doc_id, bytes(r.kept)) for r in out) == sorted((i, want[i]) for i, _ in rows)


def test_byte_runs_with_heavy_anchors(spark, monkeypatch):
    rng = random.Random(8)
    passage = prose(rng, 40)
    rows = [(i, prose(rng, rng.randint(1, 30)) + passage + prose(rng, 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(suffix_dedup, "HEAVY", 64)
    want = brute_bytes(rows, 100)
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_repeats(df).collect()} == want


def test_byte_runs_of_long_texts(spark):
    """Texts are hashed in parts; windows over the parts' ends are met like others."""
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    size = suffix_dedup.SLICE
    passage = noise(3_000)
    first = noise(size - 1_500) + "1" + passage + "2" + noise(2 * size)
    second = "3" + noise(2 * size - 70) + "4" + passage + "5" + noise(size // 2)
    rows = [(1, first), (2, second), (3, "6" + passage[:150] + "7")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {1: first, 2: second.replace(passage, ""), 3: "67"}


def test_memory_of_a_long_text_is_bounded():
    import tracemalloc
    batch = pa.RecordBatch.from_pydict({"id": [1], "th": [2], "text": ["some words that go on, " * (1 << 20)]})  # 24 MB
    tracemalloc.start()
    for part in suffix_dedup._slices(iter([batch]), 100):
        assert len(part[1]) <= suffix_dedup.SLICE + 99
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20


def test_byte_runs_of_messy_and_empty(messy, empty):
    out = suffix_dedup.without_repeats(messy)
    assert out.count() == messy.count()
    assert all(bytes(r.kept) == b"" for r in out.filter("n_bytes = 0").collect())
    assert suffix_dedup.without_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_common_prefixes(seed):
    rng = random.Random(seed)
    length = rng.choice([2, 5, 9])
    parts = ["".join(rng.choice("abé"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 50))).encode() for _ in range(6)]
    seen = set()
    for part, marks in zip(parts, suffix_dedup.repeated_windows(parts, length)):
        windows = [part[i:i + length] for i in range(len(part) - length + 1)]
        for w, m in zip(windows, marks, strict=True):
            assert m == (w in seen)
            seen.add(w)


def test_a_task_hashes_a_megabyte_at_most():
    text = "".join(chr(97 + i * i % 26) for i in range(1500)) * 1000
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([5, 6]), pa.array([text, text[:700_000]])], names=["id", "th", "text"])
    assert max(len(part[1]) for part in suffix_dedup._slices(iter([batch]), 100)) <= 1 << 20


def test_copies_of_one_segment_travel_without_their_bytes():
    from types import SimpleNamespace
    rng = random.Random(12)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000))
    batches = [pa.RecordBatch.from_pydict({"id": [i], "th": [7], "text": [text]}) for i in (3, 1, 2)]
    every = np.full(1 << (suffix_dedup.FILTER_BITS - 6), ~np.uint64(0))
    spans, sizes = [], []
    for several in (every, 0 * every):
        shared = SimpleNamespace(value=(every, several, 0 * every))
        sent = [b for x in batches for b in suffix_dedup._candidates(iter([x]), shared, 100, 1)]  # a task for each
        rows = [r for b in sent for block in b.column(1) for r in suffix_dedup._unpacked(block.as_py())]
        sizes.append(max(len(r[5]) for r in rows))
        spans.append(sorted(tuple(r.values()) for b in suffix_dedup._marked(iter(sent), 100) for r in b.to_pylist()))
    assert sizes[0] >= 100 and sizes[1] == suffix_dedup.DIGEST
    assert spans[0] == spans[1] and {s[0] for s in spans[1]} == {2, 3}


def test_byte_runs_of_whole_and_edited_copies(spark):
    """Anchors with one segment, with several, and both in one text, met across tasks."""
    rng = random.Random(15)
    texts = [prose(rng, 60) for _ in range(8)]
    rows = []
    for i in range(96):
        text = texts[i % 8]
        if i % 3 == 1:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1:]
        if i % 5 == 2:
            text = text[rng.randrange(80):] + prose(rng, 5) + texts[(i + 3) % 8]
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_repeats(df).collect()} == brute_bytes(rows, 100)
