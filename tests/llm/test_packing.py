"""Packing against whole texts, one at a time."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from rows_for_tests import messy_rows
from tokenizers import Tokenizer

from tillsight.llm import packing
from tillsight.llm.offsets import part_offsets
from tillsight.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_words_have_the_ids_of_whole_texts(plain):
    rng = random.Random(3)
    bits = ["a", "B", "é", "é", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "1", "½", "Σ", "σς", "İ", "...", " ", "\n", "\t", "\x0b",
            "\x0c", "\r", "\x85", " ", "\x1c", "中文", "😀", "re", "\x00", "ﬁ", "x" * 90, "H\u0331", "h\u0331", ",", "?!", "»", "don't", "THE", "the,", "é."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    words = packing._Words(PATH)
    for at in range(0, len(texts), 1000):  # the cache grows
        ids, offsets = words(pa.array(texts[at:at + 1000], pa.large_string()), 2)
        for text, a, b in zip(texts[at:], offsets, offsets[1:]):
            assert ids[a:b].tolist() == plain(text), repr(text)
    ids, offsets = packing._long(words, pa.array(texts[:300], pa.large_string()), 2)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain(t) for t in texts[:300]]


def test_the_cache_is_bounded(plain, monkeypatch):
    words = packing._Words(PATH)
    monkeypatch.setattr(packing, "CACHED", 20)
    for at in range(50):
        text = " ".join(f"word{i}" for i in range(at, at + 15))
        ids, _ = words(pa.array([text], pa.large_string()), 2)
        assert ids.tolist() == plain(text) and len(words.stems) <= 36


def check_pieces(rows, texts, plain, width):
    """Every id of every row in one place, sequences without gaps, all full but the last."""
    left = {}
    for text in texts:
        left.setdefault(text[0], []).append(plain(text[1]))
    last, filled = max(r.sequence_id for r in rows), {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own = [ids for ids in left[r.doc_id] if len(ids) == r.doc_tokens]
        assert any(zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in own)
    for k, pieces in filled.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == width or (k == last and at <= width)
    assert sorted(filled) == list(range(last + 1))
    assert sum(r.length for r in rows) == sum(len(ids) for many in left.values() for ids in many)
    for key in left:
        spans = sorted((r.start, r.length) for r in rows if r.doc_id == key)
        assert sum(n for _, n in spans) == sum(map(len, left[key]))
        if len(left[key]) == 1:
            assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


def test_query_against_whole_texts(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    check_pieces(QUERIES["op11_packing"](spark, FOLDER).collect(), docs, plain, 4096)


def test_messy_rows_in_small_windows(messy, empty, plain):
    from pyspark.sql import functions as F

    packed = packing.pack(messy, PATH, 2, 16)
    rows = packed.withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, [(r[0], r[1]) for r in messy_rows()], plain, 16)
    assert {r.doc_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert packing.pack(empty, PATH, 2, 16).count() == 0
    assert packing.sequences(packing.pack(empty, PATH, 2, 16), 16).count() == 0


def test_sequences_hold_their_documents(messy, plain):
    told = packing.sequences(packing.pack(messy, PATH, 2, 64), 64).collect()
    assert [r.padded_tokens for r in told if r.n_tokens & (r.n_tokens - 1)] == [64] * sum(bool(r.n_tokens & (r.n_tokens - 1)) for r in told)
    assert all(r.padded_tokens == r.n_tokens for r in told if not r.n_tokens & (r.n_tokens - 1))
    whole = {}
    for r in told:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.n_tokens == sum(d.length for d in r.documents)
        for d in r.documents:
            whole.setdefault(d.doc_id, {})[d.start] = ids[d.offset:d.offset + d.length].tolist()
    text = next(r for r in messy_rows() if r[0] == 13)[1]
    assert sum((ids for _, ids in sorted(whole[13].items())), []) == plain(text)


def test_a_long_text_goes_in_parts(spark, plain):
    text = "some words and others, " * 300_000
    out = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, 2).collect()
    ids = b"".join(bytes(r.ids) for r in sorted(out, key=lambda r: r.start))
    assert np.frombuffer(ids, "<u4").tolist() == plain(text)


def test_offsets_over_many_partitions(spark):
    rows = [(i, i % 7) for i in range(5000)]
    out = {r.part: r.at for r in part_offsets(spark.createDataFrame(rows, "part int, n long"), "part", "n", "at").collect()}
    at = 0
    for part, n in rows:
        assert out[part] == at
        at += n
