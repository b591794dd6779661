import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from shelfline.llm import packing
from shelfline.llm.queries import vocabulary
from tests.llm.helpers import DOCS, awkward, docs, empty

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary("word_bpe_49k.json")


def library_ids(texts, path=PATH):
    tool = tokenizers.Tokenizer.from_file(path)
    return [e.ids for e in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(name):
    rng = random.Random(5)
    alphabet = list("abcXYZ  \n\t\x1c\x1f\x85\xa0'.,0129éßIİΣ😀 　́e") + ["'s", "'LL", " The", "<|endoftext|>", "don't", "  "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(1500)]
    texts += ["", " ", "a" * 3000, "e ́", "<|startoftext|>x", "<|endoftext", "ΑΣ ΑΣ"]
    texts += ["".join(map(chr, rng.choices(range(256), k=40))) for _ in range(800)]
    path = vocabulary(name)
    maker = packing.TokenIds(path, size=500)
    assert maker.by_piece == (name == "word_bpe_49k.json")
    got = [np.frombuffer(i, f"<u{maker.width}").tolist() for k in range(0, len(texts), 100) for i in maker.encode(texts[k:k + 100])]
    assert got == library_ids(texts, path)


def check(pieces, texts, total_length, width=2, end=2):
    """Whole documents, gapless sequences, no padding; returns ids by sequence and source."""
    want = sorted((i, [*ids, end]) for (i, _), ids in zip(texts, library_ids(t for _, t in texts)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    got = []
    for i, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        ids = np.frombuffer(b"".join(p.ids for p in own), f"<u{width}")
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert all(p.doc_tokens == len(ids) for p in own)
        got.append((i, ids.tolist()))
    assert sorted(got) == want
    for p in pieces:
        assert p.ids_crc32 == crc32(np.frombuffer(p.ids, f"<u{width}").astype("<u4").tobytes())
    total = sum(p.length for p in pieces)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        n = sum(p.length for p in own)
        assert n == own[0].padded and (n == total_length or (k >= total // total_length and n & (n - 1) == 0 and n < total_length))
    return by_sequence


def corpus(rng, sizes):
    return [(i, " ".join(rng.choices(["the", "cat", "sat"], k=rng.randint(0, 40))), s)
            for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]


@pytest.mark.parametrize("block", [70, 1000, 1 << 20])
def test_every_window_has_the_mixture(spark, block, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", block % 3)
    rng = random.Random(block)
    rows = corpus(rng, {"a": 300, "b": 60, "c": 25, None: 12, "": 3, "rare": 1})
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    pieces = packing.pack(df.repartition(5), PATH, length=64, block_tokens=block).collect()
    by_sequence = check(pieces, [(i, t) for i, t, _ in rows], 64)
    totals = defaultdict(int)
    for p in pieces:
        totals[p.source] += p.length
    whole, seen = sum(totals.values()), defaultdict(int)
    for k in range(whole // 64):
        for p in by_sequence[k]:
            seen[p.source] += p.length
        for s, n in totals.items():
            assert abs(seen[s] - n * 64 * (k + 1) / whole) <= len(totals), (k, s)


def test_weights_hold_while_queues_last(spark):
    rng = random.Random(9)
    rows = corpus(rng, {"a": 100, "b": 100, "c": 100})
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    pieces = packing.pack(df, PATH, length=64, weights={"a": 6, "b": 1}, block_tokens=500).collect()
    by_sequence = check(pieces, [(i, t) for i, t, _ in rows], 64)
    a = sum(p.length for p in pieces if p.source == "a")
    for k in range(a * 8 // 6 // 64 - 1):
        own = defaultdict(int)
        for p in by_sequence[k]:
            own[p.source] += p.length
        assert abs(own["a"] - 48) <= 3 and abs(own["b"] - 8) <= 3 and abs(own["c"] - 8) <= 3
    last = max(by_sequence)
    assert {p.source for p in by_sequence[last // 2 + 3]} == {"b", "c"}
    with pytest.raises(ValueError):
        packing.pack(df, PATH, weights={"a": 0})


def test_many_sources(spark):
    rows = [(i, "the cat", f"s{i % 150}") for i in range(300)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    check(packing.pack(df, PATH, length=16, block_tokens=100).collect(), [(i, t) for i, t, _ in rows], 16)


def test_end_of_stream():
    assert [packing.open_sequence(p, 64 + 11, 64) for p in (0, 63, 64, 71, 72, 73, 74)] == [
        (0, 0, 64), (0, 63, 64), (1, 0, 8), (1, 7, 8), (2, 0, 2), (2, 1, 2), (3, 0, 1)]


def test_awkward_rows(spark):
    rows = packing.pack_report(awkward(spark), PATH).collect()
    assert sum(r.length for r in rows) == sum(len(i) + 1 for i in library_ids(
        [r.text for r in awkward(spark).collect()]))
    assert packing.pack_report(empty(spark), PATH).count() == 0
    assert packing.pack_report(docs(spark, [None]), PATH).first().doc_tokens == 1
