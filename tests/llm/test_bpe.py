import random

import pytest

from shelfline.llm import bpe
from shelfline.llm.queries import vocabulary
from tests.llm.helpers import awkward, docs, empty

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary("byte_bpe_50k.json")


def texts():
    rng = random.Random(7)
    alphabet = list("abcdefgh  \n\t'.,0123é😀ß½\u2028\u3000\x1c\x85") + ["'s", " the", "ing", "<|endoftext|>", "  ", "   "]
    out = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    return [*out, "", " ", "a" * 5000, "don't 'S 's", "<|endoftext|><|endoftext|>", "<|endoftext", "x  \n y", "\r\n\r\n"]


def test_counts_equal_the_library(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    expected = [len(e.ids) for e in library.encode_batch(texts(), add_special_tokens=False)]
    rows = {r.doc_id: r for r in bpe.token_report(docs(spark, texts()), PATH).collect()}
    assert [rows[i].n_tokens for i in range(len(expected))] == expected
    assert [rows[i].n_bytes for i in range(len(expected))] == [len(t.encode()) for t in texts()]
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows.values())


def test_forgetting_changes_nothing():
    merges, special = bpe.load_merges(PATH)
    small, large = bpe.MergeCounter(merges, special, 3), bpe.MergeCounter(merges, special, 10**6)
    assert [small.count(t) for t in texts()] == [large.count(t) for t in texts()]
    assert len(small.units) <= 3 and len(small.pieces) <= 3


def test_awkward_rows(spark):
    rows = bpe.token_report(awkward(spark), PATH).collect()
    assert len(rows) == 10 and sum(r.n_tokens == 0 for r in rows) == 2
    assert bpe.token_counts(empty(spark), PATH).count() == 0
