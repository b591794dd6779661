import hashlib
import random
from collections import Counter

import numpy as np

from shelfline.llm import suffix as X
from tests.llm.helpers import awkward, docs, empty


def brute(texts, length, across=False):
    """Runs of covered bytes of each text."""
    parts = [[t[i:i + length] for i in range(len(t) - length + 1)] for t in texts]
    seen = Counter(x for own in parts for x in (set(own) if across else own))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = True
        out.append([(int(a), int(b)) for a, b in zip(*X.runs(cover), strict=True)])
    return out


def corpus(seed, alphabet, n=40):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices(alphabet, k=k))
    shared = [word(rng.randint(10, 90)) for _ in range(6)]
    texts = ["".join(rng.choice([word(rng.randint(0, 40)), rng.choice(shared)]) for _ in range(rng.randint(0, 6))) for _ in range(n)]
    return [*texts, texts[0], texts[1][1:], "a" * 100, "ab" * 60, "", shared[0]]


def found(df, length, gram, crowded=X.CROWDED, across=False):
    spans = X.repeated_spans(df, length, gram, crowded, across).collect()
    return {r.id: X.removed_runs([s.asDict() for s in r.spans]) for r in spans}


def test_spans_equal_brute_force(spark):
    for seed, alphabet in ((1, "abcdefghij"), (2, "aé"), (3, "ab")):
        texts = corpus(seed, alphabet)
        expected = brute([t.encode() for t in texts], 24)
        for crowded in (X.CROWDED, 1):
            own = found(docs(spark, texts), 24, 8, crowded)
            assert [own.get(i, []) for i in range(len(texts))] == expected, (seed, crowded)


def test_spans_across_documents_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(X, "PARTS", 3)
    for seed, alphabet, length in ((1, "abcdefghij", 24), (3, "ab", 24), (6, "abc", 15)):
        texts = corpus(seed, alphabet)
        texts += [texts[5] * 3, "xyz" * 50, ("q" * 9 + "r" * 20) * 4]  # repeats inside one document only
        expected = brute([t.encode() for t in texts], length, across=True)
        assert expected != brute([t.encode() for t in texts], length)
        for crowded in (X.CROWDED, 1):
            own = found(docs(spark, texts), length, 8, crowded, across=True)
            assert [own.get(i, []) for i in range(len(texts))] == expected, (seed, crowded)


def test_passages_go_and_short_or_own_repeats_stay(spark):
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(n))
    passage, short, own = words(55), words(44), words(70)
    texts = [words(30) + " " + passage + " " + words(20), passage + " " + words(9), words(80), short + " " + words(9),
             words(12) + " " + short, own + " and " + own, None, ""]
    out = {r.doc_id: r.text for r in X.remove_repeats(
        docs(spark, texts), X.PASSAGE_LENGTH, X.PASSAGE_GRAM, X.PASSAGE_WORDS, across=True).collect()}
    report = {r.doc_id: r.passage_words for r in X.passage_report(docs(spark, texts)).collect()}
    assert all((report[i] in (55, 56)) == (i < 2) and (i < 2 or report[i] == 0) for i in range(8))
    assert passage not in out[0] and passage not in out[1] and len(out[0].split()) in (49, 50, 51)
    assert all(out[i] == texts[i] for i in range(2, 8))


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(X, "_PIECE", 64)
    texts = corpus(5, "abcdef")
    texts[3] = texts[3] + texts[7] * 3 + texts[9]
    own = found(docs(spark, texts), 24, 8)
    assert [own.get(i, []) for i in range(len(texts))] == brute([t.encode() for t in texts], 24)


def test_construction_finds_repeats_of_aligned_segments():
    rng = np.random.default_rng(3)
    core = b"xyz"
    segments = [bytes(rng.integers(97, 99, int(rng.integers(0, 6))).tolist()) for _ in range(30)]
    anchors = [len(s) for s in segments]
    segments = [s + core + bytes(rng.integers(97, 99, int(rng.integers(4, 9))).tolist()) for s in segments]
    table, left = X.repeated_windows(segments, anchors, 6), max(anchors)
    for r, (s, a) in enumerate(zip(segments, anchors, strict=True)):
        for i in range(len(s) - 5):
            same = any(q != r and i - a + anchors[q] >= 0 and t[i - a + anchors[q]:][:6] == s[i:i + 6] for q, t in enumerate(segments))
            assert table[i - a + left, r] == same


def test_report_and_removal(spark):
    rng = random.Random(8)
    word = lambda k: "".join(rng.choices("abcdefgh é\n", k=k))
    passage = word(600)
    texts = [word(900), "start " + passage + " end", word(50) + passage, passage[:450], word(399), None, "", word(700)]
    texts.append(texts[0])
    rows = {r.doc_id: r for r in X.suffix_report(docs(spark, texts)).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (t, cut) in enumerate(zip(raw, brute(raw, 400), strict=True)):
        kept = X.kept_bytes(t, cut)
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, rows[i].kept_sha256) == (
            len(t), len(t) - len(kept), len(cut), hashlib.sha256(kept).hexdigest())
    assert rows[0].n_removed == len(raw[0]) and rows[7].n_removed == 0
    out = {r.doc_id: r for r in X.remove_repeats(docs(spark, texts)).collect()}
    for i, (t, cut) in enumerate(zip(raw, brute(raw, 400), strict=True)):
        text = None if texts[i] is None else X.kept_bytes(t, cut).decode("utf-8", "ignore")
        assert out[i].text == text and out[i].n_chars == (None if text is None else len(text))


def test_awkward_rows(spark):
    rows = X.suffix_report(awkward(spark)).collect()
    assert len(rows) == 10 and sorted(r.n_removed for r in rows)[-2:] == [80_000, 150_000]
    assert X.suffix_report(empty(spark)).count() == 0
    assert X.remove_repeats(awkward(spark)).columns == awkward(spark).columns
    twice = X.suffix_report(docs(spark, [(1, "q" + "z" * 10 + "w" * 500), (1, "q" + "z" * 10 + "w" * 500), (None, "v" * 401)])).collect()
    assert sorted(r.n_removed for r in twice) == [401, 511, 511]


def test_report_tells_words_of_shared_passages_below_400_bytes(spark):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(n))
    passage, own = words(55), words(60)
    assert len(passage) < 400 and len(own) > 200
    texts = [words(30) + " " + passage, passage + " " + words(9), own + " " + own, words(80), None]
    rows = {r.doc_id: r for r in X.suffix_report(docs(spark, texts)).collect()}
    assert all(rows[i].passage_words in (55, 56) and rows[i].n_removed == 0 for i in (0, 1))
    assert all(rows[i].passage_words == 0 for i in (2, 3, 4))


def test_report_reads_the_texts_once_for_both_searches(spark, monkeypatch):
    calls = []
    for name in ("_anchor_rows", "_anchor_hashes"):
        monkeypatch.setattr(X, name, lambda *a, f=getattr(X, name), name=name: calls.append(name) or f(*a))
    assert X.suffix_report(docs(spark, ["a" * 500, "b" * 250, "b" * 250])).count() == 3
    assert sorted(calls) == ["_anchor_hashes", "_anchor_rows"]


def test_spans_are_maximal_runs_whatever_the_batches(spark):
    rows = [(i, i % 3, 10 * j, 10 * j + width) for i in range(7) for j in range(40) for width in (3, 10 if j % 4 else 5, 4)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        out = X._merged(spark.createDataFrame(rows, X.SPAN_ROWS)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    expected = X.removed_runs([{"first": a, "after": b} for i, _, a, b in rows if i == 0])
    assert expected[:2] == [(0, 5), (10, 45)] and len(expected) == 11
    assert sorted((r.id, r.mark) for r in out) == [(i, i % 3) for i in range(7)]
    assert all([(s["first"], s["after"]) for s in r.spans] == expected for r in out)
    texts = ["start" + "xyz" * 300, "xyz" * 300 + "end"]
    assert [len(r.spans) for r in X.repeated_spans(docs(spark, texts)).collect()] == [1, 1]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    word = lambda k: bytes(rng.choices(b"abcdef \n", k=k))
    shared = word(700)
    texts = [word(90) + shared + word(300), b"", shared[100:], word(150), b"a" * 900, b"xy" * 450]
    for length, gram in ((200, 64), (400, 128), (64, 64)):
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        anchors, count = {}, 0
        for which, first, last, anchor, h in zip(*(x.tolist() for x in X.Anchors(length, gram).find(b"".join(texts), starts, ends)), strict=True):
            for place in range(first, last + 1):
                assert place <= anchor <= place + length - gram
                window = texts[which][place - starts[which]:][:length]
                assert len(window) == length and anchors.setdefault(window, (anchor - place, h)) == (anchor - place, h)
                count += 1
        assert count == sum(max(0, len(t) - length + 1) for t in texts)
