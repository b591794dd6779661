import hashlib
import random
import re

from shelfline.llm import decontaminate as D
from tests.llm.helpers import awkward, docs, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = norm(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = norm(t), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= ids - {None}
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def fixture():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "Ab"]
    some = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, some(rng.randint(13, 20))) for i in range(12)] + [(20, "Ab w1 É"), (21, "w5 w5"), (22, None), (3, some(14)), (23, "..")]
    texts = [some(rng.randint(0, 80)) for _ in range(20)] + [
        some(30) + ". " + items[i][1].upper() + "!" + some(200) for i in range(4)] + [None, "", "ab W1, É", "W5-w5"]
    return texts, items


def test_report_equals_brute_force_in_one_and_many_blocks(spark):
    texts, items = fixture()
    items += [(None, "w1 w2"), (None, "w3 É"), (24, "w3 É")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 5):
        found = {r.doc_id: r for r in D.benchmark_hits(docs(spark, texts), bench, block=block).collect()}
        assert len(found) == len(texts)
        for i, (n, hit, count, _, _) in enumerate(brute(texts, [x for x in items if x[1]])):
            assert (found[i].n_words, found[i].n_hit, len(found[i].items)) == (n, hit, count)
    rows = {r.doc_id: r for r in D.contamination_report(docs(spark, texts), bench).collect()}
    expected = brute(texts, [x for x in items if x[1]])
    assert [(rows[i].n_words, rows[i].n_hit, rows[i].n_items, rows[i].items_sha256, rows[i].contaminated)
            for i in range(len(texts))] == expected
    for block in (10**6, 5):
        kept = {r.doc_id for r in D.remove_contaminated(docs(spark, texts), bench, block=block).collect()}
        assert kept == {i for i, e in enumerate(expected) if not e[4]}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "one"), (2, "same text here")], "item_id long, text string")
    rows = D.contamination_report(awkward(spark), bench).collect()
    assert len(rows) == 10 and sum(r.contaminated for r in rows) == 3
    many = D.benchmark_hits(awkward(spark), bench, block=1).collect()
    assert len(many) == 10 and sum(r.n_hit > 0 for r in many) == 3
    assert D.remove_contaminated(awkward(spark), bench).columns == awkward(spark).columns
    assert D.contamination_report(empty(spark), bench).count() == 0
    assert not any(r.contaminated for r in D.contamination_report(awkward(spark), bench.where("false")).collect())


def test_removal_in_many_blocks_judges_rows(spark):
    """Repeated, null and reused ids: each row by its own text, whatever the number of blocks."""
    texts, items = fixture()
    bad = [e[4] for e in brute(texts, [x for x in items if x[1]])]
    dirty, clean = (next(t for t, b in zip(texts, bad, strict=True) if b == want and t) for want in (True, False))
    rows = [(None, dirty), (None, clean), (None, None), (1, dirty), (1, clean), (2, dirty), (2, dirty), (3, clean), (3, clean)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = {block: sorted(((r.doc_id, r.text) for r in D.remove_contaminated(docs(spark, rows), bench, block=block).collect()), key=str)
            for block in (10**6, 5, 1)}
    expected = sorted([r for r in rows if r[1] != dirty], key=str)
    assert left == {10**6: expected, 5: expected, 1: expected}
    assert D.remove_contaminated(awkward(spark), bench, block=1).count() == D.remove_contaminated(awkward(spark), bench).count()
    assert D.remove_contaminated(awkward(spark), bench, block=1).columns == awkward(spark).columns


def test_items_of_any_id_type(spark):
    texts = ["a b c", "d e f", "g h"]
    bench = spark.createDataFrame([("z-1", "b c"), ("é", "b c"), (None, "e f"), ("q", "b c"), ("q", "B, C")], "item_id string, text string")
    rows = {r.doc_id: r for r in D.contamination_report(docs(spark, texts), bench).collect()}
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert (rows[0].n_hit, rows[0].n_items, rows[0].items_sha256) == (2, 3, digest(["q", "z-1", "é"]))
    assert (rows[1].n_hit, rows[1].n_items, rows[1].items_sha256, rows[1].contaminated) == (2, 0, digest([]), True)
    assert rows[2].n_hit == 0
    kept = {r.doc_id for r in D.remove_contaminated(docs(spark, texts), bench).collect()}
    assert kept == {2} == {r.doc_id for r in D.remove_contaminated(docs(spark, texts), bench, block=1).collect()}


def test_one_passage_in_many_items():
    index = D.WindowIndex(13)
    for i in range(20_000):
        index.add(str(i), b"the same question")
    assert index.count == 20_000 and len(index.close().scan([b"is the same question"])[0][2]) == 20_000
