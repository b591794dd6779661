import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shelfline.llm import simhash as S
from shelfline.llm.components import components
from tests.llm.helpers import awkward, docs, empty


def brute_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(prints, threshold=2):
    """Index of the smallest member of each component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= threshold:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_golay_cells_hold_all_near_words():
    code = S.CoveringCode(2)
    assert [(e >= 0).sum() for e in code.errors][0] == 2048  # a perfect code
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    bits = rng.integers(0, 64, (2, 500)).astype(np.uint64)
    y = x ^ (np.uint64(1) << bits[0]) ^ (np.uint64(1) << bits[1])
    home = {int(p): int(a) for anchors, prints, own in code.anchors(x) if own for a, p in zip(anchors, prints, strict=True)}
    cells = {}
    for anchors, prints, _ in code.anchors(y):
        for a, p in zip(anchors, prints, strict=True):
            cells.setdefault(int(p), []).append(int(a))
    assert all(home[int(a)] in cells[int(b)] for a, b in zip(x, y, strict=True))
    assert all(len(c) == len(set(c)) for c in cells.values())


def _clusters():
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0]
    for _ in range(8):  # chains and balls of near words
        p = rng.getrandbits(64)
        for _ in range(40):
            q = p
            for _ in range(rng.randint(1, 2)):
                q ^= 1 << rng.randrange(64)
            prints.append(q)
            if rng.random() < 0.5:
                p = q
    return list(dict.fromkeys(prints))


def test_links_connect_what_brute_force_connects(spark):
    prints = _clusters()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    expected = brute_roots(prints)
    for crowded in (10**6, 1):
        links = S.near_links(df, crowded=crowded).collect()
        assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 for r in links)
        assert len(links) <= 70 * len(prints)
        roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        groups = {}
        for p, e in zip(signed, expected, strict=True):
            groups.setdefault(e, set()).add(roots.get(p, p))
        assert all(len(g) == 1 for g in groups.values()) and len({g.pop() for g in groups.values()}) == len(groups)


def test_report_equals_brute_force(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choices(["Alpha", "beta", "c", "d", "éé"], k=rng.randint(0, 60))) for _ in range(25)]
    texts = base + [t.upper() for t in base[:10]] + [t + " tail" for t in base[:10]] + [None, "", "one two", "one\x1ctwo \x0b x"]
    out = {r.doc_id: r for r in S.simhash_report(docs(spark, [(3 * i, t) for i, t in enumerate(texts)])).collect()}
    prints = [brute_print(t) for t in texts]
    assert [out[3 * i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [out[3 * i].component_id for i in range(len(texts))] == [3 * x for x in brute_roots(prints)]
    kept = {r.doc_id for r in S.drop_near_duplicates(docs(spark, [(3 * i, t) for i, t in enumerate(texts)])).collect()}
    assert kept == {3 * x for x in brute_roots(prints)}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    odd = [(5000, 5000), (None, 1), (7, None), (2001, 2000), (2001, 2000)]
    df = spark.createDataFrame([*chain, *star, *odd], "a long, b long")
    roots = {r.node: r.root for r in components(df).collect()}
    assert {roots[i] for i in range(301)} == {0} and {roots[1000 + i] for i in range(200)} == {1000}
    assert roots[2001] == 2000 and 5000 not in roots
    assert components(df.where(F.lit(False))).count() == 0


def test_awkward_rows(spark):
    rows = S.simhash_report(awkward(spark)).collect()
    assert len(rows) == 10
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {0} and len(zero) >= 3
    assert S.simhash_report(empty(spark)).count() == 0
    assert S.drop_near_duplicates(awkward(spark)).columns == awkward(spark).columns
    nobody = S.simhash_report(docs(spark, [(None, "a b c d"), (None, "a b c d")])).collect()
    assert [r.component_id for r in nobody] == [None, None]


def test_one_row_of_each_component_stays(spark):
    """Repeated rows, null ids and reused ids, with texts above 400 bytes, here and in the next stage."""
    from shelfline.llm import suffix
    rng = random.Random(12)
    text = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(90)) for _ in range(6)]
    near = text[4].upper()
    assert brute_print(text[4]) == brute_print(near)
    rows = [(1, text[0])] * 3 + [(None, text[1])] * 3 + [(7, text[2]), (None, text[2])] + [(9, text[3]), (9, text[4]), (3, near), (5, text[5])]
    out = S.drop_near_duplicates(docs(spark, rows))
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(kept, key=str) == sorted([(1, text[0]), (None, text[1]), (7, text[2]), (9, text[3]), (3, near), (5, text[5])], key=str)
    left = suffix.remove_repeats(out).collect()
    assert sorted(r.text for r in left) == sorted(t for _, t in kept)


def test_repeated_rows_of_awkward_tables(spark):
    df = awkward(spark)
    kept = S.drop_near_duplicates(df).collect()
    assert len(kept) == len({r.component_id if r.doc_id is not None else r.fingerprint for r in S.simhash_report(df).collect()})
    assert S.drop_near_duplicates(empty(spark)).count() == 0
