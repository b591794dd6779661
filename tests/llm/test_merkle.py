import hashlib
import random

from shelfline.llm import merkle as K
from tests.llm.helpers import awkward, docs, empty


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) + rng.choice(["", "", ".", "\n", "\n\n"]) for _ in range(n))


def test_report_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(40)] + [None, "", "é😀" * 9, "same", "same", "x" * 300_000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = {r.doc_id: r for r in K.merkle_report(docs(spark, [(7 * i, texts[i]) for i in order])).collect()}
    phrases = K.Phrases()
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        r = rows[7 * i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == K.fingerprint(t.encode(), phrases) and r.edited_fingerprint == K.fingerprint(edited.encode(), phrases)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (t == after)
        if len(t) > 400 and len(after) > 400:
            assert r.near_edited > r.near_next + 0.2
    assert len({r.fingerprint for r in rows.values()}) == len({t or "" for t in texts})


def test_branches_locate_edits():
    rng = random.Random(4)
    lines = [f"line {i} {rng.random()}\n" for i in range(200)]
    a = "".join(lines).encode()
    lines[120] = "changed here\n"
    b = "".join(lines).encode()
    (first, after), = K.differing(a, b)
    assert b[first:after] == b"changed here\n"
    assert K.differing(a, a) == [] and K.differing(b"", b"") == []
    tree = K.tree(a)
    sections = [n for n in tree if n.level == "section"]
    assert sections[0].first == 0 and sections[-1].after == len(a)
    assert all(x.after == y.first for x, y in zip(sections, sections[1:], strict=False))
    same = {n.digest for n in K.tree(b) if n.level == "section"}
    assert sum(n.digest not in same for n in sections) <= 2


def test_nodes_table(spark):
    rows = K.merkle_nodes(docs(spark, ["a\nb\n\nc", None])).collect()
    root = {r.doc_id: r for r in rows if r.level == "root"}
    assert root[0].after == 6 and root[1].after == 0 and sum(r.level == "paragraph" for r in rows) == 4


def test_awkward_rows(spark):
    assert K.merkle_report(awkward(spark)).count() == 10
    assert K.merkle_report(empty(spark)).count() == 0 and K.fingerprints(empty(spark)).count() == 0
    alone = K.merkle_report(docs(spark, ["just me"])).first()
    assert alone.near_next == 1 and alone.n_chars == 7
    lost = K.merkle_report(docs(spark, [(None, "a"), (None, "b")])).collect()
    assert len(lost) == 2 and {r.near_next for r in lost} == {0.0}


def test_likeness_counts_every_branch(spark):
    """One edited phrase of a long text, one section that two long texts share, and brute force over phrases."""
    from collections import Counter
    rng = random.Random(8)
    long = [[f"{rng.random()} {rng.random()} and {rng.random()} here {rng.random()}.\n" for _ in range(600)] for _ in range(2)]
    phrases = K.Phrases()

    def brute(a, b):
        def leaves(t):
            ends = phrases.digests(t)[0].tolist()
            return Counter(t[x:y] for x, y in zip([0, *ends], ends, strict=False))
        same = sum(len(p) * n for p, n in (leaves(a) & leaves(b)).items())
        return 1.0 if a == b else same / (len(a) + len(b) - same + 1)

    pairs = []
    for place in range(0, 600, 60):
        edited = long[0].copy()
        edited[place] = "edited here\n"
        pairs.append(("".join(long[0]), "".join(edited)))
    pairs.append(("".join(long[0]), "".join(long[1][:300] + long[0][100:130] + long[1][300:])))
    pairs += [("a b c\nd e f\n", "d e f\na b c\n"), ("", "x"), (prose(rng, 400), prose(rng, 400))]
    for a, b in pairs:
        rows = {r.doc_id: r for r in K.merkle_report(docs(spark, [(1, a), (2, b)])).collect()} if a in pairs[0] else {}
        expected = brute(a.encode(), b.encode())
        found = rows[1].near_next if rows else K.likeness(K.Tree(a.encode(), phrases), K.Tree(b.encode(), phrases))
        assert abs(found - expected) < 1e-12 and found < 1
    assert 0.02 < brute(*(t.encode() for t in pairs[10])) < 0.06
    nodes = K.merkle_nodes(docs(spark, [pairs[0][0]])).collect()
    leaf = sorted((r.first, r.after) for r in nodes if r.level == "phrase")
    assert leaf[0][0] == 0 and leaf[-1][1] == len(pairs[0][0]) and all(x[1] == y[0] for x, y in zip(leaf, leaf[1:], strict=False))
