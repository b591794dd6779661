import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfline.llm import divergence
from tests.llm.helpers import DOCS, awkward, empty


def brute(rows, min_docs, top):
    found, docs = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for _, lang, source in rows})
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            whole = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // whole for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        p = {s: shares(found[lang, s]) for s in sources}
        q = shares(sum((found[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s)
            terms = sorted((-f(p[s][t], q[t]), t) for t in kept if found[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, t) in enumerate(terms[:top])]
    return sorted(out)


@pytest.mark.parametrize("cell,held", [(10**6, 10**6), (15, 20)])
def test_equals_brute_force(spark, monkeypatch, cell, held):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rng = random.Random(4)
    vocabulary = ["The", "cat", "Été", "dog2bark", "x-y", "Straße", "rare", "sun", "Moon", "\U0001f600", "￮"]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))), rng.choice(["en", "de", None, ""]),
             rng.choice(["a", "b", "c", None, "é", "hot", "hot", "hot"])) for _ in range(250)]
    rows += [("only one document", "xx", "s1"), (None, "xx", "s2"), ("1 2 3", "xx", None), ("alone " * 9, "yy", "s")]
    df = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS)
    got = sorted(tuple(r) for r in divergence.divergences(df, min_docs=4, top_terms=3, cell_postings=cell)
                 .select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == brute(rows, 4, 3)


def test_shares_are_exact_for_large_counts():
    whole = 10**15 + 7
    counts = [0, 1, 10**15, 123_456_789_012_345]
    assert divergence.share(np.array(counts), np.full(4, whole)).tolist() == [1 + 10**9 * (c + 2) // whole for c in counts]


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    assert divergence.divergence_report(empty(spark)).count() == 0
    df = awkward(spark).withColumns({"source": F.concat(F.lit("s"), F.col("doc_id") % 3), "term": F.lit("x"), "count": F.lit(2)})
    rows = divergence.divergences(df, min_docs=1).collect()
    assert {r.source for r in rows} == {"", "s0", "s1", "s2"} and sum(r.part == "pair" for r in rows) == 12
