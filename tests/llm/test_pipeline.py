import corpus_pipeline as P
from shelfline.llm import decontaminate, mixing, quality, simhash, suffix
from tests.conftest import SF001
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_print, brute_roots
from tests.llm.test_suffix import brute as brute_repeats


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "simhash near-dedup", "suffix-array dedup", "benchmark decontamination",
                                        "mixing to target weights"]
    assert P.ORACLE_SQL is None


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    model = quality.fit(docs)
    rows = sorted(r for r in docs.collect() if model.score(quality.signals((r.text or "").encode())) >= model.threshold)
    roots = brute_roots([brute_print(r.text) for r in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    raw = [(r.text or "").encode() for r in rows]
    texts = [suffix.kept_bytes(t, [(a, b) for a, b in cut if len(t[a:b].split()) >= 50]).decode("utf-8", "ignore")
             for t, cut in zip(raw, brute_repeats(raw, 200, across=True), strict=True)]
    hits = brute_hits(texts, bench)
    left = [(r.doc_id, t, r.lang, r.source, len(t)) for r, t, h in zip(rows, texts, hits, strict=True) if not h[4]]
    assert 0 < len(left) < len(rows) <= docs.count()

    out = P.run(spark, SF001).collect()
    expected = {r[0]: r for r in left}
    assert all(tuple(r[:5]) == expected[r.doc_id] for r in out)
    _, target = brute_targets(left)
    for source, goal in target.items():
        assert abs(sum(r.mix_words for r in out if r.source == source) - goal) <= 1
    assert [r.mix_position for r in out] == sorted(r.mix_position for r in out)


def test_each_stage_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF001).schema.names == docs.columns, name
    assert {decontaminate, mixing, simhash}
