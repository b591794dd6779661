"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns of the input they must not matter.
CLASHING = ("id", "mark", "h", "segment", "print", "score", "size", "slice", "order", "target", "spans", "text_key",
            "own", "range", "role", "_key", "_spans", "taken", "component_id")


def docs(spark: SparkSession, texts: list, source: str | None = "s") -> DataFrame:
    """Documents 0, 1, ... with these texts (or (doc_id, text) pairs)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in rows], DOCS)


def awkward(spark: SparkSession) -> DataFrame:
    """Null and empty texts, a null id, repeated rows, a long text, odd code points, clashing columns."""
    texts = [None, "", "   \n\n ", "one", (4, "same text here"), (4, "same text here"), (None, "no id at all"),
             (6, "word " * 30_000), (7, "é😀\x00\u2028 ß" * 5), (8, "ab" * 40_000)]
    df = docs(spark, texts)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(1) for c in CLASHING})


def empty(spark: SparkSession) -> DataFrame:
    return docs(spark, [])
