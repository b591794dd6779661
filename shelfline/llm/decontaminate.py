"""Benchmark decontamination: windows of normalised benchmark words as a broadcast
hash set, a scan over the words of every document, hits verified word by word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import broadcast_object, chunks, runs, stored, utf8, words

WINDOW = 13
HIT_SCHEMA = (
    "doc_id long, text_key long, n_words long, "
    "spans array<struct<first:long,after:long>>, items array<string>"
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WindowIndex:
    """Windows of benchmark items by length: word numbers as bytes to item ids (none
    for an item without id), and a sorted array of their hashes.  The rows of an item
    are added one after another."""

    def __init__(self, size: int):
        self.size = size
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, list[str]]] = {}
        self.hashes: dict[int, np.ndarray] = {}
        self.count = 0

    def add(self, item_id: str | None, text: bytes) -> None:
        tokens = words(text)
        ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens], np.int32)
        n = min(self.size, len(tokens))
        table = self.windows.setdefault(n, {}) if n else {}
        for i in range(len(ids) - n + 1 if n else 0):
            key = ids[i : i + n].tobytes()
            if (have := table.get(key)) is None:
                have = table[key] = []
                self.count += 1
            if item_id is not None and have[-1:] != [item_id]:
                have.append(item_id)
                self.count += len(have) > 1

    def close(self) -> WindowIndex:
        for n, table in self.windows.items():
            rows = np.frombuffer(b"".join(table), np.int32).reshape(-1, n)
            self.hashes[n] = np.unique(self._hash(rows))
        return self

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            h = (h + column.astype(np.uint64)) * _BASE
            h ^= h >> np.uint64(29)
        return h

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: number of words, runs of hit words, items with an occurring window."""
        get = self.vocabulary.get
        ids: list[int] = []
        starts, sizes = [], []
        for t in texts:
            tokens = words(t)
            starts.append(len(ids))
            sizes.append(len(tokens))
            ids += [get(w, 0) for w in tokens]
            ids.append(0)
        at = np.array(ids, np.int32)
        known = np.concatenate(([0], np.cumsum(at > 0)))
        edge = np.zeros(len(at) + 1, np.int32)
        begin = np.array(starts)
        items: list[set[str]] = [set() for _ in texts]
        for n, table in self.windows.items():
            places = np.flatnonzero(known[n:] - known[:-n] == n)
            for part in np.array_split(places, len(places) // 100_000 + 1):
                rows = at[part[:, None] + np.arange(n)]
                for p in part[np.isin(self._hash(rows), self.hashes[n])].tolist():
                    found = table.get(at[p : p + n].tobytes())
                    if found is not None:
                        edge[p] += 1
                        edge[p + n] -= 1
                        items[int(np.searchsorted(begin, p, "right")) - 1].update(found)
        first, after = runs(np.cumsum(edge[:-1]) > 0)
        doc = np.searchsorted(begin, first, "right") - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for d, a, b in zip(doc.tolist(), first.tolist(), after.tolist(), strict=True):
            spans[d].append((a - starts[d], b - starts[d]))
        return [(n, s, sorted(i)) for n, s, i in zip(sizes, spans, items, strict=True)]


def _indexes(benchmark: DataFrame, size: int, block: int) -> Iterator[WindowIndex]:
    """The benchmark in blocks of about ``block`` windows, read item by item."""
    index = WindowIndex(size)
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for r in rows.where("text is not null").orderBy("item_id", "text").toLocalIterator():
        index.add(r.item_id, r.text.encode("utf-8"))
        if index.count >= block:
            yield index.close()
            index = WindowIndex(size)
    yield index.close()


def _scan(docs: DataFrame, index: WindowIndex) -> DataFrame:
    shared = broadcast_object(docs.sparkSession, index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
        for batch in batches:
            texts = utf8(batch, "text")
            found = [r for a, b in chunks(texts, 4 << 20) for r in shared().scan(texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([r[0] for r in found], pa.int64()),
                 pa.array([[{"first": a, "after": b} for a, b in r[1]] for r in found], span),
                 pa.array([r[2] for r in found], pa.list_(pa.string()))],
                ["doc_id", "text_key", "n_words", "spans", "items"])

    return docs.mapInArrow(scan, HIT_SCHEMA)


def _union_length(spans: Column) -> Column:
    """Words in the union of ordered spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), s["after"] - F.greatest(s["first"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["after"]).alias("end"))
    return F.aggregate(spans, zero, step, lambda a: a["n"])


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans of hit words, items
    (ids, as strings, of items with an occurring window, ascending).

    A window is ``size`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  Null texts have no words.  The windows of an
    item without id hit like others, but there is no id to name; item ids may be of
    any type that has a string form.  Repeated rows are scanned each.  Documents are read
    once per ``block`` benchmark windows and not shuffled; what is broadcast
    never exceeds a block.  With several blocks a document's hits are merged by
    doc_id and text.
    """
    return _merged([_scan(_keyed(docs), index) for index in _indexes(benchmark, size, block)])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Hits of the blocks put together by document."""
    if len(parts) == 1:
        found = parts[0]
    else:
        rows = reduce(DataFrame.unionByName, parts)
        found = (
            rows.groupBy("doc_id", "text_key", "n_words")
            .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                 (F.count("*") / len(parts)).cast("int").alias("rows"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "rows")))
        )
    return found.select("doc_id", "n_words", _union_length(F.col("spans")).alias("n_hit"), "spans", "items")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """op5: hit words and items of every document; n_items and the digest are those of
    the items with an id."""
    return benchmark_hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def _without(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The documents but those whose hits, at most one row a block for each
    doc_id and text, make them contaminated."""
    bad = (
        hits.groupBy("doc_id", "text_key", "n_words").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
        .where(contaminated(_union_length(F.col("spans")), F.col("n_words"))).select("doc_id", "text_key")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.xxhash64(F.col("text").cast("string")).alias("row_text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = rows["row_id"].eqNullSafe(bad["doc_id"]) & (rows["row_text"] == bad["text_key"])
    return rows.join(bad, same, "left_anti").select("row.*")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = 2_000_000) -> DataFrame:
    """The documents (all their columns) that are not contaminated; the others go.
    Null and empty texts stay, and so does everything if the benchmark has no words.

    Each row is judged by its own text.  A benchmark of one block is looked up
    while the documents pass, without a shuffle.  With several blocks the
    documents are read once a block, one block after another (the driver holds
    one at a time), and the contaminated pairs of doc_id and text are joined."""
    blocks = _indexes(benchmark, size, block)
    index = next(blocks)
    if index.count >= block:  # others may follow
        parts = []
        while index is not None:
            found = _scan(_keyed(docs), index).where(F.size("spans") > 0)
            parts.append(stored(found.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "n_words", "spans"), "block-hits"))
            index = None
            index = next(blocks, None)
        return _without(docs, reduce(DataFrame.unionByName, parts))
    shared = broadcast_object(docs.sparkSession, index)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "text")
            found = [r for a, b in chunks(texts, 4 << 20) for r in shared().scan(texts[a:b])]
            hits = [sum(b - a for a, b in spans) for _, spans, _ in found]
            yield batch.filter(pa.array([not (h and 20 * h >= r[0]) for h, r in zip(hits, found, strict=True)], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


REPORT_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS key
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS key
  FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT doc_id, i, place.n, item_id FROM place JOIN win USING (key, n)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
