"""Source divergence audit: how far the word use of the sources of a language lies
apart, and which words set a source off.  Gustavson's row accumulation: each source
scatters its terms through the term-major index into a dense accumulator with one
place per peer; terms that a side lacks have a baseline, which is corrected for."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored, task_count, utf8

#: Documents of a language that must hold a term for it to be kept.
MIN_DOCS = 10
#: Ranks of the terms of a source.
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Entries that a task counts before it hands them on.
HELD_TERMS = 300_000
#: Postings of the index that one task works on at a time.
CELL_POSTINGS = 500_000

COUNT_SCHEMA = "lang string, source string, term string, count long, docs long"
CELL_SCHEMA = "lang string, part string, source string, item string, value long"


def _letter_table() -> bytes:
    out = bytearray(range(256)).lower()
    for b in [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]:
        out[b] = 0x20
    return bytes(out)


#: Lower-cases A-Z and turns every other ASCII byte that is no letter into a space.
LETTER_TABLE = _letter_table()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents of every term of each
    (lang, source), and a row without term for each such group.

    Null text, lang and source count as empty.  Each task sums first, so a hot source or
    word leaves a task as one row for every HELD_TERMS entries counted there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = utf8(batch, "text")
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                counts, seen = groups.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(text.translate(LETTER_TABLE).split())
                held -= len(seen)
                counts.update(own)
                seen.update(own.keys())
                held += len(seen)
                if held >= HELD_TERMS:
                    yield _count_batch(groups)
                    groups, held = {}, 0
        yield _count_batch(groups)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                        F.col("text").cast("string"))
    return plain.mapInArrow(count, COUNT_SCHEMA).groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _count_batch(groups: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
    langs, sources, terms, counts, docs = [], [], [], [], []
    for (lang, source), (own, seen) in groups.items():
        langs += [lang] * (len(own) + 1)
        sources += [source] * (len(own) + 1)
        terms += [None, *own]
        counts += [0, *own.values()]
        docs += [0, *(seen[t] for t in own)]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
         pa.array(counts, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "count", "docs"])


def term_index(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The term-major index: lang, term, total (occurrences) and postings (source, count)
    of the terms that at least ``min_docs`` documents of the language hold.  A term
    has one posting per source at most."""
    return (counts.where("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("count").alias("total"), F.sum("docs").alias("docs"),
                 F.collect_list(F.struct("source", "count")).alias("postings"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def group_sizes(counts: DataFrame, index: DataFrame) -> DataFrame:
    """lang, source, n (occurrences of kept terms), terms (kept terms of the language) and
    lang_n, for every group of ``counts``, also one without terms."""
    sizes = index.select("lang", F.explode("postings").alias("p")).groupBy("lang", "p.source").agg(F.sum("p.count").alias("n"))
    langs = index.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    zero = F.lit(0)
    return (counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("terms", zero).alias("terms"),
                    F.coalesce("lang_n", zero).alias("lang_n")))


def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / whole) without overflow, three digits at a time;
    count + 2 is at most ``whole``, which may have 15 digits."""
    left = np.asarray(count, np.int64) + 2
    out = np.zeros_like(left)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // whole
        left = left % whole
    return out + 1


def unlikeness(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square fits."""
    d = p - q
    return d * d // (p + q)


class Cell:
    """A part of a language's index, with the sizes of all its sources.

    ``value(g, h)`` of two sources, over the terms of the cell, is directed(g, h) +
    directed(h, g) of ``row``: each row has its own terms against the peers' baselines,
    less one baseline pair per own term; the row of the first source also has one
    baseline pair for every term and, for shared terms, what puts them right.
    """

    def __init__(self, sources: list[str], n: list[int], kept: int, lang_n: int, terms: list[str], totals: list[int],
                 lengths: list[int], posting_source: np.ndarray, posting_count: np.ndarray):
        self.sources, self.terms = sources, terms
        whole = np.array(n, np.int64) + 2 * kept
        self.from_ = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))
        self.source, self.term = posting_source, np.repeat(np.arange(len(terms)), lengths)
        if kept:
            self.base = share(np.zeros(len(n), np.int64), whole)
            self.p = share(posting_count, whole[posting_source])
            self.q = share(np.array(totals, np.int64), np.full(len(totals), lang_n + 2 * kept, np.int64))
        else:
            self.base = np.ones(len(n), np.int64)
            self.p = self.q = np.zeros(0, np.int64)
        order = np.argsort(posting_source, kind="stable")
        self.rows = np.split(order, np.searchsorted(posting_source[order], np.arange(1, len(sources))))

    def row(self, g: int) -> np.ndarray:
        """The accumulator of source ``g``, one place per peer."""
        own, base = self.rows[g], self.base
        none = unlikeness(base[g], base)
        out = -len(own) * none
        values, times = np.unique(self.p[own], return_counts=True)
        for p, k in zip(values, times):
            out += k * unlikeness(p, base)
        out[g + 1:] += len(self.terms) * none[g + 1:]
        terms = self.term[own]
        n = self.from_[terms + 1] - self.from_[terms]
        at = np.repeat(self.from_[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        mine = np.repeat(self.p[own], n)
        later = self.source[at] > g
        at, mine = at[later], mine[later]
        peer, theirs = self.source[at], self.p[at]
        np.add.at(out, peer, unlikeness(mine, theirs) - unlikeness(mine, base[peer]) - unlikeness(base[g], theirs) + none[peer])
        out[g] = 0
        return out

    def top_terms(self, ranks: int) -> Iterator[tuple[int, int, int]]:
        """(source, term, value) of the best terms of every source that are above the
        language's share; terms stand in UTF-8 order."""
        q = self.q[self.term]
        above = np.flatnonzero(self.p > q)
        value, source, term = unlikeness(self.p[above], q[above]), self.source[above], self.term[above]
        order = np.lexsort((term, -value, source))
        first = np.searchsorted(source[order], source[order])
        for i in order[np.arange(len(order)) - first < ranks]:
            yield int(source[i]), int(term[i]), int(value[i])


def _cell(rows: pa.Table) -> Cell:
    """Rows of one cell: the sources first, then the terms, both in UTF-8 order."""
    term = rows.column("term").combine_chunks()
    sources = rows.filter(term.is_null())
    terms = rows.filter(term.is_valid())
    postings = terms.column("postings").combine_chunks()
    flat = postings.flatten()
    names = sources.column("source").combine_chunks()
    return Cell(
        names.to_pylist(), sources.column("n").to_pylist(), sources.column("terms")[0].as_py(), sources.column("lang_n")[0].as_py(),
        terms.column("term").to_pylist(), terms.column("total").to_pylist(), postings.value_lengths().to_pylist(),
        np.asarray(pa.compute.index_in(flat.field("source"), names), np.int64), np.asarray(flat.field("count"), np.int64))


def _cell_rows(batches: Iterator[pa.RecordBatch], ranks: int) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in CELL_SCHEMA.split(", ")]

    def worked(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = _cell(pa.Table.from_batches(parts))
        k = len(cell.sources)
        all_sources = pa.array(cell.sources, pa.string())
        for g in range(k):
            peers = np.delete(np.arange(k), g)
            low, high = np.minimum(peers, g), np.maximum(peers, g)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * (k - 1), pa.string()), pa.array(["pair"] * (k - 1), pa.string()),
                 all_sources.take(pa.array(low)), all_sources.take(pa.array(high)), pa.array(cell.row(g)[peers], pa.int64())], names)
        top = list(cell.top_terms(ranks))
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(top), pa.string()), pa.array(["term"] * len(top), pa.string()),
             pa.array([cell.sources[s] for s, _, _ in top], pa.string()), pa.array([cell.terms[t] for _, t, _ in top], pa.string()),
             pa.array([v for _, _, v in top], pa.int64())], names)

    key, parts = None, []
    for batch in batches:
        keys = list(zip(batch.column("lang").to_pylist(), batch.column("cell").to_pylist()))
        start = 0
        for i in range(len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if parts and keys[start] != key:
                yield from worked(key, parts)
                parts = []
            if i > start:
                key = keys[start]
                parts.append(batch.slice(start, i - start))
            start = i
            if i == len(keys):
                break
    if parts:
        yield from worked(key, parts)


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
                cell_postings: int = CELL_POSTINGS) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair``: every other source of the
    language with the unlikeness of the two, summed over all kept terms; part ``term``:
    the ``top_terms`` kept terms that stand above the language's share.

    Terms are runs of letters with A-Z in lower case; a language keeps those in at least
    ``min_docs`` of its documents.  Shares are whole numbers (count + 2 over the size
    plus 2 per kept term, in units of 1e-9), so all sums are exact.  Null text, lang and
    source count as empty; groups without terms have pairs too; repeated rows count
    repeatedly; an empty table gives no row; other columns are not read.

    The index of a language is dealt into cells by a hash of the term, so neither a
    hot source nor a hot language is one task; a cell also gets the sizes of the
    language's sources, and gives one row per pair of sources.
    """
    spark = docs.sparkSession
    counts = stored(term_counts(docs), "divergence-counts")
    index = stored(term_index(counts, min_docs), "divergence-index")
    sizes = stored(group_sizes(counts, index), "divergence-groups")
    postings = index.agg(F.sum(F.size("postings"))).first()[0] or 0
    cells = max(1, -(-postings // cell_postings))
    terms = index.select("lang", F.pmod(F.xxhash64("term"), F.lit(cells)).cast("long").alias("cell"), F.lit("").alias("source"),
                         F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("terms"), F.lit(0).cast("long").alias("lang_n"),
                         "term", "total", "postings")
    groups = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)).cast("array<long>")).alias("cell"), "source",
                          F.col("n").cast("long"), F.col("terms").cast("long"), F.col("lang_n").cast("long"),
                          F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("total"),
                          F.array().cast("array<struct<source:string,count:bigint>>").alias("postings"))
    dealt = groups.unionByName(terms).repartition(task_count(spark), "lang", "cell").sortWithinPartitions(
        "lang", "cell", F.col("term").asc_nulls_first(), "source")
    worked = stored(dealt.mapInArrow(lambda b: _cell_rows(b, top_terms), CELL_SCHEMA), "divergence-cells")
    pairs = worked.where("part = 'pair'").groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", "part", "value", F.explode(F.array(
        F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("pair"))
    rows = both.select("lang", "pair.source", "part", "pair.item", "value").unionByName(
        worked.where("part = 'term'").select("lang", "source", "part", "item", "value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(best)).where((F.col("part") == "pair") | (F.col("rank") <= top_terms))


def divergence_report(docs: DataFrame) -> DataFrame:
    """op13: pairs of sources and top terms of every language."""
    return divergences(docs)


#: The same in DuckDB SQL, by plain dense tables.
REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT groups.lang, groups.source, kept.term, kept.total, coalesce(c.n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n,
             CAST(1 + 1000000000::hugeint * (n + 2) // (sum(n) OVER s + 2 * count(*) OVER s) AS bigint) AS p,
             CAST(1 + 1000000000::hugeint * (total + 2) // (sum(total) OVER s + 2 * count(*) OVER s) AS bigint) AS q
      FROM g WINDOW s AS (PARTITION BY lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS bigint) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS integer) AS rank FROM r)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
