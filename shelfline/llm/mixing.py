"""Mixing sources to target weights by a time-varying curriculum: each source's
weight schedule is integrated into its cumulative token demand, the demand is
inverted to give every document copy a training position, and documents are
range-sorted by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored

#: Source weights by code point order of the sources, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
REPEATS = 3
#: Rate of a source in each quarter of training, by weight: rare sources come
#: late, heavy ones early.  Each row's mean is 1, so a source's total stays its target.
SCHEDULE = ((0.4, 0.8, 1.2, 1.6), (1.0, 1.0, 1.0, 1.0), (1.3, 1.1, 0.9, 0.7))
#: Leading digits of a document's digest that name its slice: the parts (4,096) of a
#: source whose sizes are summed apart before they are put in a row.
SLICE_DIGITS = 3
#: Wholly equal documents that share a place in the order.
BLOCK = 1024


def text_size(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size (from ``totals``) with weight_class and target.

    Sources by code point, null last, weigh ``weights`` in turn and share the
    whole size; a target stops at ``repeats`` times its source's size and the
    excess is shared again by weight until none is above.  That is target =
    min(limit, weight * level): sources that reach their limit first (by limit /
    weight) are set, the level is what is left over the weights left.  One row
    per source goes through the windows, never documents.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    done = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    return (
        totals.withColumn("weight_class", (F.row_number().over(by_source) - 1) % len(weights))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("weight_class") + 1))
        .withColumn("limit", F.col("source_size") * float(repeats))
        .withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(done), zero))
                    / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(done), zero)))
        # along that order the level rises while sources reach their limits and falls after: its top is the fill level
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least(F.col("limit"), F.col("weight") * F.coalesce("level", zero)))
        .select("source", "source_size", "weight_class", "target")
    )


def _position(share: Column, weight_class: Column, schedule: Sequence[Sequence[float]]) -> Column:
    """The time (0 to 1) at which a source has met ``share`` of its demand: the
    inverse of the integral of its piecewise constant rate."""
    out = None
    for k, rates in enumerate(schedule):
        step, end, own = 1.0 / len(rates), 0.0, None
        pieces = []
        for i, r in enumerate(rates):
            pieces.append((end, end + r * step, i * step, r))
            end += r * step
        for low, _, time, r in reversed(pieces):
            at = (F.lit(time) + (share - low) / r)
            own = at if own is None else F.when(share < pieces[int(round(time / step))][1], at).otherwise(own)
        out = own if out is None else F.when(weight_class == k, own).otherwise(out)
    return F.least(F.lit(1.0), out)


def _row_key(text: Column, *others: Column) -> Column:
    """Digest of a row's text (null as empty) and other columns."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat_ws(":", digest, F.md5(F.to_json(F.struct(*others))))) if others else digest


def _placed(docs: DataFrame, key: Column, weights: Sequence[float], repeats: int) -> DataFrame:
    """Equal documents as blocks of up to ``BLOCK``: doc_id, source, size, key, n (documents
    of the block), start (words of the source before the block), source_size, target, weight_class."""
    text = F.col("text").cast("string")
    equal = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"), text_size(text).alias("size"),
        _row_key(text).alias("text_key"), key.alias("key"),
    ).groupBy("doc_id", "source", "size", "text_key", "key").agg(F.count("*").alias("n"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key", F.col("block").cast("string"))
    blocks = (
        stored(equal, "mix-sizes")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))))
        .withColumn("n", F.least(F.lit(BLOCK).cast("long"), F.col("n") - F.col("block") * BLOCK))
        .withColumn("order", F.md5(name))
        .withColumn("slice", F.substring("order", 1, SLICE_DIGITS))
        .withColumn("words", F.col("size") * F.col("n"))
    )
    sums = blocks.groupBy("source", "slice").agg(F.sum("words").alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("slice_from", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    targets = source_targets(sums.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, repeats)
    inside = Window.partitionBy("source", "slice").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    o, t = offsets.alias("o"), targets.alias("t")
    return (
        blocks.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).alias("d")
        .join(o, F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.slice") == F.col("o.slice")))
        .join(t, F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("d.doc_id", "d.source", "d.size", "d.key", "d.n", (F.col("o.slice_from") + F.col("d.inside")).alias("start"),
                "t.source_size", "t.target", "t.weight_class")
    )


def _copies(repeats: int, schedule: Sequence[Sequence[float]]) -> Column:
    """Copies (position, words) of the document that begins at ``start`` in its source."""
    goal = F.floor("target")
    starts = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: e * F.col("source_size") + F.col("start"))
    return F.filter(
        F.transform(starts, lambda s: F.struct(
            _position(F.try_divide(s, F.col("target")), F.col("weight_class"), schedule).alias("position"),
            F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - s)).alias("words"))),
        lambda c: c["words"] > 0)


def _each(blocks: DataFrame) -> DataFrame:
    """One row per document of the blocks."""
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    return blocks.withColumn("nth", nth).withColumn("start", F.col("start") + F.col("nth") * F.col("size"))


def _checked(schedule: Sequence[Sequence[float]]) -> None:
    if any(abs(sum(r) / len(r) - 1) > 1e-9 or min(r) <= 0 for r in schedule):
        raise ValueError("each source rate must be positive and average 1")


def curriculum(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS,
               schedule: Sequence[Sequence[float]] = SCHEDULE) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken,
    copies (array of position, words taken) in training order.

    A source's documents stand in a fixed pseudo-random order (digest of doc_id
    and text); its demand runs through that order again and again until the
    target is met, so every document is taken in whole rounds plus one started
    round, the last document of which may be cut.  Sources without words have
    target 0.  Null text has size 0; a null source is a source of its own, the
    last; null doc_ids and repeated rows are documents like others, and reruns
    agree however the rows are dealt.  Other columns are not read.

    A hot source or doc_id is no hot group: equal documents (doc_id, source and
    text) are counted before the shuffle and stand in blocks that have places of
    their own, sizes are summed by slice of a source first, the running sum goes
    over slices, and only inside a slice over blocks.
    """
    _checked(schedule)
    rows = _each(_placed(docs, F.lit(""), weights, repeats)).withColumn("copies", _copies(repeats, schedule))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"), "copies")


def mix_report(docs: DataFrame) -> DataFrame:
    """op10: words taken of every document, range-sorted by first position."""
    return curriculum(docs).select(
        "doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("long").alias("n_copies"),
        F.get("copies", F.lit(0))["position"].alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS,
          schedule: Sequence[Sequence[float]] = SCHEDULE) -> DataFrame:
    """The mix itself: all columns of ``docs`` for each copy taken, with
    mix_position and mix_words (fewer than the text's when the copy is cut after
    so many words), range-sorted by position.  Documents that are not taken go,
    those without words (null, empty) among them; input columns of those two
    names are replaced.

    The plan is that of ``curriculum``; rows of one doc_id and text that differ in
    another column take their places by a digest of the row, so reruns agree.
    Rows meet the plan by that digest, wholly equal ones once with their number:
    texts are shuffled to that join and to the range sort.
    """
    _checked(schedule)
    docs = docs.drop("mix_position", "mix_words")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
    key = _row_key(F.col("text").cast("string"), *others)
    plan = _placed(docs, key, weights, repeats).where((F.col("size") > 0) & (F.col("start") < F.floor("target")))
    rows = docs.select(key.alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).groupBy(
        "row_key").agg(F.first("row").alias("row"))
    copies = F.explode(_copies(repeats, schedule)).alias("copy")
    out = _each(rows.join(plan, F.col("row_key") == F.col("key"))).select("row", copies)
    return out.select("row.*", F.col("copy.position").alias("mix_position"), F.col("copy.words").alias("mix_words")).orderBy(
        "mix_position", "doc_id")


def _position_sql(share: str, schedule: Sequence[Sequence[float]]) -> str:
    """``_position`` in DuckDB SQL."""
    number = lambda x: f"CAST('{x!r}' AS DOUBLE)"
    classes = []
    for k, rates in enumerate(schedule):
        step, end, whens = 1.0 / len(rates), 0.0, []
        for i, r in enumerate(rates):
            at = f"{number(i * step)} + ({share} - {number(end)}) / {number(r)}"
            end += r * step
            whens.append(f"WHEN {share} < {number(end)} THEN {at}" if i + 1 < len(rates) else f"ELSE {at}")
        classes.append(f"WHEN weight_class = {k} THEN CASE {' '.join(whens)} END")
    return f"least(CAST(1 AS DOUBLE), CASE {' '.join(classes)} END)"


_SOURCES_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_key,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS bigint) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS integer) AS weight_class FROM d GROUP BY source),
p AS (SELECT *, 1.0::double + weight_class AS weight, coalesce(sum(3.0::double * source_size) OVER r, 0) AS set_size,
             coalesce(sum(1.0::double + weight_class) OVER r, 0) AS set_weight,
             sum(source_size) OVER () AS whole, sum(1.0::double + weight_class) OVER () AS weights
      FROM s WINDOW r AS (ORDER BY 3.0::double * source_size / (1.0::double + weight_class), source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((whole - set_size) / (weights - set_weight)) AS level FROM p),
t AS (SELECT source, source_size, weight_class, least(3.0::double * source_size, weight * level) AS target FROM p, l)"""

#: Source targets in DuckDB SQL.
TARGET_SQL = _SOURCES_SQL + "\nSELECT source, source_size, target FROM t"

#: op10 in DuckDB SQL.
REPORT_SQL = _SOURCES_SQL + rf""",
e AS (SELECT doc_id, source, size, text_key, count(*) AS n FROM d GROUP BY ALL),
b AS (SELECT doc_id, source, size, text_key, least({BLOCK}, n - block * {BLOCK}) AS n, block
      FROM (SELECT *, unnest(range(0, (n - 1) // {BLOCK} + 1)) AS block FROM e)),
o AS (SELECT *, coalesce(sum(size * n) OVER (PARTITION BY source
               ORDER BY md5(concat(coalesce(CAST(doc_id AS varchar), ''), ':', text_key, ':', CAST(block AS varchar)))
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM b),
r AS (SELECT doc_id, source, size, start + nth * size AS start, row_number() OVER () AS id
      FROM (SELECT *, unnest(range(0, n)) AS nth FROM o)),
c AS (SELECT r.*, source_size, target, weight_class, round_no * source_size + start AS s
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source, (SELECT unnest(range(0, {REPEATS})) AS round_no)),
w AS (SELECT *, CAST(greatest(0, least(size, CAST(floor(target) AS bigint) - s)) AS bigint) AS words,
             CASE WHEN target > 0 THEN CAST(s AS double) / target END AS share FROM c)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(words) AS bigint) AS taken, count(*) FILTER (words > 0) AS n_copies,
       min({_position_sql("share", SCHEDULE)}) FILTER (words > 0) AS position
FROM w GROUP BY id
"""
