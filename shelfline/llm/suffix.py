"""Suffix-array dedup of repeated byte strings, built column by column over many
documents at once: every round inserts one symbol per document, keeps the
collection in suffix order by a stable sort on that symbol (the step of the
Burrows-Wheeler transform) and updates the common prefixes of neighbours.

Inserting whole documents that way would take as many passes over the corpus as
the longest document has bytes.  So the documents of the construction are short
segments, cut and aligned at content-defined anchors: each window of ``length``
bytes has one anchor, the least of its k-grams by hash, equal windows have equal
anchors at equal places, and a segment is the range of windows that share an
anchor.  Segments are sorted by anchor in Spark's shuffle files and read once,
in order; those of one anchor meet in one construction, which needs a round per
byte of a segment, whatever the documents' lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import chunks, runs, stored, task_count, unused, utf8

LENGTH = 400
GRAM = 128
#: Passages that stand in another document, as the pipeline removes them: found by
#: strings of so many bytes, and of so many words at least.
PASSAGE_LENGTH = 200
PASSAGE_GRAM = 64
PASSAGE_WORDS = 50
#: Parts into which the occurrences of one segment are put together.
PARTS = 1024
#: Distinct segments of one anchor in a construction; an anchor with more is cut
#: anew at anchors of longer k-grams.
CROWDED = 4096
BATCH = 8192
#: Bytes that are hashed at once, few enough for the processor's cache.
_PIECE = 1 << 17
#: Rows of a batch that goes back to Spark.
ROWS = 16384
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


class Anchors:
    """Finds the anchors of all windows of a text."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.reach = length, gram, length - gram + 1
        n = _PIECE + 2 * length
        up, down = np.full(n, _BASE, _U), np.full(n, pow(_BASE, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        self.place_bits = n.bit_length()
        self.places = np.uint32((1 << self.place_bits) - 1) - np.arange(n, dtype=np.uint32)

    def grams(self, b: np.ndarray) -> np.ndarray:
        """Rolling hash of the k-gram at each place."""
        sums = np.zeros(len(b) + 1, _U)
        np.cumsum((b.astype(_U) + _U(1)) * self.up[: len(b)], out=sums[1:])
        return (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(b) - self.gram + 1]

    @staticmethod
    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> _U(31))) * _U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> _U(32))

    def find(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text number, first window, last window, anchor, hash) of every run of
        windows with one anchor; texts lie in ``data`` at starts to ends, and
        places are counted in ``data``."""
        b = np.frombuffer(data, np.uint8)
        if len(b) < self.length:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),)
        h = self.grams(b)
        anchor, first, last = self._owners(h)
        which = np.searchsorted(starts, anchor, "right") - 1
        first, last = np.maximum(first, starts[which]), np.minimum(last, ends[which] - self.length)
        inside = first <= last  # windows of one anchor are fewer than a window has bytes: they touch one text
        anchor = anchor[inside]
        return which[inside], first[inside], last[inside], anchor, self.mixed(h[anchor])

    def _owners(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first and last window of every run of windows with one anchor: the
        least by the first bits of the hash, of equal ones the last place."""
        w, bits = self.reach, self.place_bits
        order = (h ^ (h >> _U(31))) * _U(0xFF51AFD7ED558CCD) >> _U(32 + bits)
        key = (order.astype(np.uint32) << np.uint32(bits)) | self.places[: len(h)]
        count, span = len(h) - w + 1, 1
        while span * 2 <= w:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        least = np.minimum(key[:count], key[w - span : w - span + count])
        new = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((new[1:], [count])) - 1
        return (self.places[0] - (least[new] & self.places[0])).astype(np.int64), new, last


ANCHOR_ROWS = "h long, segment long, id long, mark long, first long, last long, anchor long, copies int, many boolean"
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """id, mark, text: a row's key is its doc_id (a fixed number for null) and
    the hash of its text, so that only identical rows share it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _pieces(texts: list[bytes], overlap: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Text numbers, offsets and bytes: several short texts, or a part of a long one."""
    for a, b in chunks(texts, _PIECE // 2):
        if b == a + 1 and len(texts[a]) > _PIECE:
            for at in range(0, len(texts[a]) - overlap, _PIECE):
                yield [a], [at], [texts[a][at : at + _PIECE + overlap]]
        else:
            yield list(range(a, b)), [0] * (b - a), texts[a:b]


def _of_kind(h: np.ndarray, kind: int) -> np.ndarray:
    """The hash with the number of the search it belongs to, 0 or 1, as its last bit."""
    return ((h & ~_U(1)) | _U(kind)).view(np.int64)


def _anchor_hashes(keyed: DataFrame, searches: list[tuple[int, int]]) -> DataFrame:
    """h of every run of windows with one anchor, of all searches (length, gram)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Anchors(length, gram) for length, gram in searches]
        held: list[np.ndarray] = []
        for batch in batches:
            texts = utf8(batch, "text")
            for kind, finder in enumerate(finders):
                for _, _, parts in _pieces(texts, finder.length - 1):
                    sizes = np.array(list(map(len, parts)))
                    ends = np.cumsum(sizes)
                    held.append(_of_kind(finder.find(b"".join(parts), ends - sizes, ends)[4], kind))
                    if sum(map(len, held)) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held))], ["h"])
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held))], ["h"])

    return keyed.select("text").mapInArrow(run, "h long")


def _anchor_rows(keyed: DataFrame, searches: list[tuple[int, int]]) -> DataFrame:
    """One row per run of windows with one anchor, of all searches (length, gram)."""
    names = [f.split()[0] for f in ANCHOR_ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Anchors(length, gram) for length, gram in searches]
        digest = xxhash.xxh3_64_intdigest
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.ones(n, np.int32)), pa.array(np.zeros(n, bool))], names)

        for batch in batches:
            texts = utf8(batch, "text")
            ids = batch.column("id").to_numpy()
            marks = batch.column("mark").to_numpy()
            for kind, finder in enumerate(finders):
                length = finder.length
                for numbers, offsets, parts in _pieces(texts, length - 1):
                    data = b"".join(parts)
                    sizes = np.array(list(map(len, parts)))
                    ends = np.cumsum(sizes)
                    which, first, last, anchor, h = finder.find(data, ends - sizes, ends)
                    segment = np.fromiter((digest(data[x:y]) for x, y in zip(first.tolist(), (last + length).tolist(), strict=True)), _U, len(first))
                    doc = np.array(numbers)[which]
                    move = np.array(offsets)[which] - (ends - sizes)[which]
                    held.append((_of_kind(h, kind), segment.view(np.int64), ids[doc], marks[doc], first + move, last + move, anchor + move))
                    if sum(len(c[0]) for c in held) >= ROWS:
                        yield flush()
                        held = []
        if held:
            yield flush()

    return keyed.mapInArrow(run, ANCHOR_ROWS)


def repeated_windows(segments: list[bytes], anchors: list[int], length: int,
                     own: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Which windows of the segments occur in another one, by column-wise
    construction.  Segments are aligned at their anchors (offsets in them).
    ``own`` gives the least and the largest number of the documents that a
    segment stands for; windows then count that also stand in another document's
    segment.

    Row r, column c of the result stands for the window of segment r that
    begins c bytes after the leftmost column.  Each round takes the next column
    to the left and inserts its symbol before every suffix: a stable sort by
    symbol keeps the suffixes in order, and neighbours with the same symbol have
    one byte more in common than the least of the common prefixes between them
    so far.  Segment ends are symbols that equal nothing.
    """
    k = len(segments)
    left = max(anchors)
    width = left + max(len(s) - a for s, a in zip(segments, anchors, strict=True))
    end = 256
    rows = np.full((k, width), end, np.uint16)
    for r, (s, a) in enumerate(zip(segments, anchors, strict=True)):
        rows[r, left - a : left - a + len(s)] = np.frombuffer(s, np.uint8)
    table = np.ascontiguousarray(rows.T)
    columns = width - length + 1
    found = np.zeros((columns, k), bool)
    order = np.arange(k)
    common = np.zeros(k, np.int16)  # with the row before, at most ``length``
    for c in range(width - 1, -1, -1):
        symbol = table[c, order]
        move = np.argsort(symbol, kind="stable")
        symbol = symbol[move]
        grown = np.zeros(k, np.int16)
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] != end)) + 1
        if len(same):
            grown[same] = np.minimum(_least(common, move[same - 1] + 1, move[same]) + 1, length)
        order, common = order[move], grown
        if c >= columns:
            continue
        equal = common >= length
        hit = np.flatnonzero(equal)
        if not len(hit):
            continue
        if own is None:
            found[c, order[hit]] = True
            found[c, order[hit - 1]] = True
        else:
            equal[hit - 1] = True
            group = np.flatnonzero(equal)  # rows of windows that are equal to another one
            rows_of = order[group]
            begin = np.flatnonzero(common[group] < length)
            differ = np.minimum.reduceat(own[0][rows_of], begin) != np.maximum.reduceat(own[1][rows_of], begin)
            found[c, rows_of] = np.repeat(differ, np.diff(np.append(begin, len(group))))
    return found


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a..b] of every range."""
    out = values[b]
    wide = np.flatnonzero(b > a)
    if not len(wide):
        return out
    a, b = a[wide], b[wide]
    span = b - a + 1
    if span.sum() <= 8 * len(values):
        bounds = np.empty(2 * len(a), np.int64)
        bounds[::2], bounds[1::2] = a, b + 1
        out[wide] = np.minimum.reduceat(np.append(values, values[-1]), bounds)[::2]
        return out
    level = np.frexp(span)[1] - 1
    least = out[wide]
    for i in range(int(level.max()) + 1):
        here = np.flatnonzero(level == i)
        if len(here):
            least[here] = np.minimum(values[a[here]], values[b[here] - (1 << i) + 1])
        values = np.minimum(values[: -(1 << i)], values[1 << i :])
    out[wide] = least
    return out


def list_rows(column: pa.ListArray, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each list of structs begins (and the last ends), and the fields of all of
    them; a null list is empty."""
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(int(at[0]), int(at[-1] - at[0]))
    return at - at[0], [values.field(f).to_numpy(zero_copy_only=False) for f in fields]


SPAN_ROWS = "id long, mark long, first long, after long"


def _construct(segments: DataFrame, length: int, across: bool) -> DataFrame:
    """Repeated ranges of segments, from rows sorted by h.  A task holds the
    segments of one construction: whole anchors, of CROWDED segments at most
    each, until they are BATCH."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def finish() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            anchors = [r[5] for r in held]
            own = None
            if across:  # a segment that stands for several documents begins below all numbers
                numbers: dict[tuple, int] = {}
                high = np.array([numbers.setdefault((r[2], r[3]), len(numbers)) for r in held])
                own = np.where([r[1] for r in held], high, -1), high
            found = repeated_windows([r[6] for r in held], anchors, length, own)
            # one row after another, each with a column more, so that no run reaches into the next row
            once = np.flatnonzero([r[1] for r in held])
            flat = np.zeros((len(once), len(found) + 1), bool)
            flat[:, :-1] = found.T[once]
            start, stop = runs(flat.ravel())
            row, start = np.divmod(start, len(found) + 1)
            if len(row):
                ids, marks, places = (np.array([r[i] for r in held], np.int64)[once[row]] for i in (2, 3, 4))
                shift = places + np.array(anchors)[once[row]] - max(anchors)
                stop = stop - 1 - row * (len(found) + 1) + shift + length
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, marks, start + shift, stop)], ["id", "mark", "first", "after"])

        last = None
        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False).tolist() for n in ("h", "once", "id", "mark", "first", "offset", "bytes")]
            for row in zip(*columns, strict=True):
                if len(held) >= BATCH and row[0] != last:
                    yield from finish()
                    held = []
                last = row[0]
                held.append(row)
        yield from finish()

    return segments.mapInArrow(run, SPAN_ROWS)


def _cut_segments(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of segments, joined to their documents: h, once, id, mark,
    first, offset (of the anchor), bytes."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("h", "once", "first", "last", "anchor")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "once", "id", "mark", "first", "offset", "bytes"]
        for batch in batches:
            texts = utf8(batch, "text")
            ids, marks = batch.column("id").to_numpy(), batch.column("mark").to_numpy()
            at, cuts = list_rows(batch.column("cuts"), "h", "once", "first", "last", "anchor")
            doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
            h, once, first, last, anchor = cuts
            for x in range(0, len(h), 4096):
                part = slice(x, x + 4096)
                own = [texts[d][a:b] for d, a, b in zip(doc[part].tolist(), first[part].tolist(), (last[part] + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (h[part], once[part], ids[doc[part]], marks[doc[part]], first[part], (anchor - first)[part])),
                     pa.array(own, pa.binary())], names)

    # a list is a row: the hash table of a partition needs no more memory than its rows
    return keyed.join(lists.hint("shuffle_hash"), ["id", "mark"]).select("id", "mark", "text", "cuts").mapInArrow(
        run, "h long, once boolean, id long, mark long, first long, offset long, bytes binary")


def _finer_rows(segments: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchor rows of the windows of segments, with their bytes, at a longer
    k-gram.  A segment that stands for several equal ones counts twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        names = [*(f.split()[0] for f in ANCHOR_ROWS.split(", ")), "bytes"]
        for batch in batches:
            rows = batch.to_pylist()
            for a, b in chunks([r["bytes"] for r in rows], _PIECE // 2):
                ends = np.cumsum([len(r["bytes"]) for r in rows[a:b]])
                starts = np.concatenate(([0], ends[:-1]))
                data = b"".join(r["bytes"] for r in rows[a:b])
                out: tuple[list, ...] = tuple([] for _ in names)
                for which, first, last, anchor, h in zip(*(x.tolist() for x in finder.find(data, starts, ends)), strict=True):
                    r = rows[a + which]
                    move = r["first"] - int(starts[which])
                    cut = data[first : last + length]
                    row = (h - (1 << 64) if h >> 63 else h, xxhash.xxh3_64_intdigest(cut) - (1 << 63), r["id"], r["mark"],
                           first + move, last + move, anchor + move, 1 if r["once"] else 2, not r["once"], cut)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                if out[0]:
                    kinds = (*[pa.int64()] * 7, pa.int32(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return segments.select("once", "id", "mark", "first", "bytes").mapInArrow(run, ANCHOR_ROWS + ", bytes binary")


def _near(hashes: DataFrame, rows: DataFrame) -> DataFrame:
    """The anchor rows whose h is no unique one among the hashes (h, copies)."""
    tasks = task_count(rows.sparkSession)
    often = stored(hashes.groupBy("h").agg(F.sum("copies").alias("n")).where("n > 1").select("h"), "anchors")
    # dealt by document again: rows of a frequent anchor must not lie together, or later shuffles cannot split them
    return stored(rows.join(often.hint("shuffle_hash"), "h").repartition(tasks, "id", "mark"), "segments")


def _repeats(near: DataFrame, cut: Callable[[DataFrame], DataFrame], length: int, gram: int, crowded: int, across: bool) -> DataFrame:
    """Repeated spans among anchor rows.

    1. Anchors whose k-gram is unique are gone (``_near``).  2. Segments
    that occur twice as a whole are repeated.  3. Of anchors with several
    distinct segments, one of them unique, ``cut`` gives every distinct segment's
    bytes once, and they go through the column-wise construction.  4. Where that
    would be more than ``crowded`` segments for an anchor, they are cut at anchors
    of longer k-grams, which fewer of them share; a k-gram of the full length is
    shared by equal windows only, so this ends.

    With ``across`` a segment is settled only if it occurs in two documents; the
    others go through the construction with all their occurrences, of which one
    document has no more than it has bytes.

    Occurrences of a segment are put together in up to PARTS rows before they are
    looked up, so a segment that every document holds is a few rows in the join;
    the rows are dealt again by part before they are taken apart.
    """
    tasks = task_count(near.sparkSession)
    # any of the places of a segment, all its columns from one row
    fields = [c for c in near.columns if c not in ("h", "segment", "copies", "many")]
    distinct = stored(
        near.groupBy("h", "segment").agg(
            F.sum("copies").alias("n"), F.max("many").alias("many"), *(F.first(c).alias(c) for c in fields),
            *(F.max(c).alias(f"last_{c}") for c in ("id", "mark")), *(F.min(c).alias(f"least_{c}") for c in ("id", "mark")))
        .withColumn("settled", F.col("many") | (F.col("least_id") != F.col("last_id")) | (F.col("least_mark") != F.col("last_mark"))
                    if across else F.col("n") > 1)
        .select("h", "segment", "n", "settled", *fields), "distinct-segments")
    settled = distinct.where("settled").select("h", "segment")
    part = F.pmod(F.xxhash64("id", "mark"), F.lit(PARTS))
    gathered = near.groupBy("h", "segment", part.alias("part")).agg(F.collect_set(F.struct("id", "mark", "first", "last")).alias("places"))
    whole = (gathered.join(settled, ["h", "segment"], "left_semi").repartition(tasks, "h", "segment", "part")
             .select(F.explode("places").alias("p")).select("p.id", "p.mark", "p.first", (F.col("p.last") + length).alias("after")))
    mixed = stored(
        distinct.groupBy("h").agg(F.count("*").alias("kinds"), F.min("settled").alias("all_settled")).where("kinds > 1 and not all_settled")
        .select("h", (F.col("kinds") > crowded).alias("crowded")), "mixed-anchors")
    wanted = distinct.join(mixed, "h")
    if across:
        loose = near.join(wanted.where("not settled").select("h", "segment", "crowded"), ["h", "segment"]).select(
            "h", F.lit(True).alias("once"), "crowded", *fields)
        wanted = wanted.where("settled").select("h", F.lit(False).alias("once"), "crowded", *fields).unionByName(loose)
    else:
        wanted = wanted.select("h", (~F.col("settled")).alias("once"), "crowded", *fields)
    calm = cut(wanted.where("not crowded").drop("crowded"))
    dealt = calm.repartition(tasks, "h").sortWithinPartitions("h", "id", "mark", "first")
    found = whole.union(_construct(dealt, length, across))
    if mixed.where("crowded").isEmpty():
        return found
    longer = length - (length - gram) // 4  # three quarters of the way to the full length
    packed = cut(wanted.where("crowded").drop("crowded"))
    finer = stored(_finer_rows(packed, length, longer if longer < length - 2 else length), "finer-segments")
    carried = lambda part: part.select(
        "h", "once", "id", "mark", "first", (F.col("anchor") - F.col("first")).alias("offset"), "bytes")
    return found.union(_repeats(_near(finer, finer), carried, length, longer if longer < length - 2 else length, crowded, across))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED, across: bool = False) -> DataFrame:
    """id, mark and spans (first, after: maximal runs, in order) of the bytes that are
    covered by a ``length``-byte string which also starts elsewhere, or with
    ``across`` in another document (rows alike in id and text are one document
    there).  A document without such bytes has no row."""
    keyed = _keyed(docs)
    return _merged(_repeats(_base(keyed, [(length, gram)]), lambda part: _cut_segments(keyed, part, length), length, gram, crowded, across))


def _base(keyed: DataFrame, searches: list[tuple[int, int]]) -> DataFrame:
    """The anchor rows of the documents whose k-gram is no unique one."""
    return _near(_anchor_hashes(keyed, searches).withColumn("copies", F.lit(1)), _anchor_rows(keyed, searches))


def _merged(found: DataFrame) -> DataFrame:
    """id, mark, spans: the maximal runs of the spans of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # runs of the last document so far

        def out(ids: np.ndarray, marks: np.ndarray, first: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
            begin = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]))))
            spans = pa.StructArray.from_arrays([pa.array(first), pa.array(after)], ["first", "after"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), spans)
            return pa.RecordBatch.from_arrays([pa.array(ids[begin]), pa.array(marks[begin]), lists], ["id", "mark", "spans"])

        for batch in batches:
            ids, marks, first, after = (np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True))
            if not len(ids):
                continue
            new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))
            above = np.cumsum(new) << 40  # each document higher than the one before
            reach = np.maximum.accumulate(after + above)
            begin = np.flatnonzero(np.concatenate(([True], new[1:] | ((first + above)[1:] > reach[:-1]))))
            stop = np.append(begin[1:], len(ids)) - 1
            ids, marks, first, after = ids[begin], marks[begin], first[begin], (reach - above)[stop]
            last = int(np.flatnonzero((ids != ids[-1]) | (marks != marks[-1])).max(initial=-1)) + 1
            if last:
                yield out(ids[:last], marks[:last], first[:last], after[:last])
            held = [c[last:] for c in (ids, marks, first, after)]
        if len(held[0]):
            yield out(*held)

    dealt = found.repartition(task_count(found.sparkSession), "id", "mark").sortWithinPartitions("id", "mark", "first")
    return dealt.select("id", "mark", "first", "after").mapInArrow(run, "id long, mark long, spans array<struct<first:long,after:long>>")


def run_lists(column: pa.ListArray) -> list[list[tuple[int, int]]]:
    """The runs (first, after) of each row of a column of spans."""
    at, (first, after) = list_rows(column, "first", "after")
    pairs = list(zip(first.tolist(), after.tolist(), strict=True))
    return [pairs[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def removed_runs(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of ordered spans; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        if out and s["first"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["after"]))
        else:
            out.append((s["first"], s["after"]))
    return out


def kept_bytes(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for first, after in cut:
        parts.append(text[at:first])
        at = after
    parts.append(text[at:])
    return b"".join(parts)


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, passage_words long"


def suffix_report(docs: DataFrame) -> DataFrame:
    """op3: what is left of every document without its repeated bytes, and its words in
    passages that another document has too, as in ``passage_report``.

    Null text is empty; null ids and repeated rows are documents like others; an empty
    table gives no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, cut, shared in zip(batch.column("id").to_pylist(), utf8(batch, "text"), run_lists(batch.column("spans")),
                                              run_lists(batch.column("shared")), strict=True):
                kept = kept_bytes(text, cut)
                rows.append((None if doc == NO_ID else doc, len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                             passage_words(text, shared)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in REPORT.split(", ")])

    keyed = _keyed(docs)
    near = _base(keyed, [(LENGTH, GRAM), (PASSAGE_LENGTH, PASSAGE_GRAM)])  # the texts are read once for both searches
    spans, shared = (stored(_merged(_repeats(
        near.where(F.col("h").bitwiseAND(1) == kind), lambda part, length=length: _cut_segments(keyed, part, length),
        length, gram, CROWDED, across)), name) for kind, (length, gram, across, name) in enumerate((
            (LENGTH, GRAM, False, "repeated-spans"), (PASSAGE_LENGTH, PASSAGE_GRAM, True, "shared-passages"))))
    both = spans.join(shared.withColumnRenamed("spans", "shared"), ["id", "mark"], "full")
    return keyed.join(both.hint("shuffle_hash"), ["id", "mark"], "left").select("id", "text", "spans", "shared").mapInArrow(run, REPORT)


def _shared_passages(docs: DataFrame) -> DataFrame:
    return stored(repeated_spans(docs, PASSAGE_LENGTH, PASSAGE_GRAM, across=True), "shared-passages")


def passage_words(text: bytes, cut: list[tuple[int, int]]) -> int:
    """Words of a text in those of its runs that hold PASSAGE_WORDS words at least."""
    counts = [len(text[a:b].split()) for a, b in cut]
    return sum(n for n in counts if n >= PASSAGE_WORDS)


def passage_report(docs: DataFrame) -> DataFrame:
    """doc_id and passage_words of every document: its words in passages of PASSAGE_WORDS
    words or more that another document has too, by a construction at PASSAGE_LENGTH
    bytes.  Nulls, repeated rows and empty tables as in ``remove_repeats``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if doc == NO_ID else doc for doc in batch.column("id").to_pylist()]
            words = [passage_words(text, cut) for text, cut in zip(utf8(batch, "text"), run_lists(batch.column("spans")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.int64())], ["doc_id", "passage_words"])

    return _keyed(docs).join(_shared_passages(docs).hint("shuffle_hash"), ["id", "mark"], "left").select("id", "text", "spans").mapInArrow(
        run, "doc_id long, passage_words long")


def long_runs(text: bytes, cut: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """The runs that hold ``min_words`` words (between white space) at least."""
    return [(a, b) for a, b in cut if len(text[a:b].split()) >= min_words]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, min_words: int = 0, across: bool = False) -> DataFrame:
    """The documents, all their columns, without repeated bytes in text (a code
    point that is cut goes whole); n_chars, where there is one, follows.

    Bytes are repeated that a string of ``length`` bytes covers which also starts
    elsewhere, with ``across`` in another document; runs of them with fewer than
    ``min_words`` words stay.  Every copy goes.  Null texts stay null, empty ones
    empty; null ids and repeated rows are documents like others, but rows alike in
    id and text are one document to ``across``; an empty table gives no row."""
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text_at).to_pylist()
            spans = run_lists(batch.column(batch.num_columns - 1))
            new = []
            for t, s in zip(old, spans, strict=True):
                if t is not None and s:
                    raw = t.encode("utf-8")
                    t = kept_bytes(raw, long_runs(raw, s, min_words)).decode("utf-8", "ignore")
                new.append(t)
            columns = batch.columns[:-1]
            columns[text_at] = pa.array(new, pa.string())
            if chars_at is not None:
                chars = [n if t is None or not s else len(x) for n, t, s, x in
                         zip(batch.column(chars_at).to_pylist(), old, spans, new, strict=True)]
                columns[chars_at] = pa.array(chars, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    key, text_hash, own_key, own_hash, cut = unused(docs, "row_key", "row_hash", "span_key", "span_hash", "spans")
    spans = stored(repeated_spans(docs, length, gram, across=across), "repeated-spans").select(
        F.col("id").alias(own_key), F.col("mark").alias(own_hash), F.col("spans").alias(cut))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), text_hash: F.xxhash64(text)})
    joined = rows.join(spans.hint("shuffle_hash"), (F.col(key) == F.col(own_key)) & (F.col(text_hash) == F.col(own_hash)), "left")
    return joined.select(*docs.columns, cut).mapInArrow(run, docs.schema)
