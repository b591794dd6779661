"""Mixture-controlled packing: token sequences are filled by deficit round-robin over
one queue per source.  Partial quanta are carried from window to window, and from
each block of the stream to the next, which continues the window it finds open."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import broadcast_object, chunks, stored, task_count

#: Text that is tokenised together.
CHUNK_BYTES = 4_000_000
#: Tokens of the stream that one step packs; bounds the memory of a task.
BLOCK_TOKENS = 1 << 20
#: Rows (one per source and input partition) up to which the queues' places are broadcast.
BROADCAST_ROWS = 100_000

TOKEN_SCHEMA = "doc_id long, source string, part long, before long, n long, ids binary"
CUT_SCHEMA = "block long, source string, at long, owed double, share long, doc_id long, start long, doc_tokens long, ids binary"
PIECE_SCHEMA = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, padded long, ids binary")

# Fixed value: the split pattern of the vocabulary file (its pre_tokenizer).
FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-case Latin-1 text: its letters, numbers and white space by Unicode property.
LATIN_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^ \t\n\v\f\r\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class TokenIds:
    """Ids of whole texts as a vocabulary file of the tokenizers library gives them, as
    little-endian integers of ``width`` bytes, without added special tokens.

    The library is asked once per distinct piece.  Where the file drops white space,
    splits by FILE_PATTERN and marks word ends, a Latin-1 text is the sum of its pieces, any
    other the sum of its space-separated units; other files, and units with special
    strings, go to the library as they are.  Up to ``size`` pieces and as many units
    are kept, then forgotten, so memory stays bounded.
    """

    def __init__(self, path: str, size: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        self.size = size
        self.library = None
        tool = self._library()
        self.width = 2 if tool.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content for t in tool.get_added_tokens_decoder().values()]
        self.by_piece = _drops_white_space(self.spec) and not any(" " in s for s in self.special)
        self.library = None  # travels as text

    def _library(self):
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
            self.library.no_truncation()
            self.library.no_padding()
            self.units: dict[str, bytes] = {}
            self.pieces: dict[str, bytes] = {}
            suffix = json.loads(self.spec)["model"].get("end_of_word_suffix") or "\0"
            vocabulary = self.library.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        return self.library

    def _ask(self, texts: list[str]) -> list[bytes]:
        kind = f"<u{self.width}"
        return [np.array(e.ids, kind).tobytes() for e in self._library().encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Put the ids of pieces into ``pieces``: many go to the library as one text, whose
        ids are told apart by the tokens that end a word, one for each piece."""
        for k in range(0, len(new), 2000):
            some = new[k:k + 2000]
            ids = np.array(self._library().encode(" ".join(some), add_special_tokens=False).ids, f"<u{self.width}")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()
            if len(cuts) != len(some):
                raise ValueError("the vocabulary does not end every piece with a word end")
            whole = ids.tobytes()
            self.pieces.update(zip(some, (whole[a:b] for a, b in zip([0, *cuts], cuts))))

    def _unit(self, unit: str) -> bytes:
        own = self.units.get(unit)
        if own is None:
            own = self.units[unit] = self._ask([unit])[0]
        return own

    def _mixed(self, text: str) -> bytes:
        """A text that is not all Latin-1, or that holds special strings."""
        out = []
        for unit in text.split(" "):
            if self._plain(unit):
                parts = LATIN_PIECES.findall(unit.lower())
                if new := [p for p in set(parts) if p not in self.pieces]:
                    self._learn(new)
                out += [self.pieces[p] for p in parts]
            else:
                out.append(self._unit(unit))
        return b"".join(out)

    def _plain(self, text: str) -> bool:
        return _latin(text) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        self._library()
        if not self.by_piece:
            return self._ask(texts)
        if len(self.pieces) > self.size or len(self.units) > self.size:
            self.units, self.pieces = {}, {}
        split = [LATIN_PIECES.findall(t.lower()) if self._plain(t) else None for t in texts]
        new = set().union(*filter(None, split)).difference(self.pieces)
        if new:
            self._learn(list(new))
        get = self.pieces.__getitem__
        return [self._mixed(t) if s is None else b"".join(map(get, s)) for t, s in zip(texts, split)]


def _drops_white_space(spec: str) -> bool:
    """Whether the file's text steps work on space-separated units one by one: NFC, runs
    of white space to one space, lower case; pieces by FILE_PATTERN; plain byte-level BPE."""
    tool = json.loads(spec)
    steps = [(n.get("type"), n.get("content"), (n.get("pattern") or {}).get("Regex")) for n in (tool["normalizer"] or {}).get("normalizers", [])]
    splits = (tool["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        steps == [("NFC", None, None), ("Replace", " ", r"\s+"), ("Lowercase", None, None)]
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and tool["model"].get("end_of_word_suffix") and not tool["model"].get("continuing_subword_prefix")
        and splits[0]["pattern"] == {"Regex": FILE_PATTERN} and splits[0]["invert"] and splits[0]["behavior"] == "Removed"
        and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
        and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in tool["added_tokens"])
    )


def token_ids(docs: DataFrame, path: str, end_id: int) -> tuple[DataFrame, int]:
    """doc_id, source, ids (with ``end_id`` last) and n, their number, of every text, and
    the bytes of an id.  part and before place the row: ``before`` is the number of
    ids that its source has in the same input partition before it.  Written once, so a
    repeated task cannot see another order."""
    maker = TokenIds(path)
    width = maker.width if end_id < 1 << 16 else 4
    maker.width = width
    encoder = broadcast_object(docs.sparkSession, maker)
    end = np.array([end_id], f"<u{width}").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), {}
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sources = batch.column("source").to_pylist()
            for a, b in chunks(texts, CHUNK_BYTES):
                ids = [i + end for i in encoder().encode(texts[a:b])]
                n = [len(i) // width for i in ids]
                places = []
                for s, k in zip(sources[a:b], n):
                    places.append(before.get(s, 0))
                    before[s] = places[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("source").slice(a, b - a),
                     pa.array([part] * (b - a), pa.int64()),
                     pa.array(places, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "source", "part", "before", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(encode, TOKEN_SCHEMA), "pack-ids"), width


def _queues(rows: DataFrame, weights: Mapping[str | None, float] | None) -> tuple[DataFrame, int, int]:
    """part, source, queue_from (ids of the source in earlier parts), total (its ids) and
    rate (its ids in the whole time, were its queue never empty); the blocks' number
    needs the sum of rates; and the sum of totals.  One row per source and input partition."""
    sums = rows.groupBy("part", "source").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    queues = sums.withColumn("queue_from", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn(
        "total", F.sum("n").over(Window.partitionBy("source")))
    totals = sums.groupBy("source").agg(F.sum("n").alias("total"))
    if weights is None:
        queues = queues.withColumn("rate", F.col("total"))
        all_ids = totals.agg(F.sum("total")).first()[0] or 0
        return queues, all_ids, all_ids
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    weight = F.lit(1.0)
    for source, w in weights.items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    longest = totals.agg(F.max(F.col("total") / weight)).first()[0] or 0.0
    rate: Column = F.greatest(F.col("total"), F.ceil(weight * F.lit(longest)))
    whole = totals.agg(F.sum("total"), F.sum(rate)).first()
    return queues.withColumn("rate", rate), whole[0] or 0, whole[1] or 0


def block_parts(place: int, n: int, total: int, rate: int, blocks: int) -> Iterator[tuple[int, int, int, int]]:
    """Where the ``n`` ids from ``place`` of a queue are cut at block boundaries: (block,
    ids before, ids, the queue's place where the block begins).  In block b the queue
    goes from floor(rate * b / blocks) to floor(rate * (b + 1) / blocks), or its end."""
    done = 0
    while done < n:
        block = -(-(place + done + 1) * blocks // rate) - 1
        take = min(min(rate * (block + 1) // blocks, total) - place - done, n - done)
        yield block, done, take, rate * block // blocks
        done += take


def _block_starts(placed: DataFrame, blocks: int, group: int = 4096) -> DataFrame:
    """start_block, stream_from: the ids in earlier blocks.  Blocks are summed in groups
    first, so the one ordered pass over all sees a row for ``group`` blocks (2^32 ids)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[int, int] = {}
            for r in batch.to_pylist():
                for block, _, take, _ in block_parts(r["place"], r["n"], r["total"], r["rate"], blocks):
                    sums[block] = sums.get(block, 0) + take
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())],
                                             ["block", "n"])

    sums = (placed.select("place", "n", "total", "rate").mapInArrow(count, "block long, n long")
            .groupBy("block").agg(F.sum("n").alias("n")).withColumn("group", F.floor(F.col("block") / group)))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.groupBy("group").agg(F.sum("n").alias("n")).select(
        "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("group_from"))
    return sums.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "group").select(
        F.col("block").alias("start_block"), (F.col("group_from") + F.col("inside")).alias("stream_from"))


def _cuts(placed: DataFrame, blocks: int, width: int) -> DataFrame:
    """Documents cut at block boundaries, with their place in the block's part of the
    queue, that part's share, and ``owed``, the part of an id that the floors have
    kept back until then."""
    names = [f.split(" ")[0] for f in CUT_SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    kinds = [types[f.split(" ")[1]] for f in CUT_SCHEMA.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                rate, ids = r["rate"], r["ids"]
                for block, done, take, first in block_parts(r["place"], r["n"], r["total"], rate, blocks):
                    out.append((block, r["source"], r["place"] + done - first, rate * block % blocks / blocks,
                                rate * (block + 1) // blocks - first, r["doc_id"], done, r["n"],
                                ids[done * width:(done + take) * width]))
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in out], k) for i, k in enumerate(kinds)], names)

    return placed.mapInArrow(cut, CUT_SCHEMA)


def open_sequence(place: int, total: int, length: int) -> tuple[int, int, int]:
    """Sequence, offset in it and its size for a place of the stream of ``total`` ids.
    Sequences hold ``length`` ids; what is left at the end goes into sequences of powers
    of two, largest first, which need no padding."""
    sequence, rest = divmod(place, length)
    left = total - sequence * length
    if left >= length:
        return sequence, rest, length
    size = 1 << (left.bit_length() - 1)
    while rest >= size:
        sequence, rest, left = sequence + 1, rest - size, left - size
        size = 1 << (left.bit_length() - 1)
    return sequence, rest, size


def fill(queues: list[int], shares: list[int], owed: list[float], place: int, total: int,
         length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Deficit round-robin over queues of so many ids until all are empty: yields (queue,
    ids taken, sequence, offset, size).  A window's free places are dealt as quanta by
    the shares of the queues that still hold ids; a queue is served the whole ids of
    its deficit and carries the rest.  Places that are then left go one by one, and
    then as they come, to the queues with the largest deficit, which may fall below zero."""
    left = np.array(queues, np.int64)
    weight = np.array(shares, np.float64)
    deficit = np.array(owed, np.float64)
    todo = int(left.sum())
    while todo:
        sequence, offset, size = open_sequence(place, total, length)
        space = min(size - offset, todo)
        active = left > 0
        deficit[~active] = 0.0
        deficit[active] += space * weight[active] / weight[active].sum()
        take = np.clip(np.floor(deficit), 0, left).astype(np.int64)
        over = np.cumsum(take) - space
        take -= np.clip(over, 0, take)
        rest = space - int(take.sum())
        while rest:
            able = np.flatnonzero(left > take)
            best = able[np.argsort(take[able] - deficit[able], kind="stable")]
            more = np.minimum(max(1, rest // len(able)), left[best] - take[best])
            more -= np.clip(np.cumsum(more) - rest, 0, more)
            take[best] += more
            rest -= int(more.sum())
        for i in np.flatnonzero(take):
            yield int(i), int(take[i]), sequence, offset, size
            offset += int(take[i])
        left -= take
        deficit -= take
        todo -= space
        place += space


def pack(docs: DataFrame, path: str, end_id: int = 2, length: int = 4096, weights: Mapping[str | None, float] | None = None,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The pieces of all documents in sequences of at most ``length`` ids: doc_id, source,
    start (in the document), length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), doc_tokens, sequence_id, offset, padded (the sequence's length with
    padding) and ids (little-endian, 2 bytes where the vocabulary allows, else 4).

    Every sequence holds the sources in the proportions of ``weights`` (missing sources: 1)
    as long as their queues last, and by default in those of the whole input, so
    that all queues end together.  A queue holds a source's documents in the order of
    the input partitions.  The stream is made in blocks, each with its share of every
    queue, so one source that holds most rows is no group of its own; a block
    takes up the deficits and the half-filled window that the one before leaves.

    Null text is empty (one id, the end id); null ids, null sources and repeated rows
    are packed like others; an empty table gives no row; extra columns are not read.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    rows, width = token_ids(docs, path, end_id)
    queues, total, rates = _queues(rows, weights)
    blocks = max(1, -(-rates // block_tokens))
    queues = stored(queues, "pack-queues")
    if queues.count() <= BROADCAST_ROWS:
        queues = F.broadcast(queues)  # beyond that the ids are shuffled once more
    q, r = queues.alias("q"), rows.alias("r")
    placed = r.join(q, (F.col("r.part") == F.col("q.part")) & F.col("r.source").eqNullSafe(F.col("q.source"))).select(
        "r.doc_id", "r.source", (F.col("q.queue_from") + F.col("r.before")).alias("place"), "r.n", "q.total", "q.rate", "r.ids")
    starts = _block_starts(placed, blocks)
    tasks = task_count(docs.sparkSession)
    dealt = (_cuts(placed, blocks, width).join(starts, F.col("block") == F.col("start_block")).drop("start_block")
             .repartition(tasks, "block").sortWithinPartitions("block", F.col("source").asc_nulls_first(), "at"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["block"] != r["block"]:
                    yield _packed(held, total, length, width)
                    held = []
                held.append(r)
        if held:
            yield _packed(held, total, length, width)

    return dealt.mapInArrow(deal, PIECE_SCHEMA)


def _packed(cuts: list[dict], total: int, length: int, width: int) -> pa.RecordBatch:
    """The pieces of one block; ``cuts`` are its rows by source and place."""
    queues: dict[str | None, list[dict]] = {}
    for r in cuts:
        queues.setdefault(r["source"], []).append(r)
    heads = [q[0] for q in queues.values()]
    sizes = [sum(len(r["ids"]) // width for r in q) for q in queues.values()]
    rows = [iter(q) for q in queues.values()]
    open_row: list[list] = [[next(q), 0] for q in rows]
    out: list[list] = [[] for _ in PIECE_SCHEMA.split(", ")]
    for i, take, sequence, offset, size in fill(sizes, [h["share"] for h in heads], [h["owed"] for h in heads],
                                                cuts[0]["stream_from"], total, length):
        while take:
            r, used = open_row[i]
            here = len(r["ids"]) // width - used
            n = min(here, take)
            ids = r["ids"][used * width:(used + n) * width]
            crc = crc32(ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
            for column, value in zip(out, (r["doc_id"], r["source"], r["start"] + used, n, crc, r["doc_tokens"], sequence,
                                           offset, size, ids)):
                column.append(value)
            offset += n
            take -= n
            open_row[i][1] += n
            if n == here:
                open_row[i] = [next(rows[i], None), 0]
    types = [pa.string() if " string" in f else pa.binary() if " binary" in f else pa.int64() for f in PIECE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                      [f.split(" ")[0] for f in PIECE_SCHEMA.split(", ")])


def pack_report(docs: DataFrame, path: str) -> DataFrame:
    """op12: the pieces without their ids."""
    return pack(docs, path).drop("ids")
