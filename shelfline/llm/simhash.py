"""SimHash near-duplicates by anchor-point covering: anchors are the words of a
covering code, every fingerprint is replicated to all anchors within covering
radius plus threshold, and fingerprints are compared per anchor."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import blank_words, chunks, stored, task_count, utf8
from shelfline.llm.components import components

SHINGLE = 3
THRESHOLD = 2
SEED = 42
#: Anchors that are home to more fingerprints than this are compared another way.
CROWDED = 2048

LENGTH, RADIUS = 23, 3
_GENERATOR = 0b110001110101  # fixed value: a generator polynomial of the binary Golay code


def _syndromes() -> np.ndarray:
    """Remainder of every one-bit word modulo the generator polynomial."""
    out = []
    for i in range(LENGTH):
        r = 1 << i
        for shift in range(LENGTH - 1, 10, -1):
            if r >> shift & 1:
                r ^= _GENERATOR << (shift - 11)
        out.append(r)
    return np.array(out, np.int64)


class CoveringCode:
    """Two Golay code words side by side (bits 0-22 and 23-45 of a fingerprint;
    the other bits have one anchor).  The Golay code is perfect: each 23-bit
    word has exactly one code word within radius 3, its home.

    ``errors[x]`` lists, by syndrome, the patterns that lead to the code words
    at distance at most 3 (x = 0), 4 (x = 1) and 5 (x = 2); -1 fills up.
    """

    def __init__(self, threshold: int):
        bits = _syndromes()
        self.bits = bits
        by_excess: list[dict[int, list[int]]] = [{} for _ in range(threshold + 1)]
        for weight in range(RADIUS + threshold + 1):
            for places in combinations(range(LENGTH), weight):
                s = 0
                for i in places:
                    s ^= int(bits[i])
                by_excess[max(0, weight - RADIUS)].setdefault(s, []).append(sum(1 << i for i in places))
        self.errors = []
        for table in by_excess:
            width = max(map(len, table.values()))
            rows = np.full((2048, width), -1, np.int64)
            for s, patterns in table.items():
                rows[s, : len(patterns)] = patterns
            self.errors.append(rows)
        self.threshold = threshold

    def _syndrome(self, block: np.ndarray) -> np.ndarray:
        s = np.zeros(len(block), np.int64)
        for i in range(LENGTH):
            s ^= ((block >> i) & 1) * self.bits[i]
        return s

    def anchors(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(anchor, fingerprint, home) columns: the home anchor of each
        fingerprint, then all others whose cell is within the threshold, i.e.
        whose distance exceeds the covering radius of each block by no more
        than the threshold in all."""
        mask = (1 << LENGTH) - 1
        low = (prints & np.uint64(mask)).astype(np.int64)
        high = (prints >> np.uint64(LENGTH) & np.uint64(mask)).astype(np.int64)
        at_low, at_high = self._syndrome(low), self._syndrome(high)
        for x in range(self.threshold + 1):
            for y in range(self.threshold + 1 - x):
                first, second = self.errors[x][at_low], self.errors[y][at_high]
                for i in range(first.shape[1]):
                    for j in range(second.shape[1]):
                        ok = (first[:, i] >= 0) & (second[:, j] >= 0)
                        if ok.any():
                            word = (low[ok] ^ first[ok, i]) | (high[ok] ^ second[ok, j]) << LENGTH
                            yield word, prints[ok], x == y == 0


def text_prints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text: XXH64 of its word shingles, repeats
    included; a bit is 1 if it is set in over half of them."""
    hashes: list[int] = []
    starts, sizes = [], []
    digest = xxhash.xxh64_intdigest
    for t in texts:
        starts.append(len(hashes))
        tokens = blank_words(t)
        if len(tokens) <= shingle:
            if tokens:
                hashes.append(digest(b" ".join(tokens), SEED))
        else:
            hashes += [digest(b" ".join(tokens[i : i + shingle]), SEED) for i in range(len(tokens) - shingle + 1)]
        sizes.append(len(hashes) - starts[-1])
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts = np.add.reduceat(bits, np.array(starts)[full], axis=0, dtype=np.int64)
        ones = counts * 2 > np.array(sizes)[full, None]
        out[full] = np.packbits(ones, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: Column | None = None) -> DataFrame:
    """doc_id, print (the 64 bits as a signed long) and, if a key is given, row_key
    of every whole text.  Null and wordless texts have print 0.  Repeated rows
    stay; no shuffle."""
    kept = ["doc_id"] if key is None else ["doc_id", "row_key"]
    carried = [] if key is None else [key.alias("row_key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "text")
            parts = [text_prints(texts[a:b], shingle) for a, b in chunks(texts, 1 << 20)]
            prints = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(prints.view(np.int64))], [*kept, "print"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carried).mapInArrow(
        run, ", ".join(f"{c} long" for c in [*kept, "print"]))


def _replicas(prints: DataFrame, threshold: int, homes_only: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = CoveringCode(threshold)
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for anchor, p, home in code.anchors(own):
                if home or not homes_only:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(p.view(np.int64)), pa.array(np.full(len(p), not home))],
                        ["anchor", "print", "away"])

    return prints.select("print").mapInArrow(run, "anchor long, print long, away boolean")


def _linked(rows: np.ndarray, homes: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between homes and rows of one anchor, each pair at its smaller
    fingerprint.  Rows that earlier links connect share a label; a home is
    linked to one row of each label near it."""
    label = np.arange(len(rows))
    for h in homes:
        near = np.flatnonzero((np.bitwise_count(rows ^ h) <= threshold) & (rows > h))
        if len(near):
            met, first = np.unique(label[near], return_index=True)
            own = label[rows == h][:1]
            new = near[first[met != own[0]]] if len(own) else near[first]
            if len(new):
                yield np.full(len(new), h), rows[new]
            together = np.concatenate((met, own))
            if len(together) > 1:
                label[np.isin(label, together)] = together[0]


def _compare(dealt: DataFrame, threshold: int) -> DataFrame:
    """Links found per anchor.  Rows come sorted by anchor, homes first; a task
    holds the homes of one anchor (at most CROWDED) and a block of its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, homes = None, np.zeros(0, np.uint64)
        for batch in batches:
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            home = ~np.asarray(batch.column("away").to_numpy(zero_copy_only=False), bool)
            if not len(anchor):
                continue
            edge = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1, [len(anchor)]))
            many = np.add.reduceat(home.astype(np.int64), edge[:-1])
            size = np.diff(edge)
            # groups without a home, or with a home alone, need no comparison; the first and last may continue
            wanted = (many > 0) & (size > 1)
            wanted[0] = wanted[-1] = True
            out = []
            for g in np.flatnonzero(wanted).tolist():
                a, b = edge[g], edge[g + 1]
                own = prints[a : a + many[g]]
                before = homes if anchor[a] == last else np.zeros(0, np.uint64)
                # homes seen in an earlier block meet this block; this block's homes meet this block and, sorted, no earlier rows but homes
                if len(before):
                    out += _linked(prints[a:b], before, threshold)
                    if len(own):
                        out += _linked(before, own, threshold)
                if len(own):
                    out += _linked(prints[a:b], own, threshold)
                if g == len(size) - 1:
                    homes, last = np.concatenate((before, own)), anchor[a]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[i] for x in out]).view(np.int64)) for i in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _ball_links(prints: DataFrame, threshold: int) -> DataFrame:
    """Links between fingerprints of crowded anchors, however many they are: each
    goes to the words within half the threshold of it (65 for 2 bits), where at
    most as many meet, all of which are within the threshold of each other."""
    if threshold != 2:
        raise ValueError("crowded anchors are handled for a threshold of 2 bits")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    words = prints.select("print", F.explode(F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))).alias("word"))
    met = words.groupBy("word").agg(F.collect_set("print").alias("met")).where(F.size("met") > 1)
    return met.select(F.explode("met").alias("a"), F.array_min("met").alias("b")).where("a <> b").distinct()


def near_links(prints: DataFrame, threshold: int = THRESHOLD, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column print) within
    ``threshold`` differing bits; not every such pair, but enough of them that
    the connected components are those of all pairs.

    ``prints`` must be cheap to read again (a stored table).  Anchors that are
    home to more than ``crowded`` fingerprints are left out of the comparison
    and their fingerprints linked by :func:`_ball_links`, so no task compares an
    unbounded group with itself.
    """
    replicas = _replicas(prints, threshold, homes_only=False)
    homes = _replicas(prints, threshold, homes_only=True)
    full = stored(homes.groupBy("anchor").count().where(F.col("count") > crowded).select("anchor"), "crowded-anchors")
    extra = None
    if not full.isEmpty():
        extra = _ball_links(replicas.join(full, "anchor", "left_semi").select("print").distinct(), threshold)
        replicas = replicas.join(full, "anchor", "left_anti")
    dealt = replicas.repartition(task_count(prints.sparkSession), "anchor").sortWithinPartitions("anchor", "away", "print")
    found = _compare(dealt, threshold)
    return found.union(extra) if extra is not None else found


def _labelled(docs: DataFrame, shingle: int, threshold: int, key: Column | None = None) -> DataFrame:
    """The fingerprints of all rows and the least label of each row's component
    (column least): its doc_id or, if rows have a key, the struct (missing,
    doc_id, row_key), by which null doc_ids come last."""
    label = F.col("doc_id") if key is None else F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")
    own = stored(fingerprints(docs, shingle, key), "prints")
    nodes = stored(own.groupBy("print").agg(F.min(label).alias("least")), "print-nodes")
    roots = components(near_links(nodes, threshold))
    members = roots.join(nodes.withColumnRenamed("print", "node"), "node")
    named = members.groupBy("root").agg(F.min("least").alias("group_least"))
    linked = members.join(named, "root").select(F.col("node").alias("print"), "group_least")
    classes = stored(
        nodes.join(linked, "print", "left").select("print", F.coalesce("group_least", "least").alias("least")), "print-classes")
    return own.join(classes, "print")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, print, component_id (smallest doc_id reachable over links of at
    most ``threshold`` differing bits) of every document.

    Equal fingerprints are one node, so a group of copies of any size costs one
    row beyond the first aggregation, which combines on the map side.  Null
    doc_ids never name a component (it is null if all its doc_ids are); repeated
    rows share theirs; an empty table gives no rows.
    """
    return _labelled(docs, shingle, threshold).select("doc_id", "print", F.col("least").alias("component_id"))


def simhash_report(docs: DataFrame) -> DataFrame:
    """op4: fingerprint and component of every document."""
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row (all its columns) of each component: that of the smallest doc_id,
    null ones last, and among those the one of the smallest row hash.

    Rows are told apart by doc_id and the hash of their columns (maps left out),
    so neither null, reused nor repeated doc_ids matter.  Rows that go are
    anti-joined; rows that stand several times, and are to stay, are reduced to
    one by an aggregation that combines on the map side.
    """
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    key = F.xxhash64(*hashed)
    stays = (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("row_key") == F.col("least.row_key"))).alias("stays")
    marked = stored(
        _labelled(docs, SHINGLE, THRESHOLD, key).groupBy("doc_id", "row_key", stays).count().where("not stays or count > 1")
        .select(F.col("doc_id").alias("row_id"), F.col("row_key").alias("row_hash"), "stays"), "near-duplicate-rows")
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), key.alias("row_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = lambda other: rows["row_id"].eqNullSafe(other["row_id"]) & (rows["row_hash"] == other["row_hash"])
    kept = rows.join(marked, same(marked), "left_anti").select("row.*")
    repeated = marked.where("stays")
    if repeated.isEmpty():
        return kept
    once = rows.join(repeated, same(repeated), "left_semi").groupBy("row_id", "row_hash").agg(F.first("row").alias("row"))
    return kept.union(once.select("row.*"))
