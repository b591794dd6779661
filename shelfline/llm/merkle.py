"""Document fingerprints: a Merkle tree over phrases, paragraphs and sections.
Equal roots mean equal texts; branches that differ locate edits, branches that
agree measure likeness."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import task_count, utf8

#: Leaf digests that a fingerprint carries (the smallest ones), hex digits of each.
SKETCH, DIGITS = 64, 8
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    up, down = np.full(_BLOCK, _BASE, _U), np.full(_BLOCK, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Phrases:
    """Cuts texts into phrases at content-defined places: at every line end, and
    after about every third word, chosen by the word's last two bytes."""

    def __init__(self) -> None:
        self.up, self.down = _powers()

    def cuts(self, text: bytes) -> np.ndarray:
        """Where the phrases of a block of text end."""
        b = np.frombuffer(text, np.uint8)
        line = b == 0x0A
        space = b == 0x20
        last = np.zeros(len(b), np.int64)
        last[1:] = b[:-1]
        last[2:] += b[:-2].astype(np.int64) * 7
        cut = line | (space & (last % 3 == 0))
        ends = np.flatnonzero(cut)
        bounds = np.concatenate(([-1], ends, [len(b)]))
        for i in np.flatnonzero(np.diff(bounds) > 96).tolist():  # no chosen word for long: every eighth
            gap = np.flatnonzero(space[bounds[i] + 1 : bounds[i + 1]])[7::8] + bounds[i] + 1
            cut[gap] = True
        ends = np.flatnonzero(cut) + 1
        return ends if len(ends) and ends[-1] == len(b) else np.append(ends, len(b))

    def digests(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ends and 64-bit digests of the phrases of a text, in order."""
        all_ends, all_digests = [], []
        for at in range(0, len(text), _BLOCK):
            block = text[at : at + _BLOCK]
            ends = self.cuts(block)
            sums = np.concatenate((np.zeros(1, _U), np.cumsum((np.frombuffer(block, np.uint8).astype(_U) + _U(1)) * self.up[: len(block)])))
            starts = np.concatenate(([0], ends[:-1]))
            h = (sums[ends] - sums[starts]) * self.down[starts]
            h ^= (ends - starts).astype(_U) * _U(0xC2B2AE3D27D4EB4F)
            for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
                h = (h ^ (h >> _U(shift))) * _U(factor)
            all_ends.append(ends + at)
            all_digests.append(h ^ (h >> _U(33)))
        if not all_ends:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        return np.concatenate(all_ends), np.concatenate(all_digests)


@dataclass
class Node:
    """A phrase, paragraph, section or document: its byte range and digest."""

    level: str
    first: int
    after: int
    digest: bytes


def tree(text: bytes) -> list[Node]:
    """Paragraphs (lines with their end), then sections, then the root.

    A section ends after an empty line, or after a paragraph whose digest is
    divisible by 8, so that an edit changes one section as a rule and later ones
    keep their digests.  The root's digest covers the sections' digests and the
    length; the empty text is one root without children.
    """
    paragraphs, sections = [], []
    at = begin = 0
    held: list[bytes] = []
    for line in re.findall(rb"[^\n]*\n|[^\n]+", text):
        d = _digest(line)
        paragraphs.append(Node("paragraph", at, at + len(line), d))
        held.append(d)
        at += len(line)
        if d[0] % 8 == 0 or not line.strip():
            sections.append(Node("section", begin, at, _digest(b"".join(held))))
            begin, held = at, []
    if held:
        sections.append(Node("section", begin, at, _digest(b"".join(held))))
    root = Node("root", 0, at, _digest(len(text).to_bytes(8, "big") + b"".join(s.digest for s in sections)))
    return [*paragraphs, *sections, root]


def differing(a: bytes, b: bytes) -> list[tuple[int, int]]:
    """Byte ranges of paragraphs of ``b`` that ``a`` does not have, found top
    down: equal roots end the search, sections of equal digest are skipped."""
    one, two = tree(a), tree(b)
    if one[-1].digest == two[-1].digest:
        return []
    same = {n.digest for n in one if n.level == "section"}
    open_ranges = [(n.first, n.after) for n in two if n.level == "section" and n.digest not in same]
    known = {n.digest for n in one if n.level == "paragraph"}
    out: list[tuple[int, int]] = []
    for n in two:
        if n.level == "paragraph" and n.digest not in known and any(x <= n.first < y for x, y in open_ranges):
            if out and out[-1][1] == n.first:
                out[-1] = (out[-1][0], n.after)
            else:
                out.append((n.first, n.after))
    return out


class Tree:
    """The whole tree of a text: the nodes of :func:`tree` and, as leaves below the
    paragraphs, all phrases (their ends and digests)."""

    def __init__(self, text: bytes, phrases: Phrases):
        nodes = tree(text)
        self.size, self.root = len(text), nodes[-1].digest
        self.paragraphs = [n for n in nodes if n.level == "paragraph"]
        self.sections = [n for n in nodes if n.level == "section"]
        self.ends, self.digests = phrases.digests(text)

    def below(self, sections: list[Node]) -> list[Node]:
        """The paragraphs of the sections."""
        firsts = [p.first for p in self.paragraphs]
        return [p for s in sections for p in self.paragraphs[bisect_left(firsts, s.first) : bisect_left(firsts, s.after)]]

    def leaves(self, paragraphs: list[Node]) -> tuple[np.ndarray, np.ndarray]:
        """Digests and bytes of the phrases of the paragraphs."""
        starts = np.concatenate((np.zeros(1, np.int64), self.ends[:-1]))[: len(self.ends)]
        edge = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edge, np.searchsorted(starts, [p.first for p in paragraphs]), 1)
        np.add.at(edge, np.searchsorted(starts, [p.after for p in paragraphs]), -1)
        inside = np.cumsum(edge[:-1]) > 0
        return self.digests[inside], (self.ends - starts)[inside]

    def phrases(self) -> list[Node]:
        """The leaves as nodes."""
        ends = self.ends.tolist()
        return [Node("phrase", a, b, d.to_bytes(8, "big")) for a, b, d in zip([0, *ends], ends, self.digests.tolist(), strict=False)]

    def fingerprint(self) -> str:
        """Root digest (32 hex digits), a colon, and the smallest phrase digests."""
        least = np.unique(self.digests >> _U(64 - 4 * DIGITS))[:SKETCH]
        return self.root.hex() + ":" + "".join(map(f"%0{DIGITS}x".__mod__, least.tolist()))


def fingerprint(text: bytes, phrases: Phrases) -> str:
    return Tree(text, phrases).fingerprint()


def _apart(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node]]:
    """The nodes of each that are left when equal ones are paired off."""
    both = Counter(n.digest for n in a) & Counter(n.digest for n in b)
    out: list[list[Node]] = []
    for nodes in (a, b):
        left = both.copy()
        out.append([])
        for n in nodes:
            if left[n.digest] > 0:
                left[n.digest] -= 1
            else:
                out[-1].append(n)
    return out[0], out[1]


def shared_bytes(a: Tree, b: Tree) -> int:
    """Bytes of the branches that both trees have, found top down: sections of
    equal digest, then paragraphs of the other sections, then phrases of the
    other paragraphs.  A branch counts as often as both have it."""
    if a.root == b.root:
        return a.size
    x, y = _apart(a.sections, b.sections)
    x, y = _apart(a.below(x), b.below(y))
    total = a.size - sum(n.after - n.first for n in x)
    (d, sizes), (e, _) = a.leaves(x), b.leaves(y)
    d, at, n = np.unique(d, return_index=True, return_counts=True)
    e, m = np.unique(e, return_counts=True)
    _, i, j = np.intersect1d(d, e, assume_unique=True, return_indices=True)
    return total + int((np.minimum(n[i], m[j]) * sizes[at[i]]).sum())


def likeness(a: Tree, b: Tree) -> float:
    """1 for equal roots; else the bytes of common branches in those of both
    together (Jaccard), where roots that differ count as one byte, so that only
    equal texts have 1."""
    if a.root == b.root:
        return 1.0
    same = shared_bytes(a, b)
    return same / (a.size + b.size - same + 1)


def merkle_nodes(docs: DataFrame) -> DataFrame:
    """All nodes of every document's tree: doc_id, level, ordinal, first and
    after (bytes), digest.  Null text counts as empty; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True):
                nodes = [*Tree(text, phrases).phrases(), *tree(text)]
                count: dict[str, int] = {}
                ordinals = []
                for n in nodes:
                    ordinals.append(count.get(n.level, 0))
                    count[n.level] = ordinals[-1] + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(nodes), pa.int64()), pa.array([n.level for n in nodes]), pa.array(ordinals, pa.int64()),
                     pa.array([n.first for n in nodes], pa.int64()), pa.array([n.after for n in nodes], pa.int64()),
                     pa.array([n.digest.hex() for n in nodes])],
                    ["doc_id", "level", "ordinal", "first", "after", "digest"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, level string, ordinal long, first long, after long, digest string")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(t, phrases) for t in utf8(batch, "text")])], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def _bucket(column: str, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the value, in two steps of
    about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    upto = lambda array: F.size(F.filter(array, lambda b: b <= F.col(column)))
    first = F.array(*[F.lit(p[0]) for p in parts])
    coarse = F.greatest(upto(first), F.lit(1)) - 1
    fine = F.array(*[F.array(*map(F.lit, p)) for p in parts])
    return coarse * width + upto(F.get(fine, coarse))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and role, dealt to consecutive ranges of doc_id and sorted
    in each: role 0 for the range's own rows, 1 for a copy of the row that
    follows its last one, 2 for that of the table's first row behind the table's
    last.

    The ranges begin at quantiles of doc_id, which are doc_ids themselves, so the
    rows to copy are known before the shuffle and texts are shuffled once.  Null
    doc_ids come last; rows with the same doc_id go by text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = task_count(docs.sparkSession)
    cuts = [k / n for k in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", cuts, 10 * n + 100).alias("cuts"), F.min("doc_id").alias("least")).first()
    bounds = sorted({b for b in found.cuts or [] if b != found.least})
    last = len(bounds)
    own = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(_bucket("doc_id", bounds))
    begins = F.array(*[F.lit(b).cast("long") for b in [None, *bounds]])
    copy = lambda where, to, role: F.when(where, F.struct(to.alias("range"), F.lit(role).alias("role")))
    places = F.array_compact(F.array(
        F.struct(F.col("own").alias("range"), F.lit(0).alias("role")),
        copy((F.col("own") > 0) & (F.get(begins, F.col("own")) == F.col("doc_id")), F.col("own") - 1, 1),
        copy(F.col("doc_id").eqNullSafe(F.lit(found.least).cast("long")), F.lit(last), 2)))
    return (
        rows.withColumn("own", own).select("doc_id", "text", F.explode(places).alias("place"))
        .select("doc_id", "text", "place.range", "place.role")
        .repartitionById(last + 1, F.col("range").cast("int"))
        .sortWithinPartitions(F.col("role") == 2, F.col("doc_id").asc_nulls_last(), "text", "role")
    )


REPORT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def merkle_report(docs: DataFrame) -> DataFrame:
    """op6: fingerprints of every document and of its edit with the next one, and
    how like it they are by the branches of their trees.

    Null text counts as empty; in a table of one row the next document is the
    row itself; an empty table gives no rows.  A task holds two texts and
    three trees at a time besides its Arrow batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        held = None
        for batch in batches:
            out = []
            for doc, text, role in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "role")), strict=True):
                text = text or ""
                if held is None and role:
                    continue
                own = Tree(text.encode("utf-8"), phrases)
                if held is not None:
                    before, old, whole = held
                    cut = len(old) // 4
                    edited = (old[: len(old) - cut] + text[:cut]).encode("utf-8")
                    changed = Tree(edited, phrases)
                    out.append((before, len(old), hashlib.sha256(edited).hexdigest(), whole.fingerprint(), changed.fingerprint(),
                                likeness(whole, changed), likeness(whole, own)))
                held = (doc, text, own) if role == 0 else None
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [f.split()[0] for f in REPORT.split(", ")])

    return in_order(docs).select("doc_id", "text", "role").mapInArrow(run, REPORT)
