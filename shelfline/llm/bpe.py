"""Token counts by byte-pair merging with a heap over a linked list: the count is
the number of initial symbols minus the number of merges; no ids are made."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import broadcast_object

COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long"

# Fixed value: the published byte-level pre-tokenizer pattern, white space by Unicode property.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


# Unicode White_Space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_PAIRS = [" " + c for c in WHITE_SPACE]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for U+0100 onwards in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def load_merges(path: str) -> tuple[list[str], list[str]]:
    """Merge rules ("left right", best first) and special strings of a byte-level
    BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
        raise ValueError("expected a byte-level BPE file without normalizer")
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    return merges, [t["content"] for t in spec["added_tokens"] if t["special"]]


class MergeCounter:
    """Token counts by merge rules.

    Symbols are numbers; ``rank`` maps two adjacent ones (``left << 20 | right``)
    to their merge rule and ``result`` a rule to the merged symbol.  Counts of
    pieces and of space-separated units are kept, up to ``size`` of each, then
    forgotten, so memory stays bounded.  A worker keeps the object between tasks.
    """

    def __init__(self, merges: list[str], special: list[str], size: int):
        self.merges, self.special, self.size = merges, special, size
        self.rank: dict[int, int] = {}

    def _prepare(self) -> None:
        letters = byte_letters()
        ids = {c: i for i, c in enumerate(letters)}
        self.result: list[int] = []
        for r, m in enumerate(self.merges):
            left, right = m.split(" ")
            self.result.append(ids.setdefault(left + right, len(ids)))
            self.rank[ids[left] << 20 | ids[right]] = r
        # one symbol per byte: UTF-8 bytes are the first 256 symbols themselves
        self.find = regex.compile(PIECES).findall
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).split if self.special else None
        self.pieces: dict[str, int] = {}
        self.units: dict[str, int] = {}

    def merged_length(self, symbols: list[int]) -> int:
        """Symbols left after merging the lowest-rank adjacent pair, leftmost
        first, until no pair has a rule.  O(n log n) for n symbols."""
        get, result = self.rank.get, self.result
        # rules[i]: the rule of symbol i with the next one left, -1 for none; the heap has rule << 32 | i
        rules = [get(a << 20 | b, -1) for a, b in pairwise(symbols)]
        rules.append(-1)
        heap = [r << 32 | i for i, r in enumerate(rules) if r >= 0]
        n = left = len(symbols)
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        while heap:
            entry = heappop(heap)
            i, rule = entry & 0xFFFFFFFF, entry >> 32
            if rules[i] != rule:
                continue  # one of the two has merged meanwhile
            j = after[i]
            k = after[j]
            rules[j] = rules[i] = -1
            after[i] = k
            before[k] = i
            symbol = symbols[i] = result[rule]
            left -= 1
            if k < n and (r := get(symbol << 20 | symbols[k])) is not None:
                rules[i] = r
                heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0:
                rules[h] = r = get(symbols[h] << 20 | symbol, -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        return left

    def _piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            n = self.merged_length(list(piece.encode("utf-8")))
            if len(piece) <= 64:
                if len(self.pieces) >= self.size:
                    self.pieces.clear()
                self.pieces[piece] = n
        return n

    def _unit(self, unit: str) -> int:
        """Tokens of a space and ``unit``."""
        n = sum(map(self._piece, self.find(" " + unit)))
        if len(unit) <= 64:
            if len(self.units) >= self.size:
                self.units.clear()
            self.units[unit] = n
        return n

    def count(self, text: str) -> int:
        if not self.rank:
            self._prepare()
        if not self.cut:
            return self._plain(text)
        parts = self.cut(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        """A piece begins at every space with no white space before or none
        after it, so most texts can be cut at their spaces."""
        if any(p in text for p in SPACE_PAIRS):
            return sum(map(self._piece, self.find(text)))
        first, *units = text.split(" ")
        get = self.units.get
        n = sum(map(self._piece, self.find(first)))
        for u in units:
            k = get(u)
            n += k if k is not None else self._unit(u)
        return n


def token_counts(docs: DataFrame, path: str, cached_pieces: int = 600_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text, as the vocabulary file's own
    library counts them (no added tokens; special strings in a text are one token).

    Null text counts as empty (0 tokens); repeated rows and null doc_ids are
    counted like any other; other columns are not read.  One pass, no shuffle;
    the merge rules (a vocabulary file, about a megabyte) are broadcast.
    """
    counter = broadcast_object(docs.sparkSession, MergeCounter(*load_merges(path), cached_pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter().count
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                 pa.array([tokens(t) for t in texts], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, COUNT_SCHEMA)


def token_report(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """op8: counts of every document and whether they exceed ``limit``."""
    return token_counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
