"""License scan: a generalised suffix automaton of licence templates reads each
document's words once (matching statistics); long matches are chained into
covered template spans."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import utf8, words

# Phrases whose every occurrence is a base place.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

# Sections and short notices of common licences.
TEMPLATES = {
    "mit-notice": "released under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so"
    ),
    "mit-conditions": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "mit-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited "
        "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
        "shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software"
    ),
    "apache-1.1": "licensed under the apache license version 1 1",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or "
        "conditions of any kind either express or implied"
    ),
    "gpl-2.0": "licensed under the gnu general public license version 2",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "lgpl-2.1": "licensed under the gnu lesser general public license version 2 1",
    "lgpl-3.0": "licensed under the gnu lesser general public license version 3",
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted"
    ),
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-4.0": "licensed under cc by 4 0",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

# What must stand unbroken in a template's span, so that its neighbours
# by name or version are not taken for it.
DECISIVE = {
    "mit-notice": "the mit license",
    "apache-1.1": "apache license version 1 1",
    "apache-2.0": "apache license version 2 0",
    "apache-2.0-header": "license 2 0",
    "gpl-2.0": "gnu general public license version 2",
    "gpl-3.0": "gnu general public license version 3",
    "lgpl-2.1": "gnu lesser general public license version 2 1",
    "lgpl-3.0": "gnu lesser general public license version 3",
    "agpl-3.0": "gnu affero general public license version 3",
    "gpl-header": "gnu general public license",
    "cc-by-nc-4.0": "cc by nc 4 0",
    "cc-by-4.0": "cc by 4 0",
    "mpl-2.0": "mozilla public license v 2 0",
}

SCAN_SCHEMA = (
    "doc_id long, n_words long, "
    "spans array<struct<label:string,kind:string,first_word:long,n_words:long,coverage:double>>"
)


class TemplateAutomaton:
    """Generalised suffix automaton over word sequences.

    ``step``/``link``/``length`` are the usual arrays; ``ends[state]`` holds
    (template, end position) of every occurrence of the state's strings and
    ``phrases[state]`` the phrases that are a suffix of them.
    """

    def __init__(self, templates: list[list[int]], phrases: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate([*templates, *phrases]):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token, ends)
                if t < len(templates):
                    ends[last].add((t, i + 1))
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[v]] |= ends[v]
        self.ends = [sorted(e) for e in ends]
        own: dict[int, list[tuple[int, int]]] = {}
        for p, sequence in enumerate(phrases):
            v = 0
            for token in sequence:
                v = self.step[v][token]
            own.setdefault(v, []).append((p, len(sequence)))
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.phrases[v] = self.phrases[self.link[v]] + own.get(v, [])

    def _state(self, length: int, link: int, step: dict[int, int], ends: list[set]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, v: int, token: int, ends: list[set]) -> int:
        """The state for ``v``'s longest string plus ``token``, cloned if it stands for longer ones."""
        to = self.step[v][token]
        if self.length[to] == self.length[v] + 1:
            return to
        clone = self._state(self.length[v] + 1, self.link[to], dict(self.step[to]), ends)
        self.link[to] = clone
        while v >= 0 and self.step[v].get(token) == to:
            self.step[v][token] = clone
            v = self.link[v]
        return clone

    def _extend(self, last: int, token: int, ends: list[set]) -> int:
        if token in self.step[last]:
            return self._split(last, token, ends)
        new = self._state(self.length[last] + 1, 0, {}, ends)
        v = last
        while v >= 0 and token not in self.step[v]:
            self.step[v][token] = new
            v = self.link[v]
        if v >= 0:
            self.link[new] = self._split(v, token, ends)
        return new

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """For each position: the state and length of the longest match that ends there."""
        step, link, length = self.step, self.link, self.length
        v = n = 0
        for token in sequence:
            while v and token not in step[v]:
                v = link[v]
                n = length[v]
            if token in step[v]:
                v = step[v][token]
                n += 1
            yield v, n


class LicenseScanner:
    """The automaton with its vocabulary and the rules for phrases and spans."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str], min_match: int, max_gap: int,
                 min_coverage: float, decisive: dict[str, str] | None = None):
        self.vocabulary: dict[bytes, int] = {}
        ids = lambda text: [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text.encode())]
        self.labels, self.phrase_labels = list(templates), list(phrases)
        parts = [ids(t) for t in templates.values()]
        self.sizes = [len(p) for p in parts]
        self.automaton = TemplateAutomaton(parts, [ids(p) for p in phrases.values()])
        self.min_match, self.max_gap, self.min_coverage = min_match, max_gap, min_coverage
        self.decisive = [self._place(p, ids((decisive or {}).get(label, ""))) for label, p in zip(templates, parts, strict=True)]

    @staticmethod
    def _place(template: list[int], part: list[int]) -> tuple[int, int] | None:
        """Where ``part`` stands last in the template; none if there is nothing to find."""
        if not part:
            return None
        starts = [i for i in range(len(template) - len(part) + 1) if template[i : i + len(part)] == part]
        if not starts:
            raise ValueError("a decisive part must stand in its template")
        return starts[-1], starts[-1] + len(part)

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, str, int, int, float]]]:
        """Number of words, and (label, kind, first word, words, coverage) by first word."""
        tokens = words(text)
        get = self.vocabulary.get
        spans: list[tuple[str, str, int, int, float]] = []
        chains: dict[int, list[int]] = {}
        run: list[int] = []
        start = 0
        for i, w in enumerate(tokens):
            if (k := get(w)) is not None:
                if not run:
                    start = i
                run.append(k)
            elif run:
                if len(run) > 1:
                    self._run(start, run, spans, chains)
                run = []
        if len(run) > 1:
            self._run(start, run, spans, chains)
        for t in chains:
            self._close(t, chains[t], spans)
        return len(tokens), sorted(spans, key=lambda s: (s[2], s[1], s[0]))

    def _run(self, start: int, run: list[int], spans: list, chains: dict) -> None:
        """One run of words that all occur in templates."""
        a = self.automaton
        before = (0, 0)
        for i, (v, n) in enumerate(a.statistics(run), start):
            for p, size in a.phrases[v]:
                if size <= n:
                    spans.append((self.phrase_labels[p], "phrase", i - size + 1, size, 1.0))
            if before[1] >= self.min_match and n <= before[1]:
                self._match(i, *before, spans, chains)
            before = v, n
        if before[1] >= self.min_match:
            self._match(start + len(run), *before, spans, chains)

    def _match(self, end: int, state: int, n: int, spans: list, chains: dict) -> None:
        """A match that cannot grow to the right joins its template's chain, or ends it and begins one.
        A chain is [first word, end, end in template, covered template words, has the decisive part]."""
        for t, t_end in self.automaton.ends[state]:
            chain = chains.get(t)
            part = self.decisive[t]
            has = part is None or (t_end - n <= part[0] and part[1] <= t_end)
            if chain and t_end > chain[2] and end - n - chain[1] <= self.max_gap:
                chain[3] += min(n, t_end - chain[2])
                chain[1], chain[2], chain[4] = end, t_end, chain[4] or has
            elif chain and end == chain[1]:
                continue
            else:
                if chain:
                    self._close(t, chain, spans)
                chains[t] = [end - n, end, t_end, n, has]

    def _close(self, t: int, chain: list[int], spans: list) -> None:
        coverage = min(1.0, chain[3] / self.sizes[t])
        if coverage >= self.min_coverage and chain[4]:
            spans.append((self.labels[t], "template", chain[0], chain[1] - chain[0], coverage))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
                 min_match: int = 3, max_gap: int = 8, min_coverage: float = 0.7,
                 decisive: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, spans (phrases, and chained template
    spans covering at least ``min_coverage`` of their template's words and, where
    ``decisive`` names one, that part of the template unbroken), in order.

    Null text counts as empty: no words, no spans.  A null doc_id stays null,
    repeated rows are scanned each, other columns are not read.  The templates
    are a parameter of a few thousand words and travel with the task; documents
    are read once, without a shuffle.
    """
    if templates is None:
        templates, decisive = TEMPLATES, DECISIVE if decisive is None else decisive
    scanner = LicenseScanner(templates, phrases or PHRASES, min_match, max_gap, min_coverage, decisive)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()),
                                   ("n_words", pa.int64()), ("coverage", pa.float64())]))
        names = ("label", "kind", "first_word", "n_words", "coverage")
        for batch in batches:
            found = [scanner.scan(t) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[dict(zip(names, s, strict=True)) for s in spans] for _, spans in found], kind)],
                ["doc_id", "n_words", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, SCAN_SCHEMA)


def license_report(docs: DataFrame) -> DataFrame:
    """op1: base places, labels and score of every document.

    score is the best coverage of a template or phrase (a phrase counts 1), 0
    without any.
    """
    base = F.filter("spans", lambda s: s["kind"] == "phrase")
    starts = F.transform("base", lambda s: s["first_word"])
    joined = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda s: s["label"]))), ",")
    return (
        license_scan(docs)
        .withColumn("base", base)
        .select(
            "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
            joined("base").alias("base_labels"), joined("spans").alias("labels"),
            F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
            F.size(F.filter("spans", lambda s: s["kind"] == "template")).cast("long").alias("n_spans"),
        )
    )
