import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.llm.licenses import DECISIVE, PHRASES, TEMPLATES, LicenseScanner, TemplateAutomaton, license_report, license_scan
from tests.llm.helpers import awkward, docs, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label) for label, p in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=8), min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=20))
def test_matching_statistics(templates, text):
    a = TemplateAutomaton(templates, [])
    known = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for end, (state, n) in enumerate(a.statistics(text), 1):
        best = max((k for k in range(end + 1) if k == 0 or tuple(text[end - k:end]) in known))
        assert n == best
        if n:
            expected = {(t, j) for t, s in enumerate(templates) for j in range(n, len(s) + 1) if s[j - n:j] == text[end - n:end]}
            assert expected == set(a.ends[state])


def test_report_equals_brute_force(spark):
    sep = " \n-x, "
    texts = ["Released under the MIT License.", "the mit\nLICENSE mit license apache-license", "GNU General Public License, version 3",
             "general public public license", "mit", sep.join(["MIT License"] * 3), TEMPLATES["bsd"], "plain words only", None,
             "mitlicense mit  license é mit é license", "Licensed under the Apache License, Version 2.0 " * 2]
    rows = {r.doc_id: r for r in license_report(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert "bsd" in rows[6].labels and rows[6].score == 1 and rows[7].labels == "" and rows[7].score == 0
    assert "apache-2.0" in rows[10].labels and rows[10].n_spans == 2


def test_chained_span_over_changed_words():
    scanner = LicenseScanner(TEMPLATES, PHRASES, 3, 8, 0.7, DECISIVE)
    words = TEMPLATES["mit-grant"].split()
    words[10:12] = ["some", "other", "thing"]
    n, spans = scanner.scan(("before it " + " ".join(words) + " after").encode())
    own = [s for s in spans if s[0] == "mit-grant"]
    assert len(own) == 1 and own[0][2] == 2 and own[0][3] == len(words) and 0.9 < own[0][4] < 1


def test_awkward_rows(spark):
    assert license_report(awkward(spark)).count() == 10
    assert license_scan(empty(spark)).count() == 0
    assert {(r.n_words, r.labels, r.score) for r in license_report(docs(spark, [None, "", " "])).collect()} == {(0, "", 0.0)}


def test_versions_are_told_apart(spark):
    cases = {
        "Licensed under the GNU General Public License version 2": {"gpl-2.0"},
        "Licensed under the GNU General Public License, version 3.": {"gpl-3.0"},
        "licensed under the GNU Affero General Public License version 3": {"agpl-3.0"},
        "licensed under the GNU Lesser General Public License, version 2.1": {"lgpl-2.1"},
        "licensed under the GNU Lesser General Public License version 3": {"lgpl-3.0"},
        "licensed under the Apache License version 1.1": {"apache-1.1"},
        "licensed under the Apache License, Version 2.0": {"apache-2.0"},
        "licensed under the Apache License": set(),
        "licensed under CC BY 4.0": {"cc-by-4.0"},
        "licensed under CC BY-NC 4.0": {"cc-by-nc-4.0"},
        "licensed under CC BY-NC 3.0": set(),
        TEMPLATES["gpl-header"].replace("gnu general", "gnu lesser general"): set(),
        TEMPLATES["mpl-2.0"].replace("2 0", "1 1"): set(),
    }
    found = {r.doc_id: set(r.labels.split(",")) - {"", *PHRASES} for r in license_report(docs(spark, list(cases))).collect()}
    assert found == dict(enumerate(cases.values()))


def test_every_section_is_found_by_itself():
    scanner = LicenseScanner(TEMPLATES, PHRASES, 3, 8, 0.7, DECISIVE)
    assert set(DECISIVE) < set(TEMPLATES)
    for label, text in TEMPLATES.items():
        spans = scanner.scan(("before it " + text + " after").encode())[1]
        assert [s[2:] for s in spans if s[0] == label] == [(2, len(text.split()), 1.0)], label
