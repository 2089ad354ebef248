"""The license scan against brute force on a small fixture."""

import re
from re import _constants, _parser

from reelstar.llm import licenses

TEXTS = [None, "", " .,\n", "Released under the MIT License.", "mit license mit license, MIT-LICENSE", "permit license mit licenses",
         "GNU General Public License, version 3. general public license", "Licensed under CC BY-NC 4.0.",
         "Apache License, Version 2.0 ünï MIT\tLicense", "all rights reserved", "no words here " * 3000 + "apache license",
         "SPDX-License-Identifier: GPL-2.0-or-later", "MIT LICENSE", "東京 mit 東京 license"]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(WORD, low)
    spots, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        spots += at
        labels |= {label} if at else set()
    found = []
    norm = " " + " ".join(words) + " " if words else ""
    for i, r in enumerate(licenses.rules()):
        found += [(m.start(), m.end(), r.priority, -i, r.label) for m in re.finditer(f" (?:{r.pattern})(?= )", norm)]
    if len(found) > 3000:      # the same by one pass over the sorted intervals
        best = {}
        for d in sorted(found, key=lambda d: (d[0], -d[1], -d[2], -d[3])):
            if d[1] > best.get("far", -1):
                best["far"] = d[1]
                best.setdefault("kept", []).append(d)
        kept = best["kept"]
    else:
        kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and (e[1] - e[0] > d[1] - d[0] or (e[1] - e[0] == d[1] - d[0] and e[2:4] > d[2:4])) for e in found)]
    return (len(words), len(spots), min(spots, default=None), max(spots, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {d[4] for d in kept})), max((d[2] for d in kept), default=0) / 100)


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "x", 3) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None), (None, "isc license", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, norm int")
    got = sorted((tuple(r)[:8] for r in licenses.scan(docs).collect()), key=str)
    want = sorted(((i, *_brute(t)) for i, t, _, _ in rows), key=str)
    assert got == want
    assert licenses.scan(docs.limit(0)).count() == 0


def test_rules_are_many_and_hold_their_keyword():
    assert len(licenses.rules()) > 200
    text = licenses._GATE
    assert all(re.search(text, f" {r.keyword} ") or "licen" in r.pattern or "public" in r.pattern or "cc" in r.pattern or "license" in r.pattern
               for r in licenses.rules())


def _examples(parsed):
    """Every text that a pattern of alternatives, sets and optional parts matches."""
    out = [""]
    for kind, what in parsed:
        if kind is _constants.LITERAL:
            some = [chr(what)]
        elif kind is _constants.IN:
            some = [chr(c) for _, c in what]
        elif kind is _constants.BRANCH:
            some = [x for branch in what[1] for x in _examples(branch)]
        elif kind is _constants.SUBPATTERN:
            some = _examples(what[3])
        else:
            assert kind is _constants.MAX_REPEAT and what[:2] == (0, 1)
            some = ["", *_examples(what[2])]
        out = [a + b for a in out for b in some]
    return out


def test_every_alternative_passes_its_own_prefilter():
    for r in licenses.rules():
        for text in _examples(_parser.parse(r.pattern)):
            assert f" {r.keyword}" in f" {text} " and re.search(licenses._GATE, f" {text} "), (r, text)


def test_examples_of_every_rule_equal_brute_force(spark):
    texts = sorted({t for r in licenses.rules() for t in (min(_examples(_parser.parse(r.pattern)), key=len),)} | {
        "Distributed under the Expat License.", "X11 licence", "subject to the x11 license", "mitigate the Expat license",
        "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: 0BSD", "spdx license identifier isc",
        "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: Unlicense"})
    got = {texts[r.doc_id]: tuple(r)[1:8] for r in licenses.scan(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {t: _brute(t) for t in texts}
    assert got["Distributed under the Expat License."][5:] == ("mit", 0.8)
    assert got["SPDX-License-Identifier: BSD-3-Clause"][5:] == ("bsd", 0.85)
    assert got["SPDX-License-Identifier: Unlicense"][5] == "unlicense"


def test_text_of_many_hits_is_scanned_once_per_rule(spark):
    text = "Released under the MIT License, not the GNU General Public License, version 2.0. " * 6000
    docs = spark.createDataFrame([(1, text), (2, text[:1200])], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert tuple(got[1])[1:8] == _brute(text) and tuple(got[2])[1:8] == _brute(text[:1200])
    assert len(got[1].detections) == 12000 and got[1].detections == sorted(got[1].detections, key=lambda d: d.lo)
