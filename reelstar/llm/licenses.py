"""License scan by ordered signature rules, in DataFrame functions only.

The text is reduced to its words (A-Z lower-cased, letters and digits, one
space between); a rule is a regular expression over that form, with a label, a
priority and a keyword.  Texts without any keyword stem stop at one regular
expression; for the others only the rules whose keyword occurs are evaluated.
Detections are intervals; one that lies inside an interval that is longer, or
equal with a higher priority (then the earlier rule), is suppressed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    keyword: str     # literal that every match holds
    pattern: str     # over words joined by one space
    label: str
    priority: int    # 1 to 100, the confidence of the signature in percent


# Fixed base phrases of the scan: words that stand consecutively, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_FAMILIES = (  # keyword, names as a pattern, label, versions
    ("general public", "(?:gnu )?general public licen[sc]e", "gpl", ("1", "2", "3")),
    ("lesser general public", "(?:gnu )?lesser general public licen[sc]e", "lgpl", ("2", "2 1", "3")),
    ("library general public", "(?:gnu )?library general public licen[sc]e", "lgpl", ("2",)),
    ("affero general public", "(?:gnu )?affero general public licen[sc]e", "agpl", ("1", "3")),
    ("free documentation", "(?:gnu )?free documentation licen[sc]e", "gfdl", ("1 1", "1 2", "1 3")),
    ("apache", "apache (?:software )?licen[sc]e", "apache", ("1", "1 1", "2")),
    ("mozilla", "mozilla public licen[sc]e", "mpl", ("1", "1 1", "2")),
    ("eclipse", "eclipse public licen[sc]e", "epl", ("1", "2")),
    ("european union", "european union public licen[sc]e", "eupl", ("1", "1 1", "1 2")),
    ("common development", "common development and distribution licen[sc]e", "cddl", ("1", "1 1")),
    ("academic free", "academic free licen[sc]e", "afl", ("1 1", "1 2", "2", "2 1", "3")),
    ("open software", "open software licen[sc]e", "osl", ("1", "1 1", "2", "2 1", "3")),
    ("artistic", "artistic licen[sc]e", "artistic", ("1", "2")),
    ("boost", "boost software licen[sc]e", "bsl", ("1",)),
    ("open font", "(?:sil )?open font licen[sc]e", "ofl", ("1", "1 1")),
    ("latex project", "latex project public licen[sc]e", "lppl", ("1", "1 1", "1 2", "1 3")),
    ("common public", "common public licen[sc]e", "cpl", ("1",)),
    ("microsoft public", "microsoft public licen[sc]e", "ms pl", ()),
    ("server side", "server side public licen[sc]e", "sspl", ("1",)),
    ("python software foundation", "python software foundation licen[sc]e", "psf", ("2",)),
    ("zlib", "zlib (?:libpng )?licen[sc]e", "zlib", ()),
    ("isc", "isc licen[sc]e", "isc", ()),
    ("unlicense", "(?:the )?unlicense", "unlicense", ()),
    ("mit", "mit licen[sc]e", "mit", ()),
    ("expat", "expat licen[sc]e", "mit", ()),
    ("x11", "x11 licen[sc]e", "mit", ()),
    ("bsd", "(?:(?:2|3|4|two|three|four) clause )?bsd (?:style )?licen[sc]e", "bsd", ()),
)
_SHORT = (  # identifiers as they are split into words, and their versions
    ("gpl", ("1", "2", "3")), ("lgpl", ("2", "2 1", "3")), ("agpl", ("1", "3")), ("gfdl", ("1 1", "1 2", "1 3")),
    ("apache", ("1", "1 1", "2")), ("mpl", ("1", "1 1", "2")), ("epl", ("1", "2")), ("eupl", ("1 1", "1 2")),
    ("cddl", ("1", "1 1")), ("afl", ("2 1", "3")), ("osl", ("2 1", "3")), ("bsl", ("1",)), ("ofl", ("1", "1 1")),
    ("lppl", ("1 3",)), ("artistic", ("1", "2")), ("cpl", ("1",)), ("sspl", ("1",)), ("psf", ("2",)),
)
_UNVERSIONED = (  # identifiers without a version, and their labels
    ("mit", "mit"), ("x11", "mit"), ("bsd", "bsd"), ("0bsd", "bsd"), ("isc", "isc"), ("zlib", "zlib"),
    ("unlicense", "unlicense"), ("ms pl", "ms pl"),
)
_TERMS = (  # sentences that a license's own text holds
    ("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 95),
    ("redistribution and use", "redistribution and use in source and binary forms with or without modification", "bsd", 95),
    ("permission to use copy", "permission to use copy modify and or distribute this software for any purpose", "isc", 95),
    ("without any express or implied", "this software is provided as is without any express or implied warranty", "zlib", 90),
    ("released into the public domain", "released into the public domain", "public domain", 80),
    ("all rights reserved", "all rights reserved", "proprietary", 60),
)
_CC_PARTS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
_CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?derivat(?:ive)?s?(?: works)?"}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_GRANTS = ("licensed under", "released under", "distributed under", "available under", "subject to", "under the terms of")


def rules() -> list[Rule]:
    """All signatures, in order: name, name and version, grant and name, identifiers, Creative Commons, terms."""
    out = []
    for keyword, name, label, versions in _FAMILIES:
        out.append(Rule(keyword, name, label, 70))
        for grant in _GRANTS:
            out.append(Rule(keyword, f"{grant} (?:the |an? )?{name}", label, 80))
        for v in versions:
            number = v if " " in v else f"{v}(?: 0)?"
            tag = f"{label} {v.replace(' ', '.')}"
            out.append(Rule(keyword, f"{name} (?:as published by the free software foundation )?(?:either )?(?:version |v)?{number}", tag, 90))
            out.append(Rule(keyword, f"version {number} of the {name}", tag, 90))
    for name, versions in _SHORT:
        out.append(Rule(f"spdx license identifier {name}", f"spdx license identifier {name}", name, 85))
        for v in versions:
            number = v if " " in v else f"{v}(?: 0)?"
            tag = f"{name} {v.replace(' ', '.')}"
            out.append(Rule(f"spdx license identifier {name}", f"spdx license identifier {name} {number}(?: or later| only)?", tag, 99))
            out.append(Rule(name, f"{name} ?v?{number} licen[sc]ed?", tag, 75))
    for name, label in _UNVERSIONED:
        out.append(Rule(f"spdx license identifier {name}", f"spdx license identifier {name}", label, 85))
    for parts in _CC_PARTS:
        label = f"cc {parts}".replace(" ", "-")
        words = " ".join(_CC_WORDS[p] for p in parts.split())
        out.append(Rule("creative commons", f"creative commons {words}", label, 80))
        out.append(Rule("cc by", f"cc {parts}", label, 60))
        for v in _CC_VERSIONS:
            tag = f"{label} {v.replace(' ', '.')}"
            out.append(Rule("creative commons", f"creative commons {words} {v}", tag, 95))
            out.append(Rule("cc by", f"cc {parts} {v}", tag, 90))
    out.append(Rule("cc0", "cc0(?: 1 0)?", "cc0", 90))
    out += [Rule(k, p, label, n) for k, p, label, n in _TERMS]
    return out


PART = 512
_DETECTION = "struct<rule:int,label:string,priority:int,lo:int,hi:int>"
_GATE = r"licen[sc]e|public|spdx|cc0|cc by|creative commons|rights reserved|hereby granted|redistribution|permission to use|express or implied"


def words_form(text: Column) -> Column:
    """The words, each with one space before it, and a last space; empty for no word."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    joined = F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    trimmed = F.trim(joined)
    return F.when(trimmed == "", F.lit("")).otherwise(F.concat(F.lit(" "), trimmed, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(items: Column, start: Column, step) -> Column:
    """Detections that ``step(at, item)`` gives along ``items``; it returns the next
    integer state and a detection, or null for none."""
    none = F.array().cast(f"array<{_DETECTION}>")

    def one(acc: Column, item: Column) -> Column:
        def out(told: Column) -> Column:
            grown = F.when(told["row"].isNotNull(), F.concat(acc["out"], F.array(told["row"]))).otherwise(acc["out"])
            return F.struct(told["at"].alias("at"), grown.alias("out"))

        at, row = step(acc["at"], item)
        return _bound(F.struct(at.alias("at"), row.cast(_DETECTION).alias("row")), out)

    def part(acc: Column, k: Column) -> Column:
        inner = F.aggregate(F.slice(items, k * PART + 1, PART), F.struct(acc["at"].alias("at"), none.alias("out")), one)
        return _bound(inner, lambda v: F.struct(v["at"].alias("at"), F.concat(acc["outs"], F.array(v["out"])).alias("outs")))

    parts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / PART).cast("int"))
    first = F.struct(start.alias("at"), F.array().cast(f"array<array<{_DETECTION}>>").alias("outs"))
    return F.aggregate(parts, first, part, lambda acc: F.flatten(acc["outs"]))


def _detections(norm: Column, some: list[Rule]) -> Column:
    """Array of (rule, label, priority, lo, hi) character intervals of every match."""
    table = F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(f" {r.keyword} ").alias("keyword"),
                               F.lit(f" (?:{r.pattern})(?= )").alias("pattern"), F.lit(r.label).alias("label"),
                               F.lit(r.priority).alias("priority")) for i, r in enumerate(some)))

    def of(r: Column) -> Column:
        def placed(hits: Column) -> Column:
            gaps = F.slice(F.split(norm, r["pattern"], -1), 1, F.size(hits))
            pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))

            def step(at: Column, p: Column) -> tuple[Column, Column]:
                lo = at + F.length(p["gap"])
                hi = lo + F.length(p["hit"])
                return hi, F.struct(r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"),
                                    lo.alias("lo"), hi.alias("hi"))

            return F.when(F.size(hits) > 0, _bound(pairs, lambda p: _running(p, F.lit(0), step))).otherwise(
                F.array().cast(f"array<{_DETECTION}>"))

        return _bound(F.regexp_extract_all(norm, r["pattern"], F.lit(0)), placed)

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(norm, F.rtrim(r["keyword"]))), of))


def _suppressed(found: Column) -> Column:
    """Detections that no stronger interval contains, by start."""
    keyed = F.array_sort(F.transform(found, lambda d: F.struct(
        d["lo"].alias("lo"), (-d["hi"]).alias("back"), (-d["priority"]).alias("low"), d["rule"].alias("rule"), d["label"].alias("label"))))

    def step(far: Column, k: Column) -> tuple[Column, Column]:
        hi = -k["back"]
        row = F.struct(k["rule"].alias("rule"), k["label"].alias("label"), (-k["low"]).alias("priority"), k["lo"].alias("lo"), hi.alias("hi"))
        return F.greatest(far, hi), F.when(hi > far, row)

    return _bound(keyed, lambda items: _running(items, F.lit(-1), step))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    A null or empty text has no word and no label; score is the highest
    priority among the detections that stay, in percent.  Repeated rows and ids
    repeat, a null doc_id stays null, other columns are not read.
    """
    norm = F.col("norm")
    with_norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_form(F.col("text")).alias("norm"))
    n_words = F.greatest(_spaces(norm) - 1, F.lit(0)).cast("long")
    rows = with_norm.withColumn("n_words", n_words).withColumn(
        "detections", F.when(norm.rlike(_GATE), _suppressed(_detections(norm, rules())))
        .otherwise(F.array().cast(f"array<{_DETECTION}>")))
    n_base, first, last, labels = [], [], [], []
    for phrase, label in BASE:
        key = f" {phrase} "
        there = F.contains(norm, F.lit(key))
        n_base.append(F.when(there, F.regexp_count(norm, F.lit(f" {phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, _spaces(F.substring_index(norm, key, 1))))
        last.append(F.when(there, F.col("n_words") - _spaces(F.substring_index(norm, key, -1)) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    base = F.array_compact(F.array(*labels))
    method = F.transform("detections", lambda d: d["label"])
    out = rows.select("doc_id", "n_words", sum(n_base[1:], n_base[0]).cast("long").alias("n_base"),
                      F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
                      F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.array_distinct(F.concat(base, method))), ",").alias("labels"),
                      F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])) / 100.0, F.lit(0.0))
                      .cast("double").alias("score"), "detections")
    return out
