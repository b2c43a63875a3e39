"""Base phrases against a plain scan; suppression and labels on small texts; no Python in the plan."""

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, lowered, words
from touchpoint.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def base(text):
    own = lowered(text, WORD)
    hits = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        hits += [(i, label) for i in range(len(own)) if own[i:i + len(parts)] == parts]
    starts = [h[0] for h in hits]
    return len(own), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({h[1] for h in hits}))


def labels(spark, text):
    return licenses.summarize(licenses.scan(documents(spark, [text]))).first()


def test_base_equals_plain_scan(spark):
    texts = [*ODD, "MIT License", "mit-license, Apache\nLicense; CC BY cc by", "submit license", "apache licenses", "cc by cc by-sa 4.0", "GNU General Public License " * 40, " ".join(words(400, 1)) + " MIT License", "Émit license mit licenseé"]
    docs = documents(spark, texts + [(None, "mit license")]).withColumn("labels", F.lit("mine")).withColumn("n_words", F.lit(1))
    rows = licenses.summarize(licenses.scan(docs)).select("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    key = lambda x: repr(x)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted((base(t) for t in [*texts, "mit license"]), key=key)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize(("text", "expected"), [
    ("released under the Apache License, Version 2.0", "apache,apache-2.0"),
    ("GNU Lesser General Public License version 2.1 or later", "lgpl-2.1-or-later"),
    ("GNU General Public License v3 only", "gpl,gpl-3-only"),
    ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0"),
    ("CC BY-NC-ND 3.0", "cc-by,cc-by-nc-nd-3.0"),
    ("the 3-clause BSD license", "bsd-3-clause"),
    ("in the public domain of ideas", "public-domain"),
    ("a driving licence", ""),
])
def test_longest_signature_wins(spark, text, expected):
    assert labels(spark, text)["labels"] == expected


MIT = """Copyright (c) 2020 The Holders

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""


@pytest.mark.parametrize(("text", "expected"), [
    (MIT, "mit"),
    (MIT.partition("including")[0].partition("\n\n")[2], "mit"),
    (BSD, "bsd"),
    ("Copyright 2001 " + " ".join(words(60, 2)) + "\n" + BSD, "bsd"),
    (BSD.partition(" provided")[0], "bsd"),
    ("Copyright 2004 A. Holder\n" + ISC, "isc"),
    (ISC.replace("and/or", "and"), "isc"),
])
def test_standard_notices_without_a_title(spark, text, expected):
    assert labels(spark, text)["labels"] == expected


def test_higher_priority_survives_inside_a_longer_match(spark):
    rules = [licenses.Rule("license", "some long license text", "outer", 10), licenses.Rule("license", "long license", "inner", 20), licenses.Rule("license", "license", "small", 10)]
    found = licenses.scan(documents(spark, ["Some long LICENSE text"]), rules).first()["detections"]
    assert sorted((d["label"], d["first"], d["last"]) for d in found) == [("inner", 1, 2), ("outer", 0, 3)]


def samples(parsed):
    """A few strings that match a parsed pattern: every branch, optional parts left out and taken."""
    found = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "IN":
            parts = ["x" if str(value[0][0]) == "NEGATE" else chr(value[0][1])]
        elif name == "NOT_LITERAL":
            parts = ["x"]
        elif name == "SUBPATTERN":
            parts = samples(value[3])
        elif name == "BRANCH":
            parts = [p for branch in value[1] for p in samples(branch)]
        else:
            parts = [("" if not value[0] else p) * 1 for p in samples(value[2])] + samples(value[2])
        found = [f + p for f in found for p in parts][:400]
    return found


def test_every_match_has_its_keyword_and_a_gate():
    """The prefilters may drop nothing that a rule would match."""
    rules = licenses.build_rules()
    assert len(rules) > 200
    for rule in rules:
        for text in samples(re._parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern, text), (rule, text)
            assert rule.keyword in f" {text} " and any(g in f" {text} " for g in licenses.GATES), (rule, text)


def test_plan_is_native_and_table_may_be_empty(spark):
    scanned = licenses.summarize(licenses.scan(documents(spark, [])))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert scanned.count() == 0
