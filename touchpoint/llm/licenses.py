"""License scans with ordered signature rules, in built-in expressions only.

A text is normalised to its words (A-Z lower-cased; letters, digits and everything outside ASCII), one space
between them. The rules are regular expressions over whole words, each with a keyword that every match
contains, a label and a priority:

1. **Gate.** A text that has none of the few gate words cannot match and is done after the word count.
2. **Keyword prefilter.** Of the keywords, those that the text contains decide which rules run at all.
3. **Detections.** Matches are marked in the text and read off as word positions, in one pass per matching rule.
4. **Suppression.** A detection inside another one is dropped if the outer one has the same or a higher priority;
   of equal intervals the higher priority stays, then the earlier rule. Base phrases are reported in any case.

Everything happens inside the row: no shuffle, no Python, and a text is read whole, whatever its length.

Null and empty texts have no words, no labels and a score of 0. Repeated rows give repeated results; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
START, END = "\u0001", "\u0002"

#: Phrases and labels of the base scan. Fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int


#: Words of which every match of every rule contains one.
GATES = ["licen", "gpl", "cc by", "cc0", "creative commons", "public domain", "copyright", "permission is hereby granted", "permission to use copy modify", "redistribution and use"]

_LICENSE = "licen[cs]es?"
_PUBLISHED = "(?: as published by the free software foundation)?"
_ANY_VERSION = "(?:v(?:er(?:sion)?)? )?"

#: Families whose members differ by version: label, keyword, spelled-out name, short name, versions.
VERSIONED = [
    ("gpl", "gnu", f"gnu general public {_LICENSE}{_PUBLISHED}", None, ("1", "2", "3")),
    ("gpl", "gpl", None, "(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "gnu", f"gnu (?:lesser|library) general public {_LICENSE}{_PUBLISHED}", None, ("2", "2.1", "3")),
    ("lgpl", "lgpl", None, "(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "affero", f"(?:gnu )?affero general public {_LICENSE}{_PUBLISHED}", None, ("1", "3")),
    ("agpl", "agpl", None, "(?:gnu )?agpl", ("1.0", "3.0")),
    ("gfdl", "free documentation", f"gnu free documentation {_LICENSE}", None, ("1.1", "1.2", "1.3")),
    ("apache", "apache", f"apache (?:software )?{_LICENSE}", None, ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla", f"mozilla public {_LICENSE}", None, ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", f"eclipse public {_LICENSE}", None, ("1.0", "2.0")),
    ("eupl", "european union", f"european union public {_LICENSE}", None, ("1.0", "1.1", "1.2")),
    ("cddl", "common development", f"common development and distribution {_LICENSE}", None, ("1.0", "1.1")),
    ("osl", "open software", f"open software {_LICENSE}", None, ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free", f"academic free {_LICENSE}", None, ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("artistic", "artistic", f"artistic {_LICENSE}", None, ("1.0", "2.0")),
    ("lppl", "latex project", f"latex project public {_LICENSE}", None, ("1.0", "1.1", "1.2", "1.3")),
    ("ofl", "open font", f"(?:sil )?open font {_LICENSE}", None, ("1.0", "1.1")),
    ("ecl", "educational community", f"educational community {_LICENSE}", None, ("1.0", "2.0")),
    ("zpl", "zope", f"zope public {_LICENSE}", None, ("1.1", "2.0", "2.1")),
    ("php", "php", f"php {_LICENSE}", None, ("3.0", "3.01")),
    ("psf", "python", f"python (?:software foundation )?{_LICENSE}", None, ("2", "2.0")),
    ("bsl", "boost", f"boost software {_LICENSE}", None, ("1.0",)),
    ("cpl", "common public", f"common public {_LICENSE}", None, ("1.0",)),
    ("ipl", "ibm public", f"ibm public {_LICENSE}", None, ("1.0",)),
    ("apsl", "apple public", f"apple public source {_LICENSE}", None, ("1.0", "1.1", "1.2", "2.0")),
    ("odbl", "open database", f"open (?:data commons open )?database {_LICENSE}", None, ("1.0",)),
    ("cecill", "cecill", f"cecill (?:free software )?{_LICENSE}", None, ("1.0", "1.1", "2.0", "2.1")),
    ("bsl-business", "business source", f"business source {_LICENSE}", None, ("1.0", "1.1")),
    ("elastic", "elastic", f"elastic {_LICENSE}", None, ("2.0",)),
    ("sspl", "server side", f"server side public {_LICENSE}", None, ("1",)),
]

#: Creative Commons terms: label, spelled-out terms, short terms; and the versions.
CC_TERMS = [
    ("by", "attribution", "by"),
    ("by-sa", "attribution share ?alike", "by sa"),
    ("by-nc", "attribution non ?commercial", "by nc"),
    ("by-nd", "attribution no ?deriv(?:ative)?s", "by nd"),
    ("by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s", "by nc nd"),
]
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: Single signatures, from the specific to the general.
SINGLE = [
    Rule("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 60),
    Rule("mit", f"(?:released|licensed|distributed|available|provided) (?:under|with) (?:the )?(?:terms of the )?mit(?: x11)? {_LICENSE}", "mit", 50),
    Rule("mit", f"mit x11 {_LICENSE}", "x11", 40),
    Rule("mit", f"mit no attribution {_LICENSE}|mit {_LICENSE} no attribution", "mit-0", 45),
    Rule("mit", f"mit {_LICENSE}", "mit", 30),
    Rule("expat", f"expat {_LICENSE}", "mit", 30),
    Rule("bsd", f"(?:zero|0) clause bsd {_LICENSE}|bsd (?:zero|0) clause {_LICENSE}", "0bsd", 40),
    Rule("bsd", f"(?:two|2) clause bsd {_LICENSE}|bsd (?:two|2) clause {_LICENSE}|simplified bsd {_LICENSE}|freebsd {_LICENSE}", "bsd-2-clause", 40),
    Rule("bsd", f"(?:three|3) clause bsd {_LICENSE}|bsd (?:three|3) clause {_LICENSE}|(?:new|modified|revised) bsd {_LICENSE}", "bsd-3-clause", 40),
    Rule("bsd", f"(?:four|4) clause bsd {_LICENSE}|bsd (?:four|4) clause {_LICENSE}|(?:old|original) bsd {_LICENSE}", "bsd-4-clause", 40),
    Rule("bsd", f"bsd(?: style)? {_LICENSE}", "bsd", 30),
    Rule("redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", "bsd", 60),
    Rule("isc", f"isc {_LICENSE}", "isc", 30),
    Rule("permission to use copy modify", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "isc", 60),
    Rule("zlib", f"zlib(?: libpng)? {_LICENSE}", "zlib", 30),
    Rule("libpng", f"libpng {_LICENSE}", "libpng", 30),
    Rule("openssl", f"openssl {_LICENSE}", "openssl", 30),
    Rule("curl", f"curl {_LICENSE}", "curl", 30),
    Rule("ruby", f"ruby {_LICENSE}", "ruby", 30),
    Rule("perl", f"(?:same terms as perl|perl (?:5 )?{_LICENSE})(?: [^ ]+){{0,6}}? {_LICENSE}|perl {_LICENSE}", "perl", 30),
    Rule("vim", f"vim {_LICENSE}", "vim", 30),
    Rule("wtfpl", f"wtfpl {_LICENSE}", "wtfpl", 30),
    Rule("do what", f"do what the [^ ]+ you want to public {_LICENSE}", "wtfpl", 30),
    Rule("unlicense", "(?:the )?unlicense", "unlicense", 30),
    Rule("public domain", "(?:released|dedicated|placed|donated) (?:in|into|to) the public domain", "public-domain", 40),
    Rule("public domain", "public domain(?: dedication)?", "public-domain", 20),
    Rule("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0-1.0", 40),
    Rule("cc zero", f"cc zero {_LICENSE}", "cc0-1.0", 40),
    Rule("creative commons zero", "creative commons zero(?: 1 0)?(?: universal)?", "cc0-1.0", 45),
    Rule("creative commons", f"creative commons(?: {_LICENSE})?", "creative-commons", 10),
    Rule("gnu", f"gnu general public {_LICENSE}", "gpl", 30),
    Rule("gnu", f"gnu (?:lesser|library) general public {_LICENSE}", "lgpl", 30),
    Rule("affero", f"(?:gnu )?affero general public {_LICENSE}", "agpl", 30),
    Rule("apache", f"apache (?:software )?{_LICENSE}", "apache", 30),
    Rule("mozilla", f"mozilla public {_LICENSE}", "mpl", 30),
    Rule("eclipse", f"eclipse public {_LICENSE}", "epl", 30),
    Rule("artistic", f"artistic {_LICENSE}", "artistic", 30),
    Rule("open font", f"(?:sil )?open font {_LICENSE}", "ofl", 30),
    Rule("free documentation", f"gnu free documentation {_LICENSE}", "gfdl", 30),
    Rule("proprietary", f"proprietary {_LICENSE}|proprietary and confidential(?: [^ ]+){{0,20}}? copyright", "proprietary", 20),
    Rule("commercial", f"commercial {_LICENSE}", "commercial", 20),
    Rule("all rights reserved", "copyright(?: [^ ]+){0,12}? all rights reserved", "all-rights-reserved", 20),
    Rule("royalty free", f"royalty free {_LICENSE}", "royalty-free", 20),
    Rule("end user", f"end user {_LICENSE} agreement", "eula", 20),
    Rule("dual", f"dual (?:{_LICENSE}|licensed)", "dual-license", 20),
]


def _version(text: str) -> str:
    """Words of a version; a trailing zero may be missing."""
    major, _, minor = text.partition(".")
    return major + (f" {minor}" if minor not in ("", "0") else "(?: 0)?")


def build_rules() -> list[Rule]:
    """All rules in order: versions with and without "or later" or "only", Creative Commons, single signatures."""
    rules = []
    endings = ((" or (?:any )?later(?: version)?| or at your option any later version", "-or-later", 8), (" only", "-only", 8), ("", "", 0))
    for (label, keyword, long, short, versions), (ending, suffix, more) in product(VERSIONED, endings):
        if suffix and label not in ("gpl", "lgpl", "agpl", "gfdl"):
            continue
        for version in versions:
            name = long if long else short
            between = f"(?: {_ANY_VERSION}| ?v)" if short else f"(?: {_ANY_VERSION}| v)"
            tail = f"(?:{ending})" if ending else ""
            rules.append(Rule(keyword, f"{name}{between}{_version(version)}{tail}", f"{label}-{version}{suffix}", 50 + more))
    for (label, long, short), version in product(CC_TERMS, CC_VERSIONS):
        rules.append(Rule("cc by", f"cc {short} {_version(version)}(?: international| unported)?", f"cc-{label}-{version}", 55 + 2 * label.count("-")))
        rules.append(Rule("creative commons", f"creative commons {long} {_ANY_VERSION}{_version(version)}(?: international| unported)?(?: {_LICENSE})?", f"cc-{label}-{version}", 55 + 2 * label.count("-")))
    for label, long, short in CC_TERMS:
        rules.append(Rule("cc by", f"cc {short}", f"cc-{label}", 35 + 2 * label.count("-")))
        rules.append(Rule("creative commons", f"creative commons {long}(?: {_LICENSE})?", f"cc-{label}", 35 + 2 * label.count("-")))
    return rules + SINGLE


def _whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def words_of(text: Column) -> Column:
    """The words of a text with one space between them, before and after."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, NO_WORD, " ")), F.lit(" "))


def _places(words: Column, pattern: Column) -> Column:
    """First and last word of every match."""
    marked = F.split(F.regexp_replace(words, pattern, F.lit(f"{START}$0{END}")), " ")
    numbered = F.transform(marked, lambda w, i: F.struct(w.alias("w"), (i - 1).cast("bigint").alias("i")))
    first = F.transform(F.filter(numbered, lambda x: F.startswith(x["w"], F.lit(START))), lambda x: x["i"])
    last = F.transform(F.filter(numbered, lambda x: F.endswith(x["w"], F.lit(END))), lambda x: x["i"])
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def _detections(words: Column, rules: Column) -> Column:
    """Every match of the rules that apply: first, last, priority, rule number, label."""
    hits = F.filter(rules, lambda r: F.rlike(words, r["pattern"]))
    return F.flatten(F.transform(hits, lambda r: F.transform(_places(words, r["pattern"]), lambda p: F.struct(
        p["first"].alias("first"), p["last"].alias("last"), r["priority"].alias("priority"), r["number"].alias("number"), r["label"].alias("label")
    ))))


def _kept(found: Column) -> Column:
    """Detections that no other one contains and outranks."""

    def beats(e: Column, d: Column) -> Column:
        longer = (e["last"] - e["first"]) > (d["last"] - d["first"])
        first = (e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & (longer | (e["number"] < d["number"])))
        return (e["first"] <= d["first"]) & (e["last"] >= d["last"]) & (e["priority"] >= d["priority"]) & first

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beats(e, d)))


def _active(words: Column, rules: list[tuple[int, Rule]]) -> Column:
    """The rules whose keyword the words contain; each keyword is looked for once."""
    by_keyword: dict[str, list[Column]] = {}
    for i, r in rules:
        rule = F.struct(F.lit(_whole_words(r.pattern)).alias("pattern"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(i).alias("number"))
        by_keyword.setdefault(r.keyword, []).append(rule)
    groups = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*own).alias("rules")) for k, own in sorted(by_keyword.items())])
    return F.flatten(F.transform(F.filter(groups, lambda g: F.contains(words, g["keyword"])), lambda g: g["rules"]))


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, base and detections (arrays of first, last, priority, number, label) of every row."""
    rules = build_rules() if rules is None else rules
    base = [(i, Rule(phrase, phrase, label, 0)) for i, (phrase, label) in enumerate(BASE.items())]
    df = docs.select("doc_id", words_of(F.col("text")).alias("_words"))
    words = F.col("_words")
    count = F.when(words == "  ", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) - 1)
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(words, F.lit(word))
    df = df.select("doc_id", count.cast("bigint").alias("n_words"), F.when(gate, words).alias("_words"))
    found, base_found = (F.when(words.isNotNull(), _detections(words, _active(words, r))) for r in (list(enumerate(rules)), base))
    df = df.select("doc_id", "n_words", base_found.alias("base"), found.alias("_found"))
    return df.select("doc_id", "n_words", "base", _kept(F.col("_found")).alias("detections"))


def summarize(found: DataFrame) -> DataFrame:
    """Digest of ``scan``: counts, first and last base word, labels, and the share of the words in detections."""

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.coalesce("base", F.array().cast("array<struct<first:bigint,last:bigint,priority:int,number:int,label:string>>"))
    kept = F.coalesce("detections", F.array().cast("array<struct<first:bigint,last:bigint,priority:int,number:int,label:string>>"))
    covered = F.aggregate(kept, F.lit(0).cast("bigint"), lambda n, d: n + d["last"] - d["first"] + 1)
    starts, base_labels, labels = F.transform(base, lambda d: d["first"]), F.transform(base, lambda d: d["label"]), F.transform(kept, lambda d: d["label"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(F.concat(base_labels, labels)).alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), covered / F.col("n_words"))).otherwise(0.0).alias("score"), F.size(kept).cast("bigint").alias("n_detections"),
    )
