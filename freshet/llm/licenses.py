"""License scans by ordered signature rules.

A text becomes its words, joined by single blanks: runs of digits, a-z and
characters beyond ASCII, A-Z lowered. Rules are regular expressions over that.
The name of each license is written by hand; each form in which a name occurs
(tag, grant, address, title with version, bare title) makes it a rule, some
hundreds in all, and sentences of license texts are rules of their own.

One Aho-Corasick pass over the words finds keywords, and a rule is tried only
where its keyword occurs. What rules find is ranked by priority, then length,
then place, then the order of rules; a find that lies within one of higher rank
is dropped. As lying within carries over, it need not be asked whether that
one was dropped itself, so one sweep with running maxima decides.

Base phrases are sought by themselves and never dropped.

Defined results: a null or empty text has no words and no label, and score 0;
repeated rows are scanned alike; very long texts are scanned whole, in time
that grows with them times the logarithm of their finds; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CAPITALS = {c: c + 32 for c in range(65, 91)}

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Names of licenses as they are written, over words; "~" is "licence" or "license".
# Label: name, keyword that every such name holds, versions.
FAMILIES: dict[str, tuple[str, str, str]] = {
    "apache": (r"apache (?:software |public )?~|apache license", "apache", "1.0 1.1 2.0"),
    "gpl": (r"(?:gnu )?general public ~|gnu gpl", "gnu|general public", "1.0 2.0 3.0"),
    "gpl-short": (r"gpl", "gpl", "1.0 2.0 3.0"),
    "lgpl": (r"(?:gnu )?(?:lesser|library) general public ~|(?:gnu )?lgpl", "lgpl|general public", "2.0 2.1 3.0"),
    "agpl": (r"(?:gnu )?affero general public ~|(?:gnu )?agpl", "agpl|affero", "1.0 3.0"),
    "gfdl": (r"(?:gnu )?free documentation ~|gfdl", "gfdl|free documentation", "1.1 1.2 1.3"),
    "mpl": (r"mozilla public ~|mpl", "mozilla|mpl", "1.0 1.1 2.0"),
    "npl": (r"netscape public ~", "netscape", "1.0 1.1"),
    "epl": (r"eclipse public ~|epl", "eclipse|epl", "1.0 2.0"),
    "edl": (r"eclipse distribution ~", "eclipse", "1.0"),
    "cpl": (r"common public ~", "common public", "1.0"),
    "ipl": (r"ibm public ~", "ibm public", "1.0"),
    "cddl": (r"common development and distribution ~|cddl", "common development|cddl", "1.0 1.1"),
    "cpal": (r"common public attribution ~", "common public", "1.0"),
    "eupl": (r"european union public ~|eupl", "european union|eupl", "1.0 1.1 1.2"),
    "osl": (r"open software ~", "open software", "1.0 1.1 2.0 2.1 3.0"),
    "afl": (r"academic free ~", "academic free", "1.1 1.2 2.0 2.1 3.0"),
    "artistic": (r"artistic ~", "artistic", "1.0 2.0"),
    "cecill-b": (r"cecill b", "cecill", "1.0"),
    "cecill-c": (r"cecill c", "cecill", "1.0"),
    "cecill": (r"cecill", "cecill", "1.0 1.1 2.0 2.1"),
    "bsl": (r"boost software ~", "boost", "1.0"),
    "busl": (r"business source ~", "business source", "1.1"),
    "sspl": (r"server side public ~|sspl", "server side|sspl", "1.0"),
    "psf": (r"(?:python software foundation|psf) ~", "python|psf", "2.0"),
    "php": (r"php ~", "php", "3.0 3.01"),
    "zpl": (r"zope public ~", "zope", "1.1 2.0 2.1"),
    "ofl": (r"(?:sil )?open font ~", "open font", "1.0 1.1"),
    "lppl": (r"latex project public ~|lppl", "latex|lppl", "1.0 1.1 1.2 1.3"),
    "qpl": (r"q public ~", "q public", "1.0"),
    "rpl": (r"reciprocal public ~", "reciprocal", "1.1 1.5"),
    "ms-pl": (r"microsoft public ~|ms pl", "microsoft|ms pl", ""),
    "ms-rl": (r"microsoft reciprocal ~|ms rl", "microsoft|ms rl", ""),
    "upl": (r"universal permissive ~", "universal permissive", "1.0"),
    "odbl": (r"open database ~|odbl", "open database|odbl", "1.0"),
    "odc-by": (r"open data commons attribution ~", "open data", "1.0"),
    "pddl": (r"(?:open data commons )?public domain dedication and ~", "public domain", "1.0"),
    "mulan": (r"mulan (?:psl|permissive software ~)", "mulan", "1.0 2.0"),
    "sleepycat": (r"sleepycat ~", "sleepycat", ""),
    "watcom": (r"sybase open watcom public ~", "watcom", "1.0"),
    "apsl": (r"apple public source ~", "apple", "1.0 1.1 1.2 2.0"),
    "w3c": (r"w3c software (?:notice and )?~", "w3c", ""),
    "ecl": (r"educational community ~", "educational community", "1.0 2.0"),
    "efl": (r"eiffel forum ~", "eiffel", "1.0 2.0"),
    "vsl": (r"vovida software ~", "vovida", "1.0"),
    "unicode": (r"unicode (?:dfs |data files and software )?~", "unicode", "2015 2016"),
    "mit": (r"mit(?: x11)? ~|expat ~", "mit|expat", ""),
    "mit-0": (r"mit no attribution(?: ~)?", "mit no", ""),
    "x11": (r"x11 ~", "x11", ""),
    "isc": (r"isc ~", "isc", ""),
    "zlib": (r"zlib(?: libpng)? ~", "zlib", ""),
    "bsd": (r"bsd(?: style)? ~|berkeley software distribution ~", "bsd|berkeley", ""),
    "bsd-0-clause": (r"(?:zero|0) clause bsd(?: ~)?|0bsd", "zero clause|0 clause|0bsd", ""),
    "bsd-2-clause": (r"(?:two|2) clause bsd(?: ~)?|bsd (?:two|2) clause(?: ~)?|simplified bsd ~|freebsd ~", "bsd|freebsd", ""),
    "bsd-3-clause": (r"(?:three|3) clause bsd(?: ~)?|bsd (?:three|3) clause(?: ~)?|(?:new|modified|revised) bsd ~", "bsd", ""),
    "bsd-4-clause": (r"(?:four|4) clause bsd(?: ~)?|bsd (?:four|4) clause(?: ~)?|original bsd ~", "bsd", ""),
    "unlicense": (r"(?:the )?unlicense", "unlicense", ""),
    "wtfpl": (r"wtfpl|do what the fuck you want to public ~", "wtfpl|do what", "2.0"),
    "ncsa": (r"(?:university of illinois )?ncsa(?: open source)? ~", "ncsa", ""),
    "postgresql": (r"postgresql ~", "postgresql", ""),
    "curl": (r"curl ~", "curl", ""),
    "openssl": (r"openssl ~", "openssl", ""),
    "ruby": (r"ruby ~", "ruby", ""),
    "vim": (r"vim ~", "vim", ""),
    "json": (r"json ~", "json", ""),
    "beerware": (r"beer ?ware(?: ~)?", "beer", "42"),
    "icu": (r"icu ~", "icu", ""),
    "ntp": (r"ntp ~", "ntp", ""),
    "hpnd": (r"historical permission notice and disclaimer", "historical permission", ""),
    "blueoak": (r"blue oak model ~", "blue oak", "1.0.0"),
    "elastic": (r"elastic ~", "elastic", "2.0"),
    "cc0": (r"cc0|(?:cc|creative commons) (?:zero|0)(?: ~)?", "cc0|cc zero|cc 0|creative commons", "1.0"),
    "cc-by": (r"cc by|creative commons attribution(?: ~)?", "cc by|creative commons", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-sa": (r"cc by sa|creative commons attribution share ?alike(?: ~)?", "cc by|creative commons", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nc": (r"cc by nc|creative commons attribution non ?commercial(?: ~)?", "cc by|creative commons", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nd": (r"cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: ~)?", "cc by|creative commons", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nc-sa": (
        r"cc by nc sa|creative commons attribution non ?commercial share ?alike(?: ~)?",
        "cc by|creative commons",
        "1.0 2.0 2.5 3.0 4.0",
    ),
    "cc-by-nc-nd": (
        r"cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: ~)?",
        "cc by|creative commons",
        "1.0 2.0 2.5 3.0 4.0",
    ),
}

# Sentences of licenses and notices. Label, priority, keyword, expression.
SENTENCES: list[tuple[str, int, str, str]] = [
    ("mit", 75, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 65, "above copyright notice and this permission", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("bsd", 70, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 75, "nor the name", r"nor the names? of its contributors may be used to endorse or promote products derived from this software"),
    ("isc", 75, "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", 75, "altered source versions", r"altered source versions must be plainly marked as such"),
    ("apache-2.0", 75, "unless required by applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", 60, "free software", r"(?:is|this program is) free software you can redistribute it and or modify it under the terms of"),
    ("or-later", 55, "any later version", r"(?:either version \d+(?: \d+)? of the license )?or at your option any later version"),
    ("unlicense", 75, "released into the public domain", r"(?:is )?free and unencumbered software released into the public domain"),
    ("public-domain", 45, "public domain", r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain"),
    ("boost", 70, "boost software", r"distributed under the boost software license"),
    ("no-warranty", 30, "without warranty", r"without warranty of any kind(?: express or implied)?"),
    ("as-is", 25, "provided as is", r"(?:this software )?is provided as is"),
    ("reserved", 35, "all rights reserved", r"all rights reserved"),
    ("reserved", 35, "rights reserved", r"(?:some|no) rights reserved"),
    ("copyright", 20, "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*"),
    ("proprietary", 40, "proprietary", r"proprietary and confidential|confidential and proprietary"),
    ("commercial", 40, "commercial", r"(?:under|with|requires?) (?:a |the )?commercial ~"),
    ("license-file", 15, "license", r"see (?:the )?(?:accompanying )?license(?: txt| md)?(?: file)?(?: for (?:more )?(?:details|information))?"),
]

# Forms of a name: priority, and the expression around the name and its version.
_GRANT = (
    r"(?:licen[cs]ed|re ?licensed|released|distributed|redistributed|published|provided|available|covered|shared|offered|used)"
    r"(?: \w+){0,2} under (?:an? |the )?(?:terms (?:and conditions )?of (?:an? |the )?)?"
)
_ADDRESS = r"(?:https? )?(?:www )?(?:opensource org licenses?|spdx org licenses|apache org licenses|gnu org licenses|creativecommons org licenses)"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    expression: re.Pattern


def _version(number: str) -> str:
    """A version as words: 2.0 is also written as 2."""
    major, *minor = number.split(".")
    rest = " ".join(minor)
    return f"{major}(?: {rest})?" if rest and not rest.strip("0 ") else f"{major} {rest}" if rest else major


def rules() -> list[Rule]:
    """All rules, in their order."""
    found: list[Rule] = []

    def add(label: str, priority: int, keywords: str, expression: str) -> None:
        whole = f"(?<= )(?:{expression.replace('~', 'licen[cs]e')})(?= )"
        found.append(Rule(label, priority, tuple(keywords.split("|")), re.compile(whole)))

    for family, (name, keywords, versions) in FAMILIES.items():
        label = family.removesuffix("-short")
        for number in versions.split():
            own, words = f"{label}-{number}", _version(number)
            dated = rf"(?:{name}) (?:~ )?(?:version |v |ver )?(?:v)?{words}(?: international| generic| unported)?"
            add(own, 95, "spdx", rf"spdx license identifier {label.replace('-', ' ')} {words}(?: only| or later)?")
            add(own, 85, keywords, rf"{_GRANT}(?:{dated})")
            add(own, 70, keywords, dated)
        add(label, 90, "spdx", rf"spdx license identifier {label.replace('-', ' ')}")
        add(label, 80, "org", rf"{_ADDRESS} {label.replace('-', ' ')}(?: \d+){{0,2}}")
        add(label, 60, keywords, rf"{_GRANT}(?:{name})")
        add(label, 40, keywords, rf"{name}")
    for label, priority, keywords, expression in SENTENCES:
        add(label, priority, keywords, expression)
    return found


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_CAPITALS)) if text else []


def suppressed(finds: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Finds (start, end, priority, rule) that lie in none of higher rank, in the order of rank.

    Running maxima of ends over starts, in a binary indexed tree: the furthest
    end among better finds that start no later tells whether one holds a find.
    """
    starts = {s: k + 1 for k, s in enumerate(sorted({f[0] for f in finds}))}
    furthest = [0] * (len(starts) + 1)
    out = []
    for find in sorted(finds, key=lambda f: (-f[2], f[0] - f[1], f[0], f[3])):
        start, end = find[:2]
        k, most = starts[start], 0
        while k:
            most = max(most, furthest[k])
            k &= k - 1
        if most < end:
            out.append(find)
            k = starts[start]
            while k < len(furthest):
                furthest[k] = max(furthest[k], end)
                k += k & -k
    return out


class Scanner:
    """Finds licenses in texts."""

    def __init__(self, listed: list[Rule] | None = None):
        self.rules = rules() if listed is None else listed
        gates: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for word in rule.keywords:
                gates.setdefault(word, []).append(k)
        self._keywords = ahocorasick.Automaton()
        for word, held in gates.items():
            # A keyword stands where a word begins.
            self._keywords.add_word(f" {word}", held)
        for phrase in BASE:
            if phrase not in gates:
                self._keywords.add_word(f" {phrase}", [])
        self._keywords.make_automaton()

    def finds(self, line: str) -> list[tuple[int, int, int, int]] | None:
        """(start, end, priority, rule) of what no better find holds, by character; None if no keyword occurs."""
        tried: set[int] = set()
        some = False
        for _, held in self._keywords.iter(line):
            some = True
            tried.update(held)
        if not some:
            return None
        found = [(m.start(), m.end(), self.rules[k].priority, k) for k in sorted(tried) for m in self.rules[k].expression.finditer(line)]
        return suppressed(found)

    def scan(self, text: str | None) -> dict:
        """What a text holds; places count words from 0."""
        known = words_of(text)
        out = {"n_words": len(known), "base": [], "finds": []}
        if not known:
            return out
        line = f" {' '.join(known)} "
        finds = self.finds(line)
        if finds is None:
            return out
        base = []
        for phrase, label in BASE.items():
            at = line.find(f" {phrase} ")
            while at >= 0:
                base.append((at + 1, label))
                at = line.find(f" {phrase} ", at + 1)
        # Word numbers of ascending places, each stretch counted once.
        number, at, word = {}, 0, -1
        for place in sorted({p for p, _ in base} | {f[0] for f in finds}):
            word += line.count(" ", at, place)
            number[place], at = word, place
        out["base"] = sorted((number[p], label) for p, label in base)
        out["finds"] = [
            {"label": self.rules[k].label, "first": number[a], "words": line.count(" ", a, b) + 1, "priority": p} for a, b, p, k in finds
        ]
        return out


_FIND = "struct<label:string,first:long,words:long,priority:int>"
SCHEMA = f"id long, n_words long, base array<struct<word:long,label:string>>, finds array<{_FIND}>"
_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("base", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
        ("finds", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("priority", pa.int32())]))),
    ]
)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``base`` (word, label) and ``finds`` (label, first word, words, priority) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            out = []
            for doc, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = scanner.scan(said)
                base = [{"word": w, "label": label} for w, label in found["base"]]
                out.append({"id": doc, "n_words": found["n_words"], "base": base, "finds": found["finds"]})
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)
