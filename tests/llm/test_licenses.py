"""License scans against a naive scan of words and rules, and edges."""

import random
import re
import time

from freshet.llm import licenses
from freshet.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, base string, finds int"
SCANNER = licenses.Scanner()


def labels(text):
    return {f["label"] for f in SCANNER.scan(text)["finds"]}


def made(draw):
    """A text of pieces of names, notices and noise."""
    names = [re.sub(r"\(\?:|[()?|]", " ", n.replace("~", "license")) for n, _, _ in licenses.FAMILIES.values()]
    pieces = [*names, "version 2.0", "v3", "4.0", "Licensed under the", "terms of the", "SPDX-License-Identifier:", "GPL-3.0-only", "CC BY", "All rights reserved",
              "general public license", "redistribution and use in source and binary forms, with or without modification, are permitted", "any later version",
              "opensource.org/licenses/MIT", "é", "ÀÉ", "and", "the", "Copyright (c) 2001, 2002", "\n", "xx" * 4]
    return draw.choice([" ", ", ", "\n", "-"]).join(draw.choice(pieces) for _ in range(draw.randint(0, 25)))


def naive_words(text):
    out, now = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c.isascii() and not ("a" <= c <= "z" or "0" <= c <= "9"):
            out += [now] if now else []
            now = ""
        else:
            now += c
    return out


def naive_base(words):
    found = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    return sorted(found)


def naive_finds(words):
    """Every rule on every text, and each find against all others."""
    line = f" {' '.join(words)} "
    every = [(m.start(), m.end(), r.priority, k) for k, r in enumerate(SCANNER.rules) for m in r.expression.finditer(line)]
    ranked = sorted(every, key=lambda f: (-f[2], f[0] - f[1], f[0], f[3]))
    kept = []
    for f in ranked:
        if not any(a <= f[0] and f[1] <= b for a, b, *_ in kept):
            kept.append(f)
    return [(SCANNER.rules[k].label, line.count(" ", 0, a) - 1, line[a:b].count(" ") + 1) for a, b, _, k in kept]


def test_scan_matches_a_naive_one():
    draw, some = random.Random(5), 0
    for _ in range(250):
        text = made(draw)
        words, found = naive_words(text), SCANNER.scan(text)
        assert found["n_words"] == len(words)
        assert found["base"] == naive_base(words)
        got = [(f["label"], f["first"], f["words"]) for f in found["finds"]]
        assert got == naive_finds(words)
        some += len(got)
    assert some > 1000 and len(SCANNER.rules) > 300


def test_notices():
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert labels("GNU Lesser General Public License v2.1") == {"lgpl-2.1"}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0"}
    assert labels("Released under the MIT License.") == {"mit"}
    assert labels("// SPDX-License-Identifier: MPL-2.0") == {"mpl-2.0"}
    assert labels("see https://opensource.org/licenses/BSD-3-Clause") == {"bsd-3-clause"}
    assert labels("(c) all rights reserved") == {"reserved"}
    assert labels("He permits the general public to enter; the summit is cold.") == set()
    assert labels("a 0BSD or FreeBSD license") == {"bsd-0-clause", "bsd-2-clause"}


def test_priority_and_containment():
    finds = [(0, 10, 40, 1), (2, 5, 90, 2), (2, 5, 40, 3), (4, 12, 40, 4), (0, 12, 20, 5), (0, 10, 40, 6)]
    # The longer one of lower priority stays, what lies within a better one goes, mere overlap stays.
    assert licenses.suppressed(finds) == [(2, 5, 90, 2), (0, 10, 40, 1), (4, 12, 40, 4), (0, 12, 20, 5)]
    draw = random.Random(6)
    for _ in range(300):
        some = [(a := draw.randint(0, 9), a + draw.randint(1, 6), draw.choice([1, 2, 3]), k) for k in range(draw.randint(0, 14))]
        kept = []
        for f in sorted(some, key=lambda f: (-f[2], f[0] - f[1], f[0], f[3])):
            if not any(a <= f[0] and f[1] <= b for a, b, *_ in kept):
                kept.append(f)
        assert licenses.suppressed(some) == kept


def test_long_texts_are_scanned_whole_in_linear_time():
    for piece in ("license ", "general public ", "licensed under the ", "apache license ", "gpl ", "creative commons attribution ", "copyright c 2001 ", "cc by nc "):
        began = time.perf_counter()
        assert SCANNER.scan(piece * 100_000)["n_words"] == 100_000 * len(piece.split())
        assert time.perf_counter() - began < 20, piece
    found = SCANNER.scan("word " * 300_000 + "all rights reserved")
    assert found["base"] == [(300_000, "reserved")]


def test_query_and_edges(spark, tmp_path):
    rows = [(1, None, "x", 1), (2, "", None, None), (3, "CC BY and cc-by. GENERAL PUBLIC LICENSE", "y", 2), (3, "CC BY and cc-by. GENERAL PUBLIC LICENSE", "y", 2), (None, "plain words", "", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_licenses"](spark, str(tmp_path)).collect()), key=repr)
    told = (3, 8, 3, 0, 5, "cc-by,gpl", "cc-by,gpl", 0.4)
    assert got == sorted([(1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0), told, told, (None, 2, 0, None, None, "", "", 0.0)], key=repr)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op12_licenses"](spark, f"{tmp_path}/none").count() == 0
