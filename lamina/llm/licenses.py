"""License scan by ordered signature rules.

A text becomes its words: lower case, runs of letters, digits and characters
beyond ASCII. A rule is a pattern over these words with a label, a priority
and keywords, one of which every match holds. Only rules with a keyword in the
text are tried. Of overlapping detections, one that lies within
another of higher priority, or within a longer or earlier one of its own, goes.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lamina.llm import frames

# Phrases whose places are always reported, with their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Licenses as "label: the words of its name; versions". A space
# in the name stands between words; a version is written with its dots.
NAMES = r"""
apache: apache( software)?; 1.0 1.1 2.0
gpl: (gnu )?(general public|gpl); 1.0 2.0 3.0 2 3
lgpl: (gnu )?(lesser general public|library general public|lgpl); 2.0 2.1 3.0 3
agpl: (gnu )?(affero general public|agpl); 1.0 3.0 3
gfdl: (gnu )?(free documentation|gfdl|fdl); 1.1 1.2 1.3
mpl: (mozilla public|mpl); 1.0 1.1 2.0
epl: (eclipse public|epl); 1.0 2.0
eupl: (european union public|eupl); 1.0 1.1 1.2
cddl: (common development and distribution|cddl); 1.0 1.1
cpl: common public; 1.0
osl: (open software|osl); 1.0 2.0 2.1 3.0
afl: (academic free|afl); 1.1 1.2 2.0 2.1 3.0
artistic: (perl )?artistic; 1.0 2.0
cc-by: (creative commons attribution|cc by); 1.0 2.0 2.5 3.0 4.0
cc-by-sa: (creative commons attribution share ?alike|cc by sa); 1.0 2.0 2.5 3.0 4.0
cc-by-nd: (creative commons attribution no ?deriv(s|atives)|cc by nd); 1.0 2.0 2.5 3.0 4.0
cc-by-nc: (creative commons attribution non ?commercial|cc by nc); 1.0 2.0 2.5 3.0 4.0
cc-by-nc-sa: (creative commons attribution non ?commercial share ?alike|cc by nc sa); 1.0 2.0 2.5 3.0 4.0
cc-by-nc-nd: (creative commons attribution non ?commercial no ?deriv(s|atives)|cc by nc nd); 1.0 2.0 2.5 3.0 4.0
cc0: (cc0|cc zero|creative commons zero); 1.0
odbl: (open database|odbl); 1.0
odc-by: open data commons attribution; 1.0
pddl: (public domain dedication and|pddl); 1.0
ofl: (sil open font|ofl); 1.0 1.1
bsl: (boost software|bsl); 1.0
ms-pl: (microsoft public|ms pl);
ms-rl: (microsoft reciprocal|ms rl);
bsd-2: (bsd 2 clause|2 clause bsd|simplified bsd|freebsd);
bsd-3: (bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd);
bsd-4: (bsd 4 clause|4 clause bsd|original bsd);
bsd-0: (0bsd|zero clause bsd);
bsd: bsd( style)?;
mit: (mit|expat)( x11)?;
mit-0: (mit 0|mit no attribution);
isc: isc;
zlib: zlib( libpng)?;
libpng: libpng; 2
unlicense: unlicense;
wtfpl: (wtfpl|do what the fuck you want to public); 2
python: (python software foundation|psf); 2
php: php; 3.0 3.01
ruby: ruby;
postgresql: postgresql;
openssl: openssl;
ncsa: (university of illinois ncsa open source|ncsa);
w3c: w3c( software)?;
unicode: unicode( dfs)?;
vim: vim;
beerware: (beer ware|beerware);
zpl: (zope public|zpl); 1.1 2.0 2.1
qpl: (q public|qpl); 1.0
ipl: (ibm public|ipl); 1.0
spl: (sun public|spl); 1.0
npl: (netscape public|npl); 1.0 1.1
apsl: (apple public source|apsl); 1.0 1.1 1.2 2.0
ecl: (educational community|ecl); 1.0 2.0
cecill: (cecill|ce cill); 1.0 1.1 2.0 2.1
lppl: (latex project public|lppl); 1.0 1.1 1.2 1.3c
upl: (universal permissive|upl); 1.0
sspl: (server side public|sspl); 1.0
busl: (business source|busl); 1.1
elastic: elastic; 1.0 2.0
polyform: polyform (noncommercial|small business|strict|shield|perimeter); 1.0.0
mulan: (mulan permissive software|mulan psl); 1.0 2.0
openrail: (bigscience )?(open rail|openrail)( m)?; 1.0
llama: llama (2|3|3 1|3 2)( community)?;
"""

# Sentences of licenses and notices as "label, priority: words".
NOTICES = r"""
apache, 95: you may not use this file except in compliance with the license
apache, 90: distributed on an as is basis without warranties or conditions of any kind
gpl, 90: this program is free software you can redistribute it and or modify
gpl, 85: under the terms of the gnu general public license
lgpl, 95: under the terms of the gnu (lesser|library) general public license
agpl, 95: under the terms of the gnu affero general public license
mit, 95: permission is hereby granted free of charge to any person obtaining a copy
mit, 85: the above copyright notice and this permission notice shall be included
isc, 95: permission to use copy modify and (or )?distribute this software for any purpose
bsd, 95: redistribution and use in source and binary forms with or without modification
bsd, 85: neither the name of .{1,80}? nor the names of its contributors
bsd-4, 95: all advertising materials mentioning features or use of this software
mpl, 95: this source code form is subject to the terms of the mozilla public license
epl, 90: made available under the terms of the eclipse public license
zlib, 95: provided as is without any express or implied warranty in no event will the authors
unlicense, 95: this is free and unencumbered software released into the public domain
public-domain, 70: (released into|in|placed in|dedicated to) the public domain
public-domain, 60: public domain (work|dedication|mark)
wtfpl, 95: do what the fuck you want to
reserved, 60: all rights (are )?(strictly )?reserved
reserved, 55: (alle rechte vorbehalten|tous droits r[^ ]+serv[^ ]+s|todos los derechos reservados)
proprietary, 70: (proprietary and confidential|confidential and proprietary)
proprietary, 70: unauthorized (copying|reproduction|distribution|use) .{0,40}?(is )?(strictly )?prohibited
proprietary, 60: (may|must|shall) not be (copied|reproduced|redistributed|distributed|republished)
proprietary, 60: no part of this (publication|book|work|document) may be reproduced
proprietary, 60: trade secrets? of
copyright, 40: copyright (c )?(by )?(19|20)[0-9]{2}
copyright, 40: (c|©) (19|20)[0-9]{2}
non-commercial, 50: (for )?non ?commercial (use|purposes) only
personal-use, 50: (for )?personal use only
educational-use, 50: (for )?(educational|research|academic) (use|purposes) only
free-use, 40: free (to|for) (use|commercial use|any use)
warranty, 30: without (any )?warrant(y|ies)
terms, 30: (subject to|governed by) (the |our )?terms (of (use|service)|and conditions)
permission, 40: (reprinted|reproduced|used) (with|by) permission
attribution, 40: attribution (is )?required
gpl, 60: (free software|copyleft) license
cc, 60: creative commons( license)?
cc0, 80: to the extent possible under law .{0,80}? waived all copyright
cc, 75: creativecommons org (licenses|publicdomain) [a-z0-9 ]{1,20}
gpl, 80: gnu org licenses (old licenses )?gpl
lgpl, 80: gnu org licenses (old licenses )?lgpl
apache, 80: apache org licenses license 2 0
mit, 80: opensource org licenses mit
bsd, 80: opensource org licenses bsd
dual, 50: (dual|multi|double) licensed
license, 20: licen[cs]ed under
license, 20: see (the )?licen[cs]e( file)? for (more )?(details|information)
"""

_SPACES = bytes(
    b if chr(b).isalnum() and b < 0x80 or b >= 0x80 else 0x20 for b in range(256)
)  # letters are lower-cased before


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: re.Pattern
    words: frozenset[str]  # every match holds one of them; none: nothing to ask for


def _spellings(pattern: str) -> set[str]:
    """The pattern with each of its groups replaced by each alternative, or by none if optional."""
    group = re.search(r"\(([^()]*)\)(\?|\{[^}]*\})?", pattern)
    if not group:
        return {pattern}
    choices = group[1].split("|") + [""] * (group[2] == "?")
    return {s for c in choices for s in _spellings(pattern[: group.start()] + c + pattern[group.end() :])}


def _words_of_every_match(pattern: str) -> frozenset[str]:
    """The longest plain word of each spelling; empty if some spelling has none."""
    flat = re.sub(r"\[[^\[\]]*\]", "~", pattern)
    found = set()
    for spelling in _spellings(flat):
        plain = [w for w in spelling.split(" ") if re.fullmatch("[0-9a-z]+", w)]
        if not plain:
            return frozenset()
        found.add(max(plain, key=len))
    return frozenset(found)


def _rule(label: str, priority: int, pattern: str) -> Rule:
    return Rule(label, priority, re.compile(f"(?<= ){pattern}(?= )"), _words_of_every_match(pattern))


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, those of higher priority first."""
    made = []
    for line in NOTICES.strip().splitlines():
        head, pattern = line.split(": ", 1)
        label, priority = head.split(", ")
        made.append(_rule(label, int(priority), pattern))
    for line in NAMES.strip().splitlines():
        label, rest = line.split(": ", 1)
        name, versions = rest.split(";")
        plain = label.replace("-", " ")
        made.append(_rule(label, 45, f"{name} licen[cs]e"))
        made.append(_rule(label, 65, f"licen[cs]ed under (an? |the |terms of the )?{name}( licen[cs]e)?"))
        made.append(_rule(label, 99, f"spdx license identifier {plain}"))
        for version in versions.split():
            spoken = version.replace(".", " ")
            made.append(_rule(f"{label}-{version}", 75, f"{name}( licen[cs]e)?( version)? v?{spoken}"))
            made.append(_rule(f"{label}-{version}", 99, f"spdx license identifier {plain} {spoken}( only| or later)?"))
    for phrase, label in BASE.items():
        made.append(_rule(label, 50, phrase))
    return tuple(sorted(made, key=lambda r: -r.priority))


@cache
def _keywords() -> frozenset[str]:
    return frozenset().union(*(r.words for r in rules()))


def normal(text: str) -> tuple[list[str], str]:
    """The words of a text, and the text that they make, with a space at either end."""
    kept = text.encode("utf-8", "surrogatepass").lower().translate(_SPACES).split()
    plain = b" ".join(kept).decode("utf-8", "surrogatepass")
    return plain.split(" ") if kept else [], f" {plain} "


def detections(words: list[str], plain: str) -> list[tuple[int, int, int, str]]:
    """``(first word, stop, priority, label)`` of every detection that stands, in order."""
    present = _keywords().intersection(words)
    found = []
    for rule in rules():
        if not rule.words or not present.isdisjoint(rule.words):
            found += [(m.start(), m.end(), rule.priority, rule.label) for m in rule.pattern.finditer(plain)]
    # Higher priority, then longer, then earlier ones suppress what lies within them.
    found.sort(key=lambda d: (-d[2], d[0] - d[1], d[0], d[3]))
    kept = sorted(_standing(found))
    at = _words_before(plain, [d[0] for d in kept])
    return [
        (first, first + plain.count(" ", start, stop) + 1, priority, label)
        for first, (start, stop, priority, label) in zip(at, kept)
    ]


def _standing(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Detections that lie within no earlier one of the list.

    Lying within is transitive, so suppressed ones need not be told from others.
    A tree over the starts holds the largest stop so far of every prefix, which
    makes the cost of one detection the logarithm of their number.
    """
    starts = sorted({d[0] for d in found})
    reach = [0] * (len(starts) + 1)
    kept = []
    for d in found:
        place = at = bisect.bisect_left(starts, d[0]) + 1
        furthest = 0
        while at > 0:
            furthest = max(furthest, reach[at])
            at &= at - 1
        if furthest >= d[1]:
            continue
        kept.append(d)
        while place < len(reach):
            reach[place] = max(reach[place], d[1])
            place += place & -place
    return kept


def _words_before(plain: str, places: list[int]) -> list[int]:
    """Numbers of the words that start behind the spaces at ascending places."""
    numbers, words, last = [], -1, 0
    for place in places:
        words += plain.count(" ", last, place)
        last = place
        numbers.append(words)
    return numbers


SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, detections array<struct<first: long, stop: long, priority: int, label: string>>"
)


def scan_text(text: str) -> tuple:
    """What :func:`scan` gives of one text, without its id."""
    words, plain = normal(text)
    places, base = [], set()
    for phrase, label in BASE.items():
        at, starts = plain.find(f" {phrase} "), []
        while at >= 0:
            starts.append(at + 1)
            at = plain.find(f" {phrase} ", at + 1)
        places += _words_before(plain, starts)
        if starts:
            base.add(label)
    found = detections(words, plain) if words else []
    every = base | {d[3] for d in found}
    doubt = 1.0
    for priority in {d[3]: d[2] for d in sorted(found, key=lambda d: d[2])}.values():
        doubt *= 1 - priority / 100
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(every)),
        1 - doubt,
        [dict(zip(("first", "stop", "priority", "label"), d)) for d in found],
    )


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [f.split()[0] for f in SCAN.split(", ")[:8]] + ["detections"]
    for pdf in batches:
        rows = [(i, *scan_text(t)) for i, t in zip(pdf["doc_id"], pdf["text"])]
        made = pd.DataFrame(rows, columns=columns)
        yield made.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base places, labels, a score and every standing detection of each whole text.

    The score is the chance that one of the labels holds, each at the priority
    (in percent) of its best detection. A null or empty text has no words and
    score 0; repeated rows give repeated results.
    """
    frames.small_batches(docs.sparkSession)
    return frames.whole_text(docs, id_col, text_col).mapInPandas(_scan, SCAN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents."""
    return scan(frames.documents(spark, sf_dir)).drop("detections")
