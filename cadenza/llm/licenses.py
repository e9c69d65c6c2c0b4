"""Licence scans: Aho-Corasick over the words of a text, and a parser for licence expressions.

One automaton finds the phrases of :data:`PHRASES`, the identifiers of
:data:`IDENTIFIERS` that have several words, and the words of :data:`TAGS`, at once,
in time linear in the text and its hits. Where a tag stands, however its words are
parted, and not within an expression that was read already, the rest of the line is read as a licence expression, which without a colon or
equals sign between must hold known identifiers only: a
shunting-yard parser orders ``and``, ``or``, ``with`` and parentheses (``with``
binds strongest, then ``and``), and the expression is evaluated to its labels
and to how strongly it binds: ``and`` the strongest, ``or`` the weakest side,
``with`` half of what the licence had. Identifiers of one word (mit, isc) are words
of other languages too, so they count behind tags only.

The score is the strongest binding found, 0 without any. Null counts as the
empty text: no words, no labels, score 0. Repeated rows are scanned one by one, an
empty table stays empty. Of hits that overlap all count, so there are no ties. A very long line
is read once, whatever tags and names it holds. A column named like the result is replaced.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from cadenza.llm.common import alnum_words, annotate

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices: words as the text has them, the label, and how strongly it binds.
PHRASES = {
    "apache license version 2 0": "apache-2.0", "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "creative commons attribution": "cc-by", "public domain": "public-domain", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
# Words that announce an expression, and identifiers of the public licence list.
TAGS = ("spdx license identifier", "spdx license expression", "license expression", "license identifier", "license id", "spdx id")
IDENTIFIERS = (
    "0BSD AAL AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware"
    " BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0"
    " CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0"
    " ECL-2.0 EFL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only"
    " GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IPL-1.0 ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only"
    " LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1"
    " OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).lower().split()
BINDING = {"reserved": 1.0, "agpl": 0.9, "cc-by-nc": 0.8, "cc-by-nd": 0.8, "gpl": 0.8, "lgpl": 0.6, "cc-by-sa": 0.6, "mpl": 0.5, "cc-by": 0.4, "apache": 0.3, "bsd": 0.2, "mit": 0.2, "isc": 0.2, "zlib": 0.2, "cc0": 0.1, "unlicense": 0.1, "0bsd": 0.1, "epl": 0.5, "cddl": 0.5, "eupl": 0.6, "osl": 0.8, "sspl": 0.9, "busl": 0.9, "public-domain": 0.1}
OTHER = 0.5
FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"

_ORDER = {"or": 1, "and": 2, "with": 3}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SIGN = re.compile(r"[ \t\"'`]*[:=]")
_TERM = re.compile(r"[\r\n()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")


def binding(label: str) -> float:
    """Of the longest known name that the label starts with."""
    known = [k for k in BINDING if label == k or label.startswith(k + "-")]
    return BINDING[max(known, key=len)] if known else OTHER


def read_expression(text: str, at: int = 0) -> tuple[list[str], int, int]:
    """Shunting-yard over what stands from ``at`` on: operands and lower-case operators in evaluation order, where it ends, and where its
    last operand starts that is no known identifier (``at``, if all are known).

    Reading stops at the end of the line, or at the first term that can't follow, so prose behind the expression is left out;
    missing or surplus parentheses are forgiven.
    """
    out: list[str] = []
    held: list[str] = []
    operand, strange = True, at  # one is due
    for m in _TERM.finditer(text, at):
        term = m[0]
        word = term.lower()
        if word in _ORDER and not operand:
            while held and held[-1] != "(" and _ORDER[held[-1]] >= _ORDER[word]:
                out.append(held.pop())
            held.append(word)
            operand = True
        elif term == "(" and operand:
            held.append(term)
        elif term == ")" and not operand:
            while held and held[-1] != "(":
                out.append(held.pop())
            if held:
                held.pop()
        elif word not in _ORDER and operand and term not in "()\r\n":
            out.append(word.rstrip(".-:"))
            operand = False
            if out[-1] not in _KNOWN:
                strange = m.start()
        else:
            break
        at = m.end()
    if operand and held and held[-1] in _ORDER:
        held.pop()  # an operator without a right side
    return out + [x for x in reversed(held) if x != "("], at, strange


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """The labels of an expression, exceptions left out, and how strongly it binds; in time linear in it."""
    stack: list[tuple[int, float]] = []  # the first operand of each side, and how strongly it binds
    operands: list[str] = []
    left_out: list[tuple[int, int]] = []  # operands behind a ``with``
    for term in postfix:
        if term not in _ORDER:
            stack.append((len(operands), binding(term)))
            operands.append(term)
            continue
        if len(stack) < 2:
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if term == "with":
            left_out.append((right, len(operands)))
        stack.append((left, a / 2 if term == "with" else max(a, b) if term == "and" else min(a, b)))
    labels, done = set(), 0
    for start, end in [*sorted(left_out), (len(operands), len(operands))]:
        labels.update(operands[done:start])
        done = max(done, end)
    return labels, max((b for _, b in stack), default=0.0)


def automaton() -> ahocorasick.Automaton:
    """Phrases between spaces, each with its number of words."""
    found = ahocorasick.Automaton()
    several = [" ".join(w.decode() for w in alnum_words(x.encode())) for x in IDENTIFIERS]
    for phrase in {*BASE, *PHRASES, *TAGS, *(x for x in several if " " in x)}:
        found.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    found.make_automaton()
    return found


_LABEL_OF = {" ".join(w.decode() for w in alnum_words(x.encode())): x for x in IDENTIFIERS}


_KNOWN = frozenset(IDENTIFIERS)


def scan(raw: bytes, phrases: ahocorasick.Automaton) -> dict:
    """The fields of FIELDS for one text."""
    words = alnum_words(raw)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")  # a character for each byte
    base, own, starts, tags, ids = [], set(), [], set(), []
    at = seen = 0  # seen: spaces up to there; hits come by their ends
    for end, (phrase, size) in phrases.iter(line):
        seen += line.count(" ", at, end)
        at = end
        if phrase in BASE:
            starts.append(seen - size)
            base.append(BASE[phrase])
        if phrase in PHRASES:
            own.add(PHRASES[phrase])
        if phrase in _LABEL_OF:
            ids.append((seen - size, _LABEL_OF[phrase]))
        if phrase in TAGS:
            tags.add(seen - 1)
    strength, inside, expressed = 0.0, set(), set()
    if tags:
        plain, until, strange = raw.lower().decode("latin-1"), 0, 0
        for k, m in enumerate(_WORD.finditer(plain)):
            if m.start() < until:  # within an expression that was read, so no tag
                inside.add(k)
                continue
            signed = k in tags and _SIGN.match(plain, m.end())
            if k in tags and (signed or m.end() >= strange):  # up to there an expression without a sign holds a name that isn't known
                postfix, end, last = read_expression(plain, m.end())
                labels, bound = evaluate(postfix)
                if signed or labels and labels <= _KNOWN:  # else it may be prose
                    until = end
                    expressed |= labels
                    strength = max(strength, bound)
                else:
                    strange = last
    own |= {label for at, label in ids if at not in inside}
    strength = max(strength, max(map(binding, own | {*base}), default=0.0))
    own |= expressed
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": sorted({*base}), "labels": sorted(own | {*base}), "score": strength,
    }


def license_scan(docs: DataFrame, text_col: str = "text", out: str = "licenses") -> DataFrame:
    """``docs`` with the struct ``out`` of FIELDS; one pass, no shuffle."""

    def start():
        phrases = automaton()

        def work(raws):
            rows = [scan(raw or b"", phrases) for raw in raws]
            return {k: [row[k] for row in rows] for k in rows[0]}

        return work

    return annotate(docs, text_col, FIELDS, start, out)
