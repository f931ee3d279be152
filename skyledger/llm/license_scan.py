"""Licence scan: notice phrases and identifier tags found by Aho-Corasick, expressions by shunting-yard.

Texts are lower-cased (A-Z), reduced to words between single spaces, and run through one automaton of
all phrases. Where the automaton meets the words of an identifier tag, the expressions after the tags of
that text are parsed with operator precedence (with, and, or) and evaluated: ``and`` asks for the
stricter side, ``or`` for the laxer one, ``with`` an exception makes strong copyleft weak.

Per-document work only: nothing is shuffled, and hot keys or repeated rows change nothing. A missing or
empty text gives zero words, empty labels and score 0. Malformed expressions give no labels and count as
``n_bad_tags``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.common import WORD_BYTES, column_of, ids_and_texts, texts_of

#: Phrases whose places are reported one by one.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases: label and how surely the phrase alone tells the licence.
NOTICE_PHRASES = {
    "mit license": ("mit", 0.9),
    "apache license": ("apache", 0.9),
    "general public license": ("gpl", 0.85),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.85),
    "isc license": ("isc", 0.85),
    "boost software license": ("bsl", 0.9),
    "cc by": ("cc-by", 0.7),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "creative commons": ("cc", 0.6),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "released into the public domain": ("public-domain", 0.8),
    "all rights reserved": ("reserved", 0.5),
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(rb"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.I)
TAG_WEIGHT = 0.95

#: How much a licence asks for: 0 permissive, 1 weak copyleft, 2 strong copyleft, 3 restricted.
STRICTNESS = (
    ("mit", 0), ("apache", 0), ("bsd", 0), ("isc", 0), ("bsl", 0), ("zlib", 0), ("unlicense", 0), ("cc0", 0),
    ("cc-by-nc", 3), ("cc-by-nd", 3), ("cc-by-sa", 2), ("cc-by", 0),
    ("lgpl", 1), ("mpl", 1), ("epl", 1), ("agpl", 2), ("gpl", 2),
)
GRADES = ("permissive", "weak copyleft", "strong copyleft", "restricted")

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:+-]*))")


class BadExpression(ValueError):
    pass


def to_postfix(text: str) -> list[str]:
    """Shunting-yard: operands and operators of a licence expression in postfix order."""
    out: list[str] = []
    held: list[str] = []
    position, want_operand = 0, True
    text = text.strip()
    while position < len(text):
        found = _TOKEN.match(text, position)
        if not found:
            raise BadExpression(text)
        position = found.end()
        mark, word = found.groups()
        if mark == "(":
            if not want_operand:
                raise BadExpression(text)
            held.append(mark)
        elif mark == ")":
            if want_operand:
                raise BadExpression(text)
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise BadExpression(text)
            held.pop()
        elif word.lower() in _PRECEDENCE:
            if want_operand:
                raise BadExpression(text)
            rank = _PRECEDENCE[word.lower()]
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= rank:
                out.append(held.pop())
            held.append(word.lower())
            want_operand = True
        else:
            if not want_operand:
                raise BadExpression(text)
            out.append(word)
            want_operand = False
    if want_operand or "(" in held:
        raise BadExpression(text)
    return out + held[::-1]


def strictness(licence: str) -> int:
    name = licence.lower()
    return next((grade for start, grade in STRICTNESS if name == start or name.startswith(f"{start}-")), 3)


def evaluate(postfix: list[str]) -> tuple[int, str, list[str]]:
    """Strictness, the expression written plainly, and its licences (exceptions are not licences)."""
    stack: list[tuple[int, str, list[str]]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append((strictness(token), token, [token.lower()]))
            continue
        (b, right, more), (a, left, names) = stack.pop(), stack.pop()
        if token == "with":
            if len(names) != 1 or len(more) != 1:
                raise BadExpression(token)
            stack.append((1 if a == 2 else a, f"{left} WITH {right}", names))
        else:
            grade = max(a, b) if token == "and" else min(a, b)
            stack.append((grade, f"({left} {token.upper()} {right})", names + more))
    return stack.pop()


def tag_expressions(text: bytes) -> Iterator[str]:
    """What stands after each tag, up to the end of its line or of the comment around it."""
    for found in TAG.finditer(text):
        line = found[1].decode("utf-8", "replace")
        yield re.split(r"\*/|-->|[\"'`;,]|\.\s|\.$", line)[0].strip()


class Scanner:
    """The automaton over ``" words of a phrase "``; works on bytes read as Latin-1 characters."""

    def __init__(self, base: dict[str, str], notices: dict[str, tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for phrase in {*base, *notices, TAG_WORDS}:
            label, weight = notices.get(phrase, (base.get(phrase), 0.5))
            self.automaton.add_word(f" {phrase} ".encode().decode("latin-1"), (
                len(phrase.encode()) + 2, base.get(phrase), label if phrase != TAG_WORDS else None, weight,
            ))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        words = text.translate(WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        gaps = None
        places: list[int] = []
        base_labels: set[str] = set()
        weights: dict[str, float] = {}
        tagged = False
        for end, (length, base, label, weight) in self.automaton.iter(line.decode("latin-1")):
            if base:
                if gaps is None:
                    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                places.append(bisect_right(gaps, end - length + 1) - 1)
                base_labels.add(base)
            if label:
                weights[label] = max(weight, weights.get(label, 0.0))
            else:
                tagged = True
        written, bad, n_tags, grade = [], 0, 0, None
        for expression in tag_expressions(text) if tagged else ():
            n_tags += 1
            try:
                strict, plain, names = evaluate(to_postfix(expression))
            except BadExpression:
                bad += 1
                continue
            written.append(plain)
            grade = strict if grade is None else max(grade, strict)
            for name in names:
                weights[name] = max(TAG_WEIGHT, weights.get(name, 0.0))
        doubt = 1.0
        for label in sorted(weights):
            doubt *= 1.0 - weights[label]
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(weights)), round(1.0 - doubt, 6) if weights else 0.0,
            n_tags, bad, "; ".join(dict.fromkeys(written)), None if grade is None else GRADES[grade],
        )


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_tags long, n_bad_tags long, expressions string, grade string"
)
_ARROW = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(),
    pa.string(), pa.string(),
]


def scan_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, tuple[str, float]] = NOTICE_PHRASES,
) -> DataFrame:
    """One row per document: places of base phrases, labels of all evidence, parsed tag expressions.

    ``score`` is the probability that at least one piece of evidence is right, each taken as independent.
    """
    names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            rows = list(zip(*map(scanner.scan, texts_of(batch)))) or [()] * len(_ARROW)
            arrays = [pa.array(values, kind) for values, kind in zip(rows, _ARROW)]
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), *arrays], names)

    return ids_and_texts(docs).mapInArrow(run, SCHEMA)
