"""License scans: Aho-Corasick over words and tags, a shunting-yard parser for licence expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import arrow_map, read

#: Phrases of the base labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Other phrases of notices, with their label.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc", "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd", "permission is hereby granted free of charge": "mit", "this is free and unencumbered software": "unlicense", "cc0 1 0 universal": "cc0", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "boost software license": "bsl",
    "all rights reserved": "reserved", "licensed under the": "notice", "released under the": "notice", "is licensed under": "notice",
}

#: Families of licence identifiers (lower case), with label and burden: 0 permissive, 1 weak copyleft, 2 copyleft, 3 restricted.
#: An identifier belongs to the family of most hyphenated parts that it starts with: mpl-2.0 to mpl, cc-by-nc-4.0 to cc-by-nc.
FAMILIES = {
    "0bsd": ("bsd", 0), "afl": ("afl", 0), "agpl": ("agpl", 2), "apache": ("apache", 0), "apsl": ("apsl", 1), "artistic": ("artistic", 1), "beerware": ("beerware", 0), "blueoak": ("blueoak", 0), "bsd": ("bsd", 0), "bsl": ("bsl", 0), "busl": ("busl", 3),
    "cc-by": ("cc-by", 0), "cc-by-nc": ("cc-by-nc", 3), "cc-by-nd": ("cc-by-nd", 3), "cc-by-sa": ("cc-by-sa", 2), "cc-pddc": ("cc0", 0), "cc0": ("cc0", 0), "cddl": ("cddl", 1), "cecill": ("cecill", 2), "cecill-b": ("cecill", 0), "cecill-c": ("cecill", 1), "cpal": ("cpal", 1), "cpl": ("cpl", 1), "curl": ("curl", 0),
    "ecl": ("apache", 0), "elastic": ("elastic", 3), "epl": ("epl", 1), "eupl": ("eupl", 2), "fsfap": ("fsfap", 0), "gfdl": ("gfdl", 2), "gpl": ("gpl", 2), "hpnd": ("hpnd", 0), "icu": ("icu", 0), "ijg": ("ijg", 0), "ipl": ("ipl", 1), "isc": ("isc", 0), "lgpl": ("lgpl", 1), "lgpllr": ("lgpl", 1), "libpng": ("zlib", 0), "lppl": ("lppl", 1),
    "mit": ("mit", 0), "mpl": ("mpl", 1), "ms-pl": ("ms-pl", 0), "ms-rl": ("ms-rl", 1), "mulanpsl": ("mulanpsl", 0), "naist": ("naist", 0), "ncsa": ("ncsa", 0), "odbl": ("odbl", 2), "odc-by": ("odc-by", 0), "ofl": ("ofl", 1), "openssl": ("openssl", 0), "osl": ("osl", 2), "pddl": ("pddl", 0), "php": ("php", 0), "postgresql": ("postgresql", 0), "proprietary": ("reserved", 3),
    "python": ("python", 0), "psf": ("python", 0), "qpl": ("qpl", 1), "ruby": ("ruby", 0), "sspl": ("sspl", 3), "unicode": ("unicode", 0), "unlicense": ("unlicense", 0), "upl": ("upl", 0), "vim": ("vim", 0), "w3c": ("w3c", 0), "wtfpl": ("wtfpl", 0), "x11": ("mit", 0), "zlib": ("zlib", 0), "zpl": ("zpl", 0),
}


def identified(name: str) -> tuple[str, int]:
    """Label and burden of an identifier; one of no family is `other`, as heavy as can be."""
    parts = name.removesuffix("+").split("-", 8)[:8]
    for n in range(len(parts), 0, -1):
        if (own := "-".join(parts[:n])) in FAMILIES:
            return FAMILIES[own]
    return "other", 3


#: Tags that an identifier expression follows on their line.
TAGS = ("spdx-license-identifier:", "license-expression:")

_LOWER = {i: i + 32 for i in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[()]|[^\s()]+")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str, start: int = 0, stop: int | None = None) -> list[str] | None:
    """The longest expression that text[start:stop] starts with, in postfix, by the shunting-yard algorithm; None if there is none.

    with binds closer than and, and closer than or; operators of one kind group to the left. What
    follows a whole expression without an operator is not part of it. Time is linear: a whole expression
    is remembered as the length of the output and the operators that wait, three at most.
    """
    out: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] | None = None
    operand, depth = True, 0
    for m in _TOKEN.finditer(text, start, len(text) if stop is None else stop):
        t = m[0].lower()
        if operand:
            if t == "(":
                stack.append(t)
                depth += 1
                continue
            if t == ")" or t in _BINDS:
                break
            out.append(t.rstrip(",;*/"))
            operand = False
        elif t == ")":
            if not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif t in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = True
        else:
            break
        if not operand and not depth:
            best = len(out), stack[:]
    return best and [*out[: best[0]], *reversed(best[1])]


def evaluate(postfix: list[str]) -> tuple[set[str], int]:
    """Labels and burden: or takes the lighter side, and the heavier one; an exception lightens by one.

    Every identifier gives its label; one that isn't known gives `other`, as heavy as can be.
    """
    stack: list[tuple[set[str], int]] = []
    for t in postfix:
        if t in _BINDS:
            right, left = stack.pop(), stack.pop()
            if t == "with":
                stack.append((left[0], max(0, left[1] - 1)))
            else:
                stack.append((left[0] | right[0], (min if t == "or" else max)(left[1], right[1])))
        else:
            label, burden = identified(t)
            stack.append(({label}, burden))
    return stack[0]


def scanner() -> Callable[[str | None], tuple]:
    """A function of a text: (n_words, n_base, first_word, last_word, base_labels, labels, expressions, burden, score)."""
    import ahocorasick

    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    phrases: dict[str, list[tuple[str, bool]]] = {}
    for table, base in ((BASE, True), (NOTICES, False)):
        for phrase, label in table.items():
            phrases.setdefault(phrase, []).append((label, base))
    for phrase, labels in phrases.items():
        words.add_word(f" {phrase} ", (len(phrase) + 1, labels))
    for tag in TAGS:
        tags.add_word(tag, tag)
    words.make_automaton()
    tags.make_automaton()

    def scan(text: str | None) -> tuple:
        low = (text or "").translate(_LOWER)
        found = _WORD.findall(low)
        line = f" {' '.join(found)} "
        n_base, first, last, base, labels, weight = 0, None, None, set(), set(), 1.0
        at, word = 0, 0
        for end, (back, own) in words.iter(line):
            begin = end - back
            for label, is_base in own:
                if is_base:
                    # Ends ascend, starts need not: count on from the last place, either way.
                    word += line.count(" ", at, begin) if begin >= at else -line.count(" ", begin, at)
                    at = begin
                    n_base += 1
                    first, last = word if first is None else min(first, word), word if last is None else max(last, word)
                    base.add(label)
                    weight *= 0.2
                elif label != "notice":
                    labels.add(label)
                    weight *= 0.4
                else:
                    weight *= 0.6
        expressions, burden = [], None
        places, line_end = [(end + 1, end + 1 - len(tag)) for end, tag in tags.iter(low)], -1
        for k, (start, _) in enumerate(places):
            if line_end < start:
                line_end = _line_end(low, start)
            # The next tag ends an expression too, so that no part of a line is parsed twice.
            postfix = parse_expression(low, start, min(line_end, places[k + 1][1]) if k + 1 < len(places) else line_end)
            if postfix:
                own_labels, own_burden = evaluate(postfix)
                labels |= own_labels
                burden = own_burden if burden is None else max(burden, own_burden)
                expressions.append(" ".join(postfix))
                weight *= 0.05
        every = base | labels
        return len(found), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(every)), expressions, burden, round(1 - weight, 6)

    return scan


def _line_end(text: str, start: int) -> int:
    at = text.find("\n", start)
    return len(text) if at < 0 else at


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, burden) for every row.

    One automaton runs over the words of the whole lower-cased text, joined by blanks, and finds every
    place of every phrase, overlapping ones too; another finds identifier tags, whose expression, to the
    end of the line or the next tag, is parsed and evaluated. labels has those of base phrases, of other notices and of
    identifiers. score is 1 less the product of the doubts that each finding leaves (0.2 for a base
    phrase, 0.4 for another, 0.6 for the wording of a notice, 0.05 for a tag). burden, of
    expressions: 0 permissive to 3 restricted.

    Cases: a null or empty text has no words, empty label strings, null places and score 0; a tag
    without an expression gives nothing; very long texts, lines and expressions take linear time; each row
    gives a row; no rows: none. Other columns are not read.
    """

    def run(batches):
        scan = scanner()
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for a in range(0, batch.num_rows, 500):
                rows = [scan(t.as_py()) for t in column.slice(a, 500)]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.float64()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, 500), *arrays], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "burden", "score"])

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, expressions array<string>, burden int, score double"
    return plain.mapInArrow(run, schema).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "burden")


def op6_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return scan_licenses(read(spark, sf_dir, "documents"))
