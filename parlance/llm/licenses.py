"""Licence scans: Aho-Corasick over tags and notice phrases, shunting-yard over expressions."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import ALNUM, LOWER, map_blocks

#: The phrases whose places are counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of the method's own, as words.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "unlicense": "unlicense",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: Families of licence identifiers, by how an identifier begins.
FAMILIES = {"apache": "apache", "mit": "mit", "lgpl": "lgpl", "agpl": "agpl", "gpl": "gpl", "bsd": "bsd", "mpl": "mpl", "epl": "epl", "isc": "isc", "bsl": "bsl", "cc0": "cc0", "unlicense": "unlicense", "zlib": "zlib"}
PERMISSIVE = frozenset({"apache", "mit", "bsd", "isc", "bsl", "cc0", "unlicense", "zlib", "public-domain"})

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.:+-]*")
_TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_SPACES = bytes(LOWER[b] if ALNUM[b] else 0x20 for b in range(256))


def to_rpn(tokens: list[str]) -> list[str] | None:
    """Reverse Polish form of an expression's tokens by the shunting-yard algorithm; None if it isn't one."""
    out: list[str] = []
    held: list[str] = []
    operand = True
    for t in tokens:
        low = t.lower()
        if low in _PRECEDENCE:
            if operand:
                return None
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[low]:
                out.append(held.pop())
            held.append(low)
            operand = True
        elif t == "(":
            if not operand:
                return None
            held.append(t)
        elif t == ")":
            if operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if not operand:
                return None
            out.append(low)
            operand = False
    if operand or "(" in held:
        return None
    return out + held[::-1]


def family(identifier: str) -> str:
    """Label of a licence identifier."""
    for start, label in FAMILIES.items():
        if identifier.startswith(start):
            return label
    return identifier


def evaluate(rpn: list[str]) -> tuple[set[str], bool]:
    """Labels an expression names, and whether some choice it offers is permissive throughout.

    `or` offers a choice, `and` binds both sides, `with` adds an exception to
    the licence on its left.
    """
    stack: list[tuple[str | None, bool]] = []  # the label of a bare identifier, and what is left open by choice
    labels: set[str] = set()
    for t in rpn:
        if t == "with":
            stack.pop()
        elif t in _PRECEDENCE:
            (right, free), (left, may) = stack.pop(), stack.pop()
            labels |= {x for x in (left, right) if x is not None}
            stack.append((None, may or free if t == "or" else may and free))
        else:
            label = family(t)
            stack.append((label, label in PERMISSIVE))
    return labels | ({stack[0][0]} - {None}), stack[0][1]


def _expression(line: str) -> tuple[set[str], bool] | None:
    """The longest beginning of a tag's line that is an expression and isn't cut before an operator; its tokens are read once."""
    tokens = _TOKEN.findall(line)
    end, depth, operand = 0, 0, True
    for n, t in enumerate(tokens):
        low = t.lower()
        if low in _PRECEDENCE or t == ")":
            if operand:
                break
            operand = low in _PRECEDENCE
            depth -= t == ")"
            if depth < 0:
                break
        else:
            if not operand:
                break
            operand = t == "("
            depth += operand
        if not operand and not depth and (n + 1 == len(tokens) or tokens[n + 1].lower() not in _PRECEDENCE):
            end = n + 1
    rpn = to_rpn(tokens[:end]) if end else None
    return evaluate(rpn) if rpn else None


def automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICES, TAG]:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def scan_text(text: str, machine: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, permissive of one text."""
    plain = b" ".join(text.encode("utf-8", "surrogatepass").translate(_SPACES).split())
    if not plain:
        return 0, 0, None, None, "", "", 0.0, None
    padded = f" {plain.decode('latin-1')} "
    base: list[tuple[int, str]] = []
    own: set[str] = set()
    tagged = False
    for end, phrase in machine.iter(padded):
        if phrase in BASE_PHRASES:
            base.append((end - len(phrase) - 1, BASE_PHRASES[phrase]))
        elif phrase == TAG:
            tagged = True
        else:
            own.add(NOTICES[phrase])
    permissive: bool | None = None
    parsed = False
    if tagged:
        for line in _TAG_LINE.findall(text):
            if found := _expression(line):
                own |= found[0]
                permissive = found[1] if permissive is None else permissive and found[1]
                parsed = True
    base_labels = {label for _, label in base}
    score = 1.0 if parsed else 0.9 if base else 0.6 if own else 0.0
    if base:
        starts = [at for at, _ in base]
        first, last = padded.count(" ", 0, min(starts)), padded.count(" ", 0, max(starts))
    else:
        first = last = None
    labels = base_labels | own
    if permissive is None and labels:
        permissive = all(family(label) in PERMISSIVE for label in labels)
    return plain.count(b" ") + 1, len(base), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, permissive


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence phrases, tags and expressions of every row's text.

    Returns id, n_words, n_base (places of base phrases), first_word and
    last_word (smallest and largest start of one, in words from 0, else null),
    base_labels and labels (distinct, sorted, comma-joined; empty if none),
    score (1 with an expression that parses, 0.9 with a base phrase, 0.6 with
    another notice, else 0) and permissive (null without labels). A null text
    is empty; repeated rows repeat; an empty table gives no rows; other columns
    are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held: list = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(automaton())
        rows = [scan_text(t or "", held[0]) for t in batch.column(text_col).to_pylist()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"]
        return pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], [id_col, *names])

    return map_blocks(docs.select(id_col, text_col), text_col, run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean")
