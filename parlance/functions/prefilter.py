"""Which rules can match a text at all, told from the text's digits, its longest word and a few substrings.

What a pattern needs is read off its parse tree, so that it holds by
construction: at least so many digits, so many of them in a row, so many
characters without a blank, a Cyrillic letter. A rule's hints are substrings
of which one must occur. Rules are bits of a number: a text's bits are those
that none of its properties rules out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import cache
from typing import Protocol

try:
    from re import _constants as _op
    from re import _parser
except ImportError:  # another Python: rules are told apart by hints alone
    _parser = None

#: Most digits and characters that are told apart.
_MOST = 96
#: Sets of rules that are remembered.
_PLANS = 4096
_CYRILLIC = "Ѐ-ԯᲀ-᲏"
CYRILLIC = re.compile(f"[{_CYRILLIC}]")
_IS_CYRILLIC = re.compile(f"[{_CYRILLIC}]").fullmatch
_DIGITS = re.compile("[0-9]+")


class Hinted(Protocol):
    pattern: re.Pattern
    hints: tuple[str, ...]
    digits: bool


#: Characters that `isdigit` holds for and that are no decimal digits; beyond the first plane, where few are, all.
_ODD_DIGIT = re.compile("[" + "".join(c for c in map(chr, range(128, 0x10000)) if c.isdigit() and not c.isdecimal()) + "\U00010000-\U0010ffff]")


def _kind_of_set(items: list) -> str:
    """d: digits only, c: Cyrillic only, t: no blank, x: anything."""
    kinds = set()
    for op, value in items:
        if op is _op.NEGATE:
            return "t" if any(o is _op.CATEGORY and v in (_op.CATEGORY_SPACE, _op.CATEGORY_NOT_WORD) for o, v in items) else "x"
        if op is _op.LITERAL:
            value = (value, value)
        if op in (_op.LITERAL, _op.RANGE):
            low, high = chr(value[0]), chr(value[1])
            if "0" <= low and high <= "9":
                kinds.add("d")
            elif _IS_CYRILLIC(low) and _IS_CYRILLIC(high):
                kinds.add("c")
            else:
                kinds.add("x" if any(chr(i).isspace() for i in range(value[0], min(value[1], 0x3000) + 1)) else "t")
        else:
            kinds.add({_op.CATEGORY_DIGIT: "d", _op.CATEGORY_WORD: "t", _op.CATEGORY_NOT_SPACE: "t"}.get(value, "x"))
    return kinds.pop() if len(kinds) == 1 else "x" if "x" in kinds else "t"


class _Need:
    """What a match holds at least: digits, Cyrillic letters, digits in a row, characters in a row without a blank."""

    def __init__(self) -> None:
        self.digits = self.cyrillic = self.run = self.word = 0
        self._run = self._word = 0  # those that end the match so far

    def chars(self, kind: str, n: int) -> None:
        """At least `n` characters of a kind."""
        self.digits += n if kind == "d" else 0
        self.cyrillic += n if kind == "c" else 0
        self._run = self._run + n if kind == "d" else 0
        self._word = self._word + n if kind != "x" else 0
        self.run, self.word = max(self.run, self._run), max(self.word, self._word)

    def part(self, p: _Need) -> None:
        """A part that may begin and end with anything."""
        self.digits, self.cyrillic = self.digits + p.digits, self.cyrillic + p.cyrillic
        self.run, self.word = max(self.run, p.run), max(self.word, p.word)
        self._run = self._word = 0


def _need(items: Iterable) -> _Need:
    out = _Need()
    for op, value in items:
        if op is _op.LITERAL:
            out.chars(_kind_of_set([(op, value)]), 1)
        elif op is _op.IN:
            out.chars(_kind_of_set(value), 1)
        elif op in (_op.MAX_REPEAT, _op.MIN_REPEAT, _op.POSSESSIVE_REPEAT):
            least, most, body = value
            if len(body) == 1 and body[0][0] in (_op.LITERAL, _op.IN):
                out.chars(_kind_of_set([body[0]] if body[0][0] is _op.LITERAL else body[0][1]), int(least))
            else:
                part = _need(body)
                part.digits, part.cyrillic = part.digits * int(least), part.cyrillic * int(least)
                out.part(part if least else _Need())
        elif op is _op.SUBPATTERN:
            out.part(_need(value[3]))
        elif op is _op.ATOMIC_GROUP:
            out.part(_need(value))
        elif op is _op.BRANCH:
            ways = [_need(way) for way in value[1]]
            part = _Need()
            for name in ("digits", "cyrillic", "run", "word"):
                setattr(part, name, min(getattr(w, name) for w in ways))
            out.part(part)
        elif op in (_op.AT, _op.ASSERT, _op.ASSERT_NOT):
            continue
        else:
            out.chars("x", 0)
    return out


@cache
def _needs(pattern: re.Pattern) -> _Need:
    return _need(_parser.parse(pattern.pattern, pattern.flags)) if _parser else _Need()


class Look:
    """What is known of a text before any rule is tried."""

    def __init__(self, text: str) -> None:
        self.lower = text.lower()
        runs = list(map(len, _DIGITS.findall(text)))
        self.digits, self.run = min(sum(runs), _MOST), min(max(runs, default=0), _MOST)
        plain = text.isascii()
        self.numeric = bool(runs) or not plain and _ODD_DIGIT.search(text) is not None
        self.cyrillic = not plain and CYRILLIC.search(text) is not None
        self.word = min(max(map(len, text.split()), default=0), _MOST)


class Choice:
    """Rules in order, and which of them a text may match."""

    def __init__(self, rules: Sequence[Hinted]) -> None:
        self.rules = tuple(rules)
        needs = [_needs(r.pattern) for r in self.rules]
        own = lambda test: sum(1 << i for i, (r, n) in enumerate(zip(self.rules, needs, strict=True)) if test(r, n))
        self._unhinted = own(lambda r, n: not r.hints)
        self._plain = own(lambda r, n: not r.digits)
        self._no_cyrillic = own(lambda r, n: not n.cyrillic)
        self._by_digits = [own(lambda r, n, k=k: min(n.digits, _MOST) <= k) for k in range(_MOST + 1)]
        self._by_run = [own(lambda r, n, k=k: min(n.run, _MOST) <= k) for k in range(_MOST + 1)]
        self._by_word = [own(lambda r, n, k=k: min(n.word, _MOST) <= k) for k in range(_MOST + 1)]
        self._hints = {h: own(lambda r, n, h=h: h in r.hints) for r in self.rules for h in r.hints}
        self._plans: dict[int, tuple[int, tuple[tuple[str, int], ...]]] = {}
        self._chosen: dict[int, tuple[Hinted, ...]] = {}

    def _plan(self, may: int, cyrillic: bool) -> tuple[int, tuple[tuple[str, int], ...]]:
        """Of rules that may match: those without hints, and the others by hint."""
        found = may & self._unhinted
        return found, tuple((h, bits & may & ~found) for h, bits in self._hints.items() if bits & may & ~found and (cyrillic or h.isascii()))

    def of(self, look: Look) -> tuple[Hinted, ...]:
        may = self._by_digits[look.digits] & self._by_run[look.run] & self._by_word[look.word]
        if not look.numeric:
            may &= self._plain
        if not look.cyrillic:
            may &= self._no_cyrillic
        key = may << 1 | look.cyrillic
        plan = self._plans.get(key)
        if plan is None:
            if len(self._plans) >= _PLANS:
                self._plans.clear()
            plan = self._plans[key] = self._plan(may, look.cyrillic)
        found, hints = plan
        lower = look.lower
        for hint, bits in hints:
            if hint in lower:
                found |= bits
        chosen = self._chosen.get(found)
        if chosen is None:
            if len(self._chosen) >= _PLANS:
                self._chosen.clear()
            chosen = self._chosen[found] = tuple(r for i, r in enumerate(self.rules) if found >> i & 1)
        return chosen
