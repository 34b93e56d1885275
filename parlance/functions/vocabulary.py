"""Names and organisations as word forms, and the patterns that find them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from .normalize import fold, translit

#: Least lengths of terms.
PERSON_LEAST, ORG_LEAST = 3, 2
#: Names that are looked for one by one before words are looked up.
FEW_NAMES = 64
#: Case endings of Russian and Latin nouns.
CASES = ("а", "у", "ом", "ем", "е", "ы", "и", "я", "ю", "ой", "ей", "ов", "ев", "ам", "ям", "ами", "ями", "ах", "ях", "ого", "ому", "ым", "им", "ую", "ые", "ых", "ия", "ию")
LATIN_CASES = ("a", "u", "om", "em", "e", "y", "oi", "oy", "s", "'s")
ADJECTIVES = ("ый", "ий", "ой", "ого", "его", "ому", "ему", "ым", "им", "ом", "ем", "ая", "яя", "ую", "юю", "ей", "ые", "ие", "ых", "их", "ыми", "ими")
#: Words of titles that name products or roles and no organisation.
GENERIC = frozenset(
    "api sdk pay card cards wallet store bank billing support sales team client staff integration checkout webhook webhooks refund refunds sandbox subscription subscriptions widget p2p b2b b2c pos nfc sbp "
    "group llc ltd inc the and chat test prod dev v1 v2 l1 l2 crypto payment payments payout payouts merchant gateway service services technology technologies company "
    "групп группа банк технологии сервис поддержка продажи клиент команда касса вебхуки возвраты подписки песочница миграция сверка отчёты отчеты чеки фискализация ккт офд сбп прод кабинет личный оплата сделка сплит подключение карты карта чат тест ооо ип ао 1с интеграция".split()
)
_LETTER_DIGIT = re.compile(r"(?=.*\d)(?=.*[^\W\d_])")
_CONSTANT = re.compile(r"[A-ZА-ЯЁ][A-ZА-ЯЁ0-9]*(?:_[A-ZА-ЯЁ0-9]+)+")


def title_tokens(title: str) -> list[str]:
    """Significant words of a chat title: longer than two characters, or a letter with a digit, and not generic."""
    out = []
    for word in re.findall(r"[^\W_]+(?:[-'][^\W_]+)*", fold(title)):
        if (len(word) > 2 or len(word) == 2 and _LETTER_DIGIT.match(word)) and word not in GENERIC and not word.isdigit():
            out.append(word)
    return list(dict.fromkeys(out))


def _word_forms(word: str, inflect: bool) -> str:
    """Pattern of a word's forms: endings, the other e, an adjective's declension."""
    if not inflect or not word[-1:].isalpha() or len(word) < 3:
        return re.escape(word).replace("е", "[её]")
    endings: tuple[str, ...] = CASES if re.search("[а-я]", word) else LATIN_CASES
    stem = word
    for a in ("ский", "цкий", "ская", "цкая"):
        if word.endswith(a):
            stem, endings = word[:-2], ADJECTIVES
    if stem == word and re.search(r"[аяйьоиы]$", word) and len(word) > 3:
        stem, endings = word[:-1], (word[-1], *endings)
    elif stem == word and word.endswith(("ец", "ок", "ек")) and len(word) > 4:
        return f"(?:{re.escape(word)}|{re.escape(word[:-2] + word[-1])}(?:{'|'.join(CASES)}))"
    return f"{re.escape(stem).replace('е', '[её]')}(?:{'|'.join(sorted(endings, key=len, reverse=True))})?"


class Terms:
    """Finds terms in every spelling, in time that doesn't depend on how many there are.

    A term's forms share their first letters. These lead from a place in the
    text to the few terms that may stand there, whose pattern is compiled when
    it is first needed. The longest match at a place counts; whole words only,
    `_` and a number after count as bounds.
    """

    def __init__(self, terms: list[str], inflect: bool = True) -> None:
        forms: dict[str, dict[str, int]] = {}
        for term in terms:
            folded = fold(term)
            for spelling in {folded, translit(folded)}:
                if words := spelling.split():
                    # no ending reaches into these letters
                    size = len(words[0])
                    head = words[0][: size if size < 4 else min(6, size - 2)]
                    forms.setdefault(head, {})[r"[ \t_-]{1,2}".join(_word_forms(w, inflect) for w in words)] = len(spelling)
        self._forms = forms
        self._compiled: dict[str, re.Pattern] = {}
        self._sizes = sorted({len(h) for h in forms}, reverse=True)
        firsts = {h[0] for h in forms} | ({"ё"} if any(h[0] == "е" for h in forms) else set())
        self._place = re.compile(rf"(?<![^\W_])[{''.join(map(re.escape, sorted(firsts)))}]" if firsts else "(?!)", re.IGNORECASE)

    def __bool__(self) -> bool:
        return bool(self._forms)

    def _pattern(self, head: str) -> re.Pattern:
        found = self._compiled.get(head)
        if found is None:
            own = self._forms[head]
            body = "|".join(sorted(own, key=lambda a: (-own[a], a)))
            found = self._compiled[head] = re.compile(rf"(?:{body})(?=_|\d+(?!\w)|\W|$)", re.IGNORECASE)
        return found

    def finditer(self, text: str) -> Iterator[re.Match]:
        folded = text.lower().replace("ё", "е")
        if len(folded) != len(text):  # a capital whose small form has two characters
            folded = "".join(c if len(c) == 1 else "\ue000" for c in map(str.lower, text)).replace("ё", "е")
        end = 0
        for place in self._place.finditer(text):
            at = place.start()
            if at < end:
                continue
            best = None
            for size in self._sizes:
                head = folded[at : at + size]
                if head in self._forms and (m := self._pattern(head).match(text, at)) and (best is None or m.end() > best.end()):
                    best = m
            if best:
                end = best.end()
                yield best

    def search(self, text: str) -> re.Match | None:
        return next(self.finditer(text), None)


def term_pattern(terms: list[str], inflect: bool = True) -> Terms | None:
    """A finder of all terms, None without any."""
    return Terms(terms, inflect) or None


class Numbers:
    """Finds known numbers in any grouping: runs of digits are looked up, at their group borders."""

    _RUN = re.compile(r"\d+(?:[ ().\-\t]{1,3}\d+)*")
    _GROUP = re.compile(r"\d+")

    def __init__(self, numbers: frozenset[str]) -> None:
        self.numbers = numbers
        self.most = max(map(len, numbers), default=0)

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for run in self._RUN.finditer(text):
            if run.end() - run.start() < 7:
                continue
            groups = [m.span() for m in self._GROUP.finditer(text, run.start(), run.end())]
            at = 0
            while at < len(groups):
                digits, best = "", None
                for k in range(at, len(groups)):
                    digits += text[slice(*groups[k])]
                    if len(digits) > self.most:
                        break
                    if digits in self.numbers:
                        best = k
                if best is None:
                    at += 1
                else:
                    yield groups[at][0], groups[best][1]
                    at = best + 1


def inside_constant(text: str, start: int, end: int) -> bool:
    """Whether a span lies in an ALL_CAPS constant of fewer than 40 characters that is no file name."""
    a, b = start, end
    while a and (text[a - 1].isalnum() or text[a - 1] == "_"):
        a -= 1
    while b < len(text) and (text[b].isalnum() or text[b] == "_"):
        b += 1
    return b - a < 40 and bool(_CONSTANT.fullmatch(text[a:b])) and not re.match(r"\.[a-z]{2,4}\b", text[b:])


@dataclass(frozen=True)
class Roster:
    """What is known of participants and chats, for the scrubber and the scanner."""

    usernames: dict[str, str] = field(default_factory=dict)  # lower-case username -> virtual id
    ids: frozenset[int] = frozenset()
    phones: frozenset[str] = frozenset()  # digits
    persons: tuple[str, ...] = ()
    organisations: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        kept = {fold(k) for k in self.keep}
        put = lambda name, x: object.__setattr__(self, name, x)
        put("keep_folded", frozenset(kept))
        put("person_pattern", term_pattern([p for p in self.persons if len(p) >= PERSON_LEAST and fold(p) not in kept]))
        put("org_pattern", term_pattern([o for o in self.organisations if len(o) >= ORG_LEAST and fold(o) not in kept]))
        put("keep_pattern", term_pattern(list(self.keep), inflect=False))
        put("id_numbers", frozenset(str(n) for i in self.ids for n in id_forms(i) if len(str(n)) >= 6))
        put("bare_names", frozenset(n for n in self.usernames if len(n) >= 8 or "_" in n or any(c.isdigit() for c in n)))
        forms = {p for p in self.phones if len(p) >= 7} | {p[1:] for p in self.phones if len(p) == 11 and p[0] in "78"}
        put("known_phones", Numbers(frozenset(forms)) if forms else None)

    def id_spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Places of known ids."""
        if self.id_numbers:
            for m in _NUMBER.finditer(text):
                if m[0] in self.id_numbers:
                    yield m.span()

    def username_spans(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Places of known usernames, after `@` with a case ending, or bare where they look like one, and their virtual ids."""
        if self.usernames and "@" in text:
            for m in _AT_NAME.finditer(text):
                if vid := self.usernames.get(m["u"].lower()):
                    yield *m.span(), vid
        lower = text.lower() if 0 < len(self.bare_names) <= FEW_NAMES else ""
        if len(self.bare_names) > FEW_NAMES or any(n in lower for n in self.bare_names):
            for m in _BARE_NAME.finditer(text):
                name = m[0].lower()
                if name not in self.bare_names:
                    name = name.lstrip("_")
                if name in self.bare_names and name not in self.keep_folded:
                    yield m.end() - len(name), m.end(), self.usernames[name]


_NUMBER = re.compile(r"(?<![\d.,])\d{6,}(?!\d|[.,]\d)")
_AT_NAME = re.compile(r"@[ ]?(?P<u>[A-Za-z0-9_]+)(?:[а-яё]{1,3})?(?![A-Za-z0-9_])", re.IGNORECASE)
_BARE_NAME = re.compile(r"(?<![A-Za-z0-9_@])[A-Za-z0-9_]+(?![A-Za-z0-9_])")


def id_forms(value: int) -> set[int]:
    """Spellings of a marked chat or user id: without sign, and without the channel mark."""
    n = abs(value)
    out = {n}
    if len(str(n)) > 10 and str(n).startswith("100"):
        out.add(int(str(n)[3:]))
    return out
