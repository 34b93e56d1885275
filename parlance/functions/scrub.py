"""The scrubber and the leak scanner: layers over one rule table.

Text is cut into claimed spans and free text. A layer sees the text with
claimed spans blanked by a filler that no pattern matches, so what one layer
has replaced is out of reach of the next; the replacements go in at the end.
The scanner runs the same layers on text whose placeholders are claimed first:
whatever the scrubber removes it reports, and on scrubbed text it is silent.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.policy import Anonymize
from .cards import LEAST, find_cards, inside_hash
from .links import BARE, BARE_END, allowed, host_of, is_bare_host, keeps_host, url_placeholder
from .normalize import FILLER, plain_text, utf16_span
from .prefilter import Choice, Look
from .rules import BEFORE_CARDS, CONTEXTUAL, IDENTITIES, NUMBERS, TABLE, Rule, digits_of, seed_spans, span, value
from .vocabulary import Roster, inside_constant

#: Words of placeholders.
PLACEHOLDERS = (
    "name cardholder email phone address postcode dob org domain id url tg-link ip proxy user-agent sub card exp cvv pin otp iban account bank-code txn-ref wallet txid seed-phrase "
    "ad-account passport driver-licence iin rnokpp inn ogrn snils tax-id personal-id company-id device-id password credentials 2fa-secret token private-key cookie redacted".split()
)
OPAQUE = re.compile(rf"<(?:{'|'.join(PLACEHOLDERS)})(?:\.[\w.-]+)?>|<url:[^<>\s]{{1,255}}>|@user\b|@[UC]\d{{5,9}}\b|\b\d{{6}}\*{{4,}}|act_<id>")
_TRAILER = re.compile(r"[ \t|;:,/]{0,3}\n?[ \t]{0,3}(?:exp\.?|до|срок)?[ \t:]{0,2}(?P<exp>(?:0[1-9]|1[0-2])[ ]?[/|.\-][ ]?(?:20)?\d{2})(?![\d./])(?:[ \t|;:,/]{1,3}\n?[ \t]{0,3}(?:cvv2?|cvc2?)?[ \t:]{0,2}(?P<cvv>\d{3,4})(?!\d))?", re.IGNORECASE)
_WORD = re.compile(r"\d{8,}")
_OWN_MASK = re.compile(r"\d{6}\*{4,}")
choice = functools.cache(Choice)


class Claims:
    """A text with the spans that layers have claimed."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: list[tuple[int, int, str, str]] = []  # start, end, replacement, rule
        self.later: list[tuple[int, int, str, str]] = []  # claims that stand back for those of other rules
        self._taken = bytearray(len(text))
        self._masked, self._shown = text, 0  # the text without the first spans, and how many of them

    @property
    def masked(self) -> str:
        """The text with claimed spans blanked."""
        if self._shown < len(self.spans):
            out, at = [], 0
            for a, b, _, _ in sorted(self.spans[self._shown :]):
                out += [self._masked[at:a], FILLER * (b - a)]
                at = b
            self._masked, self._shown = "".join([*out, self._masked[at:]]), len(self.spans)
        return self._masked

    def free(self, a: int, b: int) -> bool:
        return a < b and self._taken.find(1, a, b) < 0

    def claim(self, a: int, b: int, replacement: str, rule: str) -> bool:
        if not self.free(a, b):
            return False
        self.spans.append((a, b, replacement, rule))
        self._taken[a:b] = b"\x01" * (b - a)
        return True

    def gaps(self, a: int, b: int) -> list[tuple[int, int]]:
        """Free stretches of a range."""
        out = []
        while a < b:
            start = self._taken.find(0, a, b)
            if start < 0:
                break
            stop = self._taken.find(1, start, b)
            a = stop if stop >= 0 else b
            out.append((start, a))
        return out

    def result(self) -> str:
        out, at = [], 0
        for a, b, replacement, _ in sorted(self.spans):
            out += [self.text[at:a], replacement]
            at = b
        return "".join([*out, self.text[at:]])


#: Rules that need no label, so they hold in the path of a link, whose words and numbers are routes and ids.
PATH_RULES = frozenset("proxy tg_link url bot_token jwt credentials fb_token known_secret wallet txid ad_account email".split())
_HEAD = re.compile(r"(?:[a-z][a-z0-9+.-]*://)?[^/?#]*", re.IGNORECASE)
_SEGMENT = re.compile(r"(?<=[/?&=#;])[^/?&=#;]+")
_PLUS_PHONE = re.compile(r"\+\d{10,15}(?!\d)")
#: Parts of a query key, and what its value is.
_TELLING = (("pass pwd", "<password>"), ("token secret key", "<token>"), ("inn", "<inn>"), ("otp", "<otp>"), ("phone tel msisdn mobile", "<phone>"), ("mail", "<email>"), ("card", "<card>"))


def _readable(part: str) -> str:
    """A part of a link without percent escapes, unless they spell the link's own signs or nothing printable."""
    if "%" not in part:
        return part
    try:
        found = unquote(part, errors="strict")
    except UnicodeDecodeError:
        return part
    return part if not found.isprintable() or any(c in "/?#&=%;+<>" for c in found) else found


class Scrubber:
    """Layers in order: entities, normal form, account numbers and cards, the table, cards and long numbers inside identifiers, repeats, known phones, hosts, usernames, custom patterns, keep terms, vocabulary."""

    def __init__(self, policy: Anonymize | None = None, roster: Roster | None = None, table: tuple[Rule, ...] = TABLE, labelled: bool = True) -> None:
        self.policy, self.roster, self.table, self.labelled = policy or Anonymize(), roster or Roster(), table, labelled
        self.custom = [re.compile(p, re.IGNORECASE | re.MULTILINE) for p in self.policy.custom_patterns]
        self.hosts = frozenset(k.lower() for k in self.policy.keep_terms)
        self.seed_words = frozenset(w.lower() for w in self.policy.seed_words)
        self.card_least = min((len(x) for x in self.policy.card_bins), default=LEAST)  # fewest digits of a text with a card
        header = [r for r in self.table if r.name.startswith("td_")]
        self._first, self._header, self._rest, self._contextual = (choice(tuple(rules)) for rules in (BEFORE_CARDS, header, [r for r in self.table if r not in header], CONTEXTUAL))

    @functools.cached_property
    def _of_paths(self) -> Scrubber:
        """The scrubber for paths of links that stay."""
        return Scrubber(self.policy, self.roster, tuple(r for r in self.table if r.name in PATH_RULES and "val" not in r.pattern.groupindex), labelled=False)

    # -- layers

    def _rule(self, claims: Claims, rule: Rule) -> int:
        n = 0
        for m in rule.pattern.finditer(claims.masked):
            if not claims.free(*span(m)):
                continue
            if rule.name in NUMBERS and rule.accept is None and inside_hash(claims.text, *m.span()):
                claims.later.append((*m.span(), rule.placeholder, rule.name))
                continue
            if rule.accept and not rule.accept(m):
                continue
            if rule.name == "url":
                shown = url_placeholder(m[0], self.policy, self.roster.person_pattern)
                if shown is None:
                    self._inside_link(claims, *m.span())
                    continue
                n += claims.claim(*m.span(), shown, rule.name)
                continue
            replacement = rule.render(m) if rule.render else rule.placeholder
            if rule.name in ("handle", "handle_spaced", "kw_handle"):
                vid = self.roster.usernames.get(value(m).lower())
                replacement = f"@{vid}" if vid else rule.placeholder
            a, b = m.span() if rule.name in ("handle", "handle_spaced") else span(m)
            n += claims.claim(a, b, replacement, rule.name)
        return n

    def _inside_link(self, claims: Claims, a: int, b: int) -> None:
        """Mask user info and what the parts of a kept link spell, then claim the rest as it is.

        Path segments go through the rules that need no label, query and
        fragment values through all of them, both through the roster, in the
        form that their percent escapes stand for.
        """
        link = claims.text[a:b]
        head = _HEAD.match(link).end()
        start = link.find("://") + 3 if "://" in link[:head] else 0
        if (at := link.find("@", start, head)) > 0:
            claims.claim(a + start, a + at, "<credentials>", "credentials")
        query = min((i for i in (link.find("?", head), link.find("#", head)) if i >= 0), default=len(link))
        key = ""
        for m in _SEGMENT.finditer(link, head):
            if link[m.end() : m.end() + 1] == "=" and m.start() > query:
                key = m[0].lower()
                continue
            named, key = key if link[m.start() - 1] == "=" else "", ""
            kind = next((shown for words, shown in _TELLING if any(w in named for w in words.split())), None)
            if kind:
                claims.claim(a + m.start(), a + m.end(), kind, "url")
                continue
            asked = m.start() > query
            text = plain_text(_readable(m[0].replace("+", " ") if asked and "%2b" not in m[0].lower() and not _PLUS_PHONE.fullmatch(m[0]) else m[0]))
            shown = (self if asked else self._of_paths).scrub(_PLUS_PHONE.sub("<phone>", text))
            if shown != text:
                claims.claim(a + m.start(), a + m.end(), "%20".join(shown.split()), "url")
        host = host_of(link)
        if host and (shown := allowed(host, self.policy.allow_domains)) not in (None, host):
            where = claims.text.lower().find(host, a)
            claims.claim(where, where + len(host), shown, "url")
        for i, j in claims.gaps(a, b):
            claims.claim(i, j, claims.text[i:j], "kept")

    def _cards(self, claims: Claims) -> int:
        n = 0
        for a, b, masked in find_cards(claims.masked, self.policy.card_bins):
            if inside_hash(claims.text, a, b):
                claims.later.append((a, b, masked, "card"))
            elif claims.claim(a, b, masked, "card"):
                n += 1
                self._trailer(claims, b)
        return n

    def _pieces(self, claims: Claims) -> int:
        """Claims numbers inside hashes of which no rule has taken the whole; how many of them are cards."""
        cards = 0
        for a, b, replacement, name in claims.later:
            if claims.claim(a, b, replacement, name) and name == "card":
                cards += 1
                self._trailer(claims, b)
        return cards

    @staticmethod
    def _trailer(claims: Claims, at: int) -> None:
        if m := _TRAILER.match(claims.masked, at):
            claims.claim(*m.span("exp"), "<exp>", "expiry")
            if m["cvv"]:
                claims.claim(*m.span("cvv"), "<cvv>", "cvv")

    def _rules(self, claims: Claims, rules: tuple[Rule, ...]) -> None:
        for rule in rules:
            if rule.pattern.search(claims.masked):
                self._rule(claims, rule)

    def _table(self, claims: Claims) -> None:
        look = Look(claims.text)
        if look.numeric and self.labelled:
            self._rules(claims, self._first.of(look))
        self._rules(claims, self._header.of(look))
        if self.labelled:
            for a, b in seed_spans(claims.masked, self.seed_words):
                claims.claim(a, b, "<seed-phrase>", "seed_phrase")
        cards = self._cards(claims) if look.digits >= self.card_least else 0
        self._rules(claims, self._rest.of(look))
        cards += self._pieces(claims)
        if cards or "****" in claims.text and _OWN_MASK.search(claims.text):
            self._rules(claims, self._contextual.of(look))

    @staticmethod
    def _repeats(claims: Claims) -> None:
        known = {digits_of(claims.text[a:b]): (r, n) for a, b, r, n in claims.spans if n in IDENTITIES and len(digits_of(claims.text[a:b])) >= 8}
        if known:
            for m in _WORD.finditer(claims.masked):
                if m[0] in known:
                    claims.claim(*m.span(), *known[m[0]])

    def _hosts(self, claims: Claims) -> None:
        if not self.policy.scrub_domains or not BARE_END.search(claims.masked):
            return
        for m in BARE.finditer(claims.masked):
            host = m[0].lower()
            if is_bare_host(m) and not keeps_host(host, self.hosts):
                shown = allowed(host, self.policy.allow_domains)
                if shown != host:
                    claims.claim(*m.span(), shown or "<domain>", "domain")

    def _usernames(self, claims: Claims) -> None:
        for a, b, vid in self.roster.username_spans(claims.masked):
            claims.claim(a, b, f"@{vid}", "username")

    def _vocabulary(self, claims: Claims) -> None:
        r = self.roster
        if r.keep_pattern:
            longer = [m.span() for p in (r.org_pattern, r.person_pattern) if p for m in p.finditer(claims.masked)]
            for m in r.keep_pattern.finditer(claims.masked):
                if not any(a <= m.start() and m.end() <= b and (a, b) != m.span() for a, b in longer):
                    claims.claim(*m.span(), m[0], "kept")
        for a, b in r.id_spans(claims.masked):
            claims.claim(a, b, "<id>", "user_id")
        if r.org_pattern:
            for m in r.org_pattern.finditer(claims.masked):
                if not inside_constant(claims.text, *m.span()):
                    claims.claim(*m.span(), "<org>", "title")
        if r.person_pattern:
            for m in r.person_pattern.finditer(claims.masked):
                claims.claim(*m.span(), "<name>", "name")

    # -- entry points

    def apply_entities(self, text: str, entities: list[dict]) -> str:
        """Replace annotated spans, from the right; later ones that overlap an earlier claim are skipped."""
        claims = Claims(text)
        for e in sorted(entities, key=lambda e: (-e["offset"], -e["length"])):
            a, b = utf16_span(text, e["offset"], e["length"])
            part, kind = text[a:b], e["type"]
            if kind in ("Mention", "MentionName"):
                vid = self.roster.usernames.get(part.lstrip("@").lower())
                claims.claim(a, b, f"@{vid}" if vid else "@user", "handle")
            elif kind == "Email":
                claims.claim(a, b, "<email>", "email")
            elif kind == "Phone":
                claims.claim(a, b, "<phone>", "phone")
            elif kind == "BankCard":
                d = digits_of(part)
                claims.claim(a, b, d[:6] + "*" * (len(d) - 6) if len(d) >= 13 else "<card>", "card")
            elif kind == "Url" and (shown := url_placeholder(part, self.policy)):
                claims.claim(a, b, shown, "url")
            elif kind == "TextUrl" and e.get("url") and url_placeholder(e["url"], self.policy) is None and a < b:
                claims.claim(a, b, f"{part} ({e['url']})", "url")
        return claims.result()

    def run(self, text: str) -> Claims:
        claims = Claims(plain_text(text))
        if any(c in claims.text for c in "<@*"):
            for m in OPAQUE.finditer(claims.text):
                claims.claim(*m.span(), m[0], "kept")
        self._table(claims)
        self._repeats(claims)
        if self.roster.known_phones:
            for a, b in self.roster.known_phones.spans(claims.masked):
                claims.claim(a, b, "<phone>", "phone")
        self._hosts(claims)
        self._usernames(claims)
        for pattern in self.custom:
            for m in pattern.finditer(claims.masked):
                claims.claim(*m.span(), "<redacted>", "custom")
        self._vocabulary(claims)
        return claims

    def scrub(self, text: str | None, entities: list[dict] | None = None) -> str:
        if not text:
            return text or ""
        return self.run(self.apply_entities(text, entities) if entities else text).result()

    @staticmethod
    def hits_of(claims: Claims) -> list[tuple[str, int, int, str, str]]:
        return [(rule, a, b, claims.text[a:b], new) for a, b, new, rule in sorted(claims.spans) if rule != "kept"]

    @classmethod
    def leaks_of(cls, claims: Claims) -> list[tuple[str, str]]:
        out: dict[tuple[str, str], tuple[str, str]] = {}
        for rule, _, _, surface, new in cls.hits_of(claims):
            if surface != new:
                out.setdefault((rule, surface.lower()), (rule, surface))
        return list(out.values())

    def hits(self, text: str | None) -> list[tuple[str, int, int, str, str]]:
        """(rule, start, end, surface, replacement) in the normal form of `text`."""
        return self.hits_of(self.run(text)) if text else []

    def scan(self, text: str | None) -> list[tuple[str, str]]:
        """(kind, match) of every leak, one of each lower-case match."""
        return self.leaks_of(self.run(text)) if text else []

    def check(self, text: str | None, count: Callable[[str], int]) -> tuple[str | None, list[str], int, int]:
        """The scrubbed text, kinds and number of leaks of `text`, and what `count` says of the result's leaks, unless nothing was replaced."""
        if not text:
            return text, [], 0, 0
        claims = self.run(text)
        shown, leaks = claims.result(), self.leaks_of(claims)
        return shown, sorted({kind for kind, _ in leaks}), len(leaks), len(leaks) if shown == text else count(shown)


HITS = "struct<text:string,hits:array<struct<rule:string,start:int,end:int,surface:string,replacement:string>>>"
LEAKS = "array<struct<kind:string,match:string>>"
CHECKED = "text:string,kinds:array<string>,raw:int,left_over:int"
#: Texts whose results a worker remembers while a task runs, and their most characters: messages repeat, and what is left of most of them is the same placeholder.
MEMO, MEMO_CHARS = 8192, 256


def scrub_column(text: Column, policy: Anonymize | None = None, roster: Roster | None = None, entities: Column | None = None) -> Column:
    """Struct of the scrubbed text and its hits; patterns compile once a worker.

    With `entities` (array of type, offset, length, url, user_id; offsets in
    UTF-16 units) annotated spans go first.
    """

    def one(own: Scrubber, t: str | None, marks: list | None = None) -> tuple[str | None, list[dict]]:
        if not t:
            return t, []
        claims = own.run(own.apply_entities(t, [m if isinstance(m, dict) else m.asDict() for m in marks]) if marks is not None and len(marks) else t)
        return claims.result(), [{"rule": r, "start": a, "end": b, "surface": claims.text[a:b], "replacement": new} for a, b, new, r in sorted(claims.spans) if r != "kept"]

    @F.pandas_udf(HITS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Scrubber(policy, roster)
        for part in parts:
            yield pd.DataFrame([one(own, t) for t in part], columns=["text", "hits"])

    @F.pandas_udf(HITS)
    def run_marked(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = Scrubber(policy, roster)
        for part, marks in parts:
            yield pd.DataFrame([one(own, t, m) for t, m in zip(part, marks, strict=True)], columns=["text", "hits"])

    # not deterministic for the optimizer: a filter it infers would otherwise run the function a second time
    return run.asNondeterministic()(text) if entities is None else run_marked.asNondeterministic()(text, entities)


def scan_column(text: Column, policy: Anonymize | None = None, roster: Roster | None = None) -> Column:
    """Leaks of a text as an array."""

    @F.pandas_udf(LEAKS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Scrubber(policy, roster)
        for part in parts:
            yield pd.Series([[{"kind": k, "match": s} for k, s in own.scan(t)] for t in part])

    return run.asNondeterministic()(text)


def text_column(text: Column, policy: Anonymize | None = None, roster: Roster | None = None) -> Column:
    """The scrubbed text alone."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Scrubber(policy, roster)
        for part in parts:
            yield pd.Series([own.run(t).result() if t else t for t in part], dtype=object)

    return run.asNondeterministic()(text)


def rules_column(text: Column, policy: Anonymize | None = None, roster: Roster | None = None) -> Column:
    """The rule of every hit, as an array."""

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Scrubber(policy, roster)
        for part in parts:
            yield pd.Series([[h[0] for h in own.hits(t)] for t in part], dtype=object)

    return run.asNondeterministic()(text)


def check_column(text: Column, policy: Anonymize | None = None, roster: Roster | None = None, shown: bool = True) -> Column:
    """Struct of the scrubbed text (with `shown`), kinds of leaks in order, their number before (raw) and after (left_over) scrubbing.

    The scrubber and the scanner run the same layers, so a text is read once,
    and its result once more if it differs.
    """
    columns = CHECKED if shown else CHECKED.partition(",")[2]

    @F.pandas_udf(f"struct<{columns}>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Scrubber(policy, roster)
        count = lambda t: len(own.scan(t))
        known = functools.lru_cache(MEMO)(count)
        check = lambda t: own.check(t, lambda new: known(new) if len(new) <= MEMO_CHARS else count(new))
        seen = functools.lru_cache(MEMO)(check)
        for part in parts:
            rows = [seen(t) if t and len(t) <= MEMO_CHARS else check(t) for t in part]
            yield pd.DataFrame(rows if shown else [r[1:] for r in rows], columns=[c.partition(":")[0] for c in columns.split(",")])

    return run.asNondeterministic()(text)


def rule_counts(hits: DataFrame, column: str = "hits") -> DataFrame:
    """Number of hits of each rule."""
    return hits.select(F.explode(column).alias("h")).groupBy(F.col("h.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def rule_samples(hits: DataFrame, column: str = "hits", samples: int = 12, width: int = 80) -> DataFrame:
    """Up to `samples` distinct surfaces of each rule, cut to `width` characters, commonest first. Private."""
    from pyspark.sql import Window

    per = hits.select(F.explode(column).alias("h")).groupBy(F.col("h.rule").alias("rule"), F.substring("h.surface", 1, width).alias("surface")).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("rank", F.row_number().over(Window.partitionBy("rule").orderBy(F.col("n").desc(), "surface"))).where(F.col("rank") <= samples)
