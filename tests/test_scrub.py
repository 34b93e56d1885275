"""Scrub and scan: both directions on values assembled here."""

from __future__ import annotations

import random
import re
import time

import duckdb
import pytest

from parlance.functions import rule_cases
from parlance.functions.cards import find_cards, mask_cards
from parlance.functions.checksums import iban_ok, inn_ok, luhn_ok, ogrn_ok, snils_ok
from parlance.functions.normalize import fold, plain_text, translit, utf16_span
from parlance.functions.prefilter import Choice, Look
from parlance.functions.rules import CONTEXTUAL, TABLE
from parlance.functions.scrub import Scrubber
from parlance.functions.vocabulary import Roster, id_forms, inside_constant, title_tokens
from parlance.plans.policy import Anonymize

CARD = rule_cases.CARD
ROSTER = Roster(usernames={"mara_lind": "U12345"}, ids=frozenset({987650321, -1009876543210}), phones=frozenset({"79031112233"}), persons=("Зимин", "Larkin"), organisations=("Берёзка",), keep=("Tundra",))


def _values(k: int) -> dict[str, str]:
    """Values of a key as the cases' SQL gives them."""
    columns = ", ".join(rule_cases.COLUMNS)
    return {c: str(v) for c, v in duckdb.sql(f"SELECT {columns} FROM (SELECT {k}::BIGINT AS k)").df().iloc[0].items()}


#: Texts of all rules for one key.
CASES = [raw for rule in rule_cases.CASES for raw, _, _ in rule_cases.as_texts(rule, _values(42))]


@pytest.mark.parametrize("rule", rule_cases.CASES)
@pytest.mark.parametrize("k", [3, 811])
def test_rules(rule, k):
    """Every rule finds its values, leaves what only looks like one, and is silent on its own output."""
    s = Scrubber(Anonymize(card_bins=rule_cases.BINS))
    for raw, want, kinds in rule_cases.as_texts(rule, _values(k)):
        assert s.scrub(raw) == want
        assert ",".join(sorted({kind for kind, _ in s.scan(raw)})) == kinds
        assert s.scan(want) == [] and s.scrub(want) == want


@pytest.mark.parametrize(("word", "stays"), [("von", False), ("verbe", False), ("vi", False), ("ver enheitauein", False), ("бпла", False), ("v", True), ("v.", True), ("ver.", True), ("version", True), ("1с", True)])
def test_words_that_only_begin_like_a_version(word, stays):
    raw = f"in {word} 20.174.119.35 la eux"
    assert (Scrubber().scrub(raw) == raw) is stays


@pytest.mark.parametrize("rule", "api_key b64_secret cookie fb_token hex_secret jwt known_secret private_key txid wallet".split())
@pytest.mark.parametrize("k", [2238, 4169, 5522, 20229])
def test_hashes_that_hold_a_card_number(rule, k):
    """Hashes of these keys hold runs of digits that pass Luhn; the rule takes the whole hash all the same."""
    s = Scrubber(Anonymize(card_bins=rule_cases.BINS))
    for raw, want, kinds in rule_cases.as_texts(rule, _values(k)):
        assert s.scrub(raw) == want
        assert ",".join(sorted({kind for kind, _ in s.scan(raw)})) == kinds


@pytest.mark.parametrize("raw", [f"{CARD}exp1229", f"ab1c{CARD}", f"card{CARD}", f"{CARD}cvv123xyz456"])
def test_cards_in_identifiers_that_no_rule_takes(raw):
    assert CARD not in Scrubber().scrub(raw) and CARD[:6] + "*" * 10 in Scrubber().scrub(raw)


def test_chosen_rules_are_all_that_match():
    """No rule that would claim anything is left out by what its pattern needs."""
    choice = Choice(TABLE)
    for text in [*CASES, *map(" | ".join, zip(CASES, CASES[7:], CASES[31:])), *(t.upper() for t in CASES), "one² \U0001f600 1️⃣2"]:
        text = plain_text(text)
        chosen, lower = choice.of(Look(text)), text.lower()
        for rule in TABLE:
            if rule not in chosen and (not rule.hints or any(h in lower for h in rule.hints)):
                assert not any(rule.accept is None or rule.accept(m) for m in rule.pattern.finditer(text)), (rule.name, text)


def test_few_rules_are_tried_on_prose():
    """What a text costs doesn't follow the length of the table: 90 of the 108 rules need a digit, a sign or a word that prose lacks."""
    for text in ("The meeting is moved to the big room, so please bring your notes along with you.", "Встреча переносится в большую комнату, возьмите с собой заметки."):
        assert len(Choice(TABLE).of(Look(text))) < 18


def test_a_text_is_read_once(monkeypatch):
    """Scrubbing and scanning share one run, and a result is scanned again only if it differs."""
    s, runs, run = Scrubber(), [], Scrubber.run
    monkeypatch.setattr(Scrubber, "run", lambda self, text: runs.append(text) or run(self, text))
    count = lambda t: len(s.scan(t))
    assert s.check("plain words", count) == ("plain words", [], 0, 0) and runs == ["plain words"]
    assert s.check("пароль: Zx81kk", count) == ("пароль: <password>", ["password"], 1, 0) and runs[1:] == ["пароль: Zx81kk", "пароль: <password>"]


def test_every_rule_has_cases():
    names = {r.name for r in (*TABLE, *CONTEXTUAL)}
    assert names <= set(rule_cases.CASES)
    assert all(any(len(c) > 1 for c in cases) for cases in rule_cases.CASES.values())


def _around(values: list[str], frames: list[str]) -> list[str]:
    return [f.replace("%", v) for v in values for f in frames]


FRAMES = ["%", "см. %", "(%)", "% и дальше", "first\n%\nlast"]


@pytest.mark.parametrize("raw", _around(["@mara_lind", "mara_lind", "Зимину", "Larkin", "Zimin", "Берёзке", "берёзка", "+79031112233", "8 903 111-22-33", "987650321", "-1009876543210"], FRAMES))
def test_roster_is_removed(raw):
    s = Scrubber(Anonymize(), ROSTER)
    got = s.scrub(raw)
    assert got != raw and s.scan(raw) and s.scan(got) == [] and s.scrub(got) == got
    assert any(x in got for x in ("@U12345", "<name>", "<org>", "<phone>", "<id>"))


STAY = ["password rotation policy", "код товара {d4}", "заказ № {d9}4", "итого {d3}.50 и {d4}.25", "image:{d3}-slim", "CHANGELOG.md", "port {d4}", "CARD_LIMIT_REACHED_FOR_MERCHANT_{d4}", "до {d3} дней", "Tundra", "photo@3x.png", "пароль: неверный", "/api/v2/orders/{d4}/items/{d3}", "пер. {d3} руб", "паспорт на окно", "mkdir -p /srv/{w8}", "exit code {d3}", "<email> pin <pin>", "411111**********"]


@pytest.mark.parametrize("raw", _around(STAY, ["%", "см. %", "first\n%\nlast"]))
def test_kept(raw):
    raw = re.sub(r"\{(\w+)\}", lambda m: _values(58)[m[1]], raw)
    s = Scrubber(Anonymize(), ROSTER)
    assert s.scrub(raw) == raw
    assert s.scan(raw) == []


LINKS = [
    ("https://example.com/u/mara_lind", "https://example.com/u/@U12345"), ("https://example.com/reset/79031112233/x.y@example.com", "https://example.com/reset/<phone>/<email>"),
    ("https://example.com/find?q=%D0%97%D0%B8%D0%BC%D0%B8%D0%BD&page=2", "https://example.com/find?q=<name>&page=2"), ("https://example.com/a?password=abc1#Larkin", "https://example.com/a?password=<password>#<name>"),
    ("https://example.com/docs/%D0%BE%D0%BF%D0%BB%D0%B0%D1%82%D0%B0/42", None), ("https://example.com/password-reset/pull/3184713454?utm_source=mail", None), ("https://example.com/?next=https://b.example/p/mara_lind", "https://example.com/?next=https://b.example/p/@U12345"),
]


@pytest.mark.parametrize(("raw", "want"), LINKS)
def test_inside_kept_links(raw, want):
    s = Scrubber(Anonymize(url_mode="keep"), ROSTER)
    got = s.scrub(f"see {raw} now")
    assert got == f"see {want or raw} now"
    assert bool(s.scan(raw)) == bool(want) and s.scan(got) == [] and s.scrub(got) == got


def test_seed_phrases():
    words = tuple("abandon zebra quick tower lemon ocean piano river stone tiger vivid walnut".split())
    listed = Scrubber(Anonymize(seed_words=words))
    assert listed.scrub("so here it is then " + " ".join(words) + " goes on and on") == "so here it is then <seed-phrase> goes on and on"
    assert listed.scrub(" ".join(words[:11])) == " ".join(words[:11])
    shaped = Scrubber()
    for raw in (" ".join(["abandon"] * 11 + ["about"]), "\n".join(f"{i}. {w}" for i, w in enumerate(words, 1)), "backup: " + " ".join(words)):
        assert "<seed-phrase>" in shaped.scrub(raw) and "tiger" not in shaped.scrub(raw) and shaped.scan(raw)
    for raw in ("people who read these lines will find that they make ordinary sense here", " ".join(words[:11]), "then " + " ".join(words) + " went home."):
        assert shaped.scrub(raw) == raw


def test_cost_does_not_grow_with_the_roster():
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("ка ро ми ле ту ва ни со де ба пи жу хо гле стра".split()) for _ in range(rng.choice((3, 4)))).capitalize() for _ in range(30_000)})
    text = " ".join(names[:: max(1, len(names) // 400)])[:4096]
    lines = "\n".join(f"line {i} code {79000000000 + 23757 * i} and {i * 77777777}" for i in range(1000))
    cost = {}
    for key, roster, t in [(n, Roster(persons=tuple(names[-n:])), text) for n in (30, 20_000)] + [(-n, Roster(phones=frozenset(str(79000000000 + 7919 * i) for i in range(n))), lines) for n in (0, 5000)]:
        s = Scrubber(Anonymize(), roster)
        s.scrub(t)
        cost[key] = min(_timed(s, t) for _ in range(3))
    assert cost[20_000] < 4 * max(cost[30], 0.01) and cost[-5000] < 4 * max(cost[0], 0.05)


def _timed(s: Scrubber, text: str) -> float:
    began = time.perf_counter()
    s.scrub(text)
    return time.perf_counter() - began


def test_policy():
    assert Scrubber(Anonymize(url_mode="domain")).scrub("see https://a.example.com/x") == "see <url:a.example.com>"
    assert Scrubber(Anonymize(url_mode="keep")).scrub("https://a.example.com/x?password=abc1") == "https://a.example.com/x?password=<password>"
    assert Scrubber(Anonymize(allow_domains=("docs.example.com",))).scrub("https://docs.example.com/a") == "https://docs.example.com/a"
    assert Scrubber(Anonymize(allow_domains=("*.example.com",))).scrub("https://t1.example.com/a") == "https://<sub>.example.com/a"
    assert Scrubber(Anonymize(custom_patterns=(r"NW-\d+",))).scrub("ticket NW-104") == "ticket <redacted>"
    assert Scrubber(Anonymize(scrub_domains=False)).scrub("acme.store") == "acme.store"
    assert Scrubber(Anonymize(card_bins=("510000",))).scrub("5100 0012 3456 7890") == "510000**********"


def test_entities():
    s = Scrubber(Anonymize(), ROSTER)
    assert s.scrub("😀 hi @mara_lind", [{"type": "Mention", "offset": 6, "length": 10}]) == "😀 hi @U12345"
    assert s.scrub("call me", [{"type": "Phone", "offset": 0, "length": 4}]) == "<phone> me"


def test_hits_are_spans():
    text = "a x.y@example.com b"
    assert [(r, text[a:b], new) for r, a, b, _, new in Scrubber().hits(text)] == [("email", "x.y@example.com", "<email>")]


def test_empty():
    s = Scrubber()
    assert s.scrub("") == "" and s.scrub(None) == "" and s.scan(None) == [] and s.scrub("   ") == "   "


def test_checksums():
    spoilt = rule_cases._spoilt
    for number, ok in ((CARD, luhn_ok), (rule_cases.INN10, inn_ok), (rule_cases.INN12, inn_ok), (rule_cases.OGRN, ogrn_ok), (re.sub(r"\D", "", rule_cases.SNILS), snils_ok), (rule_cases.IBAN, iban_ok)):
        assert ok(number) and not ok(spoilt(number))


def test_cards():
    masked = CARD[:6] + "**********"
    assert mask_cards(" ".join(CARD[i : i + 4] for i in (0, 4, 8, 12))) == masked
    assert find_cards(masked) == [] and find_cards(rule_cases._spoilt(CARD)) == []
    assert find_cards("8 903 111 22 33\n8 903 111 22 34") == []
    known = lambda t: [m for _, _, m in find_cards(t, ("510000",))]
    assert known("5100 0012 34567890") == known("51000012 34567890") == ["510000" + "*" * 10] and known("5100 0012 3456 78901") == ["510000" + "*" * 11]
    assert known("510000 510001 510002") == [] and find_cards("5100 0012 34567890") == []


def test_normal_form():
    assert plain_text("a­b​c") == "abc"
    assert plain_text("١٢٣") == "123"
    assert plain_text("е\u0301") == "е" and plain_text("и\u0301\u0306") == "й" and plain_text("e\u0301") == "é"
    assert plain_text("\u200cаб\u200dв") == "абв" and plain_text("\U0001f468\u200d\U0001f4bb") == "\U0001f468\u200d\U0001f4bb"
    keycap = lambda d: f"{d}\ufe0f\u20e3"
    assert plain_text(f"x {keycap(8)} {keycap(9)}{keycap(1)}-{keycap(2)}({keycap(3)}") == "x 8 91-2(3" and plain_text(keycap(1) + " a") == keycap(1) + " a"
    assert fold(" Ёлка  X ") == "елка x"
    assert translit("Щука") == "Shchuka"
    assert utf16_span("😀ab", 2, 1) == (1, 2) and utf16_span("😀ab", 1, 1) == (0, 1)
    assert plain_text(plain_text("ёйｅ")) == plain_text("ёйｅ")


def test_vocabulary():
    assert title_tokens("Берёзка — вебхуки / API Q7") == ["березка", "q7"]
    assert id_forms(-1009876543210) == {1009876543210, 9876543210}
    assert inside_constant("x ERR_BEREZKA_TIMEOUT y", 6, 13)
    s = Scrubber(Anonymize(), ROSTER)
    assert s.scrub("ERR_БЕРЁЗКА_TIMEOUT") == "ERR_БЕРЁЗКА_TIMEOUT"
    assert s.scrub("Zimin1990 и зиминым") == "<name>1990 и <name>"


HOSTILE = ["1 " * 2048, "password " + " " * 4000, "@ " * 2048, "a:b" * 1365, "x" * 4096, "9" * 4096, "a.b/" * 1024, "код\n" * 1024, "Ab " * 1365, "<Password>" * 400]


@pytest.mark.parametrize("text", HOSTILE, ids=range(len(HOSTILE)))
def test_linear(text):
    s = Scrubber()
    cost = []
    for t in (text, text * 4):
        began = time.perf_counter()
        s.scrub(t)
        cost.append(time.perf_counter() - began)
    assert cost[0] < 2.0 and cost[1] < 8 * max(cost[0], 0.05)
