"""The rule table: one registry for the scrubber and the leak scanner.

A rule finds values of one kind. Shape rules match the value itself; keyword
rules match a label, a short gap and the value, and claim the value only. An
accept callback sees the match and decides; hints are substrings of which one
must occur in the lower-cased text for the rule to be tried at all.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Callable
from dataclasses import dataclass

from .checksums import IBAN_LENGTHS, iban_ok, inn_ok, kz_id_ok, kz_person, ogrn_ok, snils_ok, ua_rnokpp_ok

Accept = Callable[[re.Match], bool]
I = re.IGNORECASE  # noqa: E741
M = re.MULTILINE


@dataclass(frozen=True)
class Rule:
    name: str
    placeholder: str
    pattern: re.Pattern
    accept: Accept | None = None
    hints: tuple[str, ...] = ()
    digits: bool = False
    render: Callable[[re.Match], str] | None = None


#: Between a label and its value: punctuation, a filler word, one line break.
GAP = r"(?:[ \t]{0,3}(?:[:=\-–—#№\"'(\[«>]|(?:is|are|это|был[аио]?|will be|нов(?:ый|ая|ые)|стар(?:ый|ая)|временн(?:ый|ая)|new|old|temporary)(?!\w)|=>|->)){0,3}(?:[ \t]{0,3}\n)?[ \t]{0,3}[\"'«(\[]{0,2}"
_L = r"(?<![^\W_])(?<!</)"


def shape(name: str, placeholder: str, pattern: str, accept: Accept | None = None, hints: tuple[str, ...] = (), flags: int = 0, digits: bool = False, render: Callable[[re.Match], str] | None = None) -> Rule:
    return Rule(name, placeholder, re.compile(pattern, flags), accept, hints, digits, render)


def keyword(name: str, placeholder: str, labels: str, value: str, accept: Accept | None = None, hints: tuple[str, ...] = (), flags: int = I, digits: bool = False, render: Callable[[re.Match], str] | None = None) -> Rule:
    return Rule(name, placeholder, re.compile(rf"{_L}(?P<kw>{labels})(?![^\W\d]){GAP}(?P<val>{value})", flags), accept, hints, digits, render)


def span(m: re.Match) -> tuple[int, int]:
    """What a match claims: its value, where it has one."""
    return m.span("val") if "val" in m.re.groupindex else m.span()


def value(m: re.Match) -> str:
    return m["val"] if "val" in m.re.groupindex else m[0]


def _before(m: re.Match, n: int) -> str:
    a = span(m)[0]
    return m.string[max(0, a - n) : a]


def _after(m: re.Match, n: int) -> str:
    b = span(m)[1]
    return m.string[b : b + n]


def digits_of(text: str) -> str:
    return re.sub(r"\D", "", text)


def digit_count(least: int, most: int) -> Accept:
    return lambda m: least <= len(digits_of(value(m))) <= most


def has_digit(m: re.Match) -> bool:
    return any(c.isdigit() for c in value(m))


def has_both(m: re.Match) -> bool:
    v = value(m)
    return any(c.isdigit() for c in v) and any(c.isalpha() for c in v)


# ---- context ---------------------------------------------------------------

_ERROR = re.compile(r"(?:error|mismatch|decline[d]?|invalid|ошибк\w*|отказ\w*|отклон\w*|неверн\w*|сбой)\W{0,6}\w{0,12}\W{0,3}$", I)
_REFERENCE = re.compile(
    r"(?:(?<!\w)(?:заказ(?!чик)\w{0,3}|тикет\w{0,3}|транзакци\w{1,2}|инвойс\w{0,3}|обращени\w{1,2}|заявк\w{1,2}|orders?|tickets?|transactions?|txn|invoices?)"
    r"|номер платежа|id операции|id оплаты|payment[ _]id|order_id)(?:\s{0,2}(?:[:#№=\-.,;/]|id|номер|no\.?|number|\d{3,20}|\n)){0,30}\s{0,2}$", I)  # fmt: skip
_OWNER = re.compile(r"инн|иин|бин|рнокпп|снилс|огрн|tax|реквизит|контрагент|passport|паспорт", I)
_CODE_KIND = re.compile(r"(?:ответ\w*|ошибк\w*|категори\w*|терминал\w*|магазин\w*|валют\w*|товар\w*|тсп|mcc|мсс|promo|промо\w*|country|zip|area|response|error|status|decline|отказ\w*|отклон\w*|с кодом|по коду)\W{0,3}(?:код\w{0,2}|code)?\W{0,4}$", I)
_MEANS = re.compile(r"\s*(?:означа|=|это|—|-|:|\||means|и\s+\d{3,5})", I)


#: Characters from which on a run of letters and digits is an identifier of its own.
LONG_IDENTIFIER = 20


def inside_identifier(m: re.Match) -> bool:
    """Whether the digits are a piece of a longer run of Latin letters and digits, such as a hash."""
    a, b = span(m)
    text = m.string
    before = re.search(r"[A-Za-z0-9]*$", text[max(0, a - 64) : a])[0]
    after = re.match(r"[A-Za-z0-9]*", text[b : b + 64])[0]
    return bool(before or after) and len(before) + b - a + len(after) >= LONG_IDENTIFIER


def not_reference(m: re.Match) -> bool:
    """The number isn't an order, ticket or transaction number, unless an owner word stands near, and no piece of an identifier."""
    if inside_identifier(m):
        return False
    tail = _before(m, 160)
    hit = _REFERENCE.search(tail)
    return not hit or bool(_OWNER.search(tail[max(0, hit.start() - 24) : hit.start()]))


def companion_ok(m: re.Match) -> bool:
    return not _ERROR.search(m.string[max(0, m.start("val") - 30) : m.start("val")].split(m["kw"])[-1])


def otp_ok(m: re.Match) -> bool:
    label = m["kw"].lower()
    if re.search(r"подтвержд|смс|sms|3ds|otp|verif|confirm|одноразов", label):
        return True
    if _CODE_KIND.search(_before(m, 40)[: -len(m[0]) or None]) or _CODE_KIND.search(m.string[max(0, m.start() - 24) : m.end("kw")].replace(m["kw"], "", 1)):
        return False
    if re.search(r"(?:ответ|ошибк|категор|терминал|магазин|валют|товар|тсп)", m.string[m.end("kw") : m.start("val")], I):
        return False
    v = value(m)
    if len(v) <= 5 and _MEANS.match(_after(m, 16)):
        return False
    return not (m.string[: m.start()].rstrip().endswith('"') or re.search(r"\"\s*:\s*$", m.string[m.end("kw") : m.start("val")]) is not None and len(v) <= 5)


_OUTCOME = re.compile(
    r"(?:не\b|неверн\w*|неправильн\w*|сброшен\w*|ист[её]к\w*|устарел\w*|подход\w*|минимум|максимум|только|прид[её]т|отправ\w*|выда\w*|можно|нужн\w*|надо|забыл\w*|ошибк\w*|от|для|на|из|в|с|и|или|у|по|при|через|был|"
    r"expired|null|none|true|false|required|invalid|wrong|incorrect|reset|changed|mismatch|error|will|must|should|from|for|and|or|the|is|not|at least|minimum|only)(?=\s|$)", I)  # fmt: skip
_TEMPLATE = re.compile(r"^(?:[$%]?\{.*\}|\$\(.*\)|<.*>|\[.*\]|\*+|x{3,}|\.{3,}|см\.?|храним|выда[её]тся|see|stored)", I)


def password_ok(m: re.Match) -> bool:
    """The value spells a password rather than a policy, an outcome or an instruction."""
    v = value(m)
    if _TEMPLATE.match(v) or len(v) < 3:
        return False
    if re.fullmatch(r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+", v) or re.match(r"\d{1,3}(?:[-–]\d{1,3})?$", v) and re.match(r"\s*(?:симв|знак|char|digit|цифр|мин|min)", _after(m, 12), I):
        return False
    if " " in v and _OUTCOME.match(v):
        return False
    strong = any(c.isdigit() for c in v) or any(not c.isalnum() and c not in " .,;:!?-" for c in v) or not v.islower() and not v.istitle() and not v.isupper()
    if strong:
        return True
    if _OUTCOME.match(v) or re.match(r"[ \t]+[\w<\ue000]", _after(m, 3)):
        return False
    return len(v) >= 4 and bool(re.search(r"[:=\"'\n]", m.string[m.end("kw") : m.start("val")]))


def secret_ok(m: re.Match) -> bool:
    v = value(m)
    return not _TEMPLATE.match(v) and len(v) >= 6 and (any(c.isdigit() for c in v) or not v.islower() and not v.isupper()) and not v.startswith("/")


def element_ok(m: re.Match) -> bool:
    v = value(m).strip()
    return bool(v) and not _TEMPLATE.match(v) and v.lower() not in ("true", "false", "null", "bearer")


def api_key_ok(m: re.Match) -> bool:
    v = value(m)
    return has_both(m) and not v.startswith("/") and not reads_as_identifier(v)


def reads_as_identifier(v: str) -> bool:
    """Words, short numbers, versions and dates joined by punctuation: a constant, path or slug and no secret."""
    parts = [p for p in re.split(r"[_\-./+=]", v) if p]
    if len(parts) < 3:
        return False
    for p in parts:
        if p.isalpha() and (p.islower() or p.isupper() or p.istitle()) and len(p) <= 20:
            continue
        if p.isdigit() and len(p) <= (9 if "/" in v else 4) or re.fullmatch(r"v?\d{1,4}[a-z]?", p, I):
            continue
        return False
    return not any(p.lower() in ("secret", "password", "passwd", "token") for p in parts)


def random_secret(m: re.Match) -> bool:
    v = value(m)
    if reads_as_identifier(v):
        return False
    return any(c.isdigit() for c in v) and any(c.islower() for c in v) and any(c.isupper() for c in v) or bool(re.search(r"[0-9].*[a-z].*[0-9]|[a-z].*[0-9].*[a-z]", v, I)) and sum(c.isdigit() for c in v) >= 4


def default_account_ok(m: re.Match) -> bool:
    v = value(m).split(":", 1)[1]
    return any(c.isalpha() for c in v) and any(not c.isalpha() for c in v) and not re.fullmatch(r"v?\d+(?:[.-]\w+)*", v)


def user_pass_ok(m: re.Match) -> bool:
    left, _, right = value(m).partition(":")
    if left.isdigit() and right.isdigit() or left.lower() in ("role", "scope", "ios", "android", "payments", "http", "https"):
        return False
    return any(not c.isalpha() for c in right) and not re.fullmatch(r"[\d.]+", right)


def basic_ok(m: re.Match) -> bool:
    v = value(m)
    try:
        text = base64.b64decode(v + "=" * (-len(v) % 4), validate=True)
    except (binascii.Error, ValueError):
        return False
    return b":" in text and all(32 <= c < 127 for c in text)


def base32_ok(m: re.Match) -> bool:
    v = re.sub(r"[\s-]", "", value(m))
    return len(v) >= 16 and (any(c.isdigit() for c in v) or v.isupper() or " " in value(m))


# ---- numbers ---------------------------------------------------------------


def kz_ok(m: re.Match) -> bool:
    return kz_id_ok(m[0]) and not_reference(m)


def kz_render(m: re.Match) -> str:
    return "<iin>" if kz_person(m[0]) else "<company-id>"


def checked(test: Callable[[str], bool]) -> Accept:
    return lambda m: test(digits_of(value(m))) and not_reference(m)


def iban_accept(m: re.Match) -> bool:
    return iban_ok(m[0])


_PHONE_WORD = re.compile(r"(?:тел\w{0,6}|моб\w{0,6}|звон\w{0,6}|номер телефона|phone|tel|mobile|call|whats?app|viber|вайбер|ватсап)\W{0,4}$", I)
_AMOUNT = re.compile(r"^\d{1,3}(?:[ ,.]\d{3})+(?:[.,]\d{1,2})?$|^\d+[.,]\d{2}(?:\s|$)")
_DATE = re.compile(r"\d{1,2}[./-]\d{1,2}[./-]\d{2,4}|\d{4}-\d{2}-\d{2}|\d{2}:\d{2}")


def phone_ok(m: re.Match) -> bool:
    """A run of 10 to 15 digits that isn't amounts, dates, a list of codes or a reference."""
    v = value(m)
    d = digits_of(v)
    labelled = bool(_PHONE_WORD.search(_before(m, 24)))
    if not 10 <= len(d) <= 15 or not not_reference(m):
        return False
    if labelled:
        return True
    if _DATE.search(v) or _AMOUNT.match(v):
        return False
    if v.startswith("+"):
        return True
    groups = re.findall(r"\d+", v)
    if len(groups) == 1:
        return False
    if len(set(map(len, groups))) == 1 and len(groups) > 2 and len(groups[0]) >= 3 or list(map(len, groups)) == [3, 3, 3, 2]:
        return False
    return "(" in v or (len(groups) >= 3 and len(groups[-1]) <= 4 and any(c in v for c in "-()"))


def ru_phone_ok(m: re.Match) -> bool:
    return not_reference(m) and not re.search(r"[.,]\d{2}$", value(m))


def keyword_phone_ok(m: re.Match) -> bool:
    return 7 <= len(digits_of(value(m))) <= 15


_VERSION = re.compile(r"(?<!\w)(?:верси\w*|version|релиз\w*|release|сборк\w*|build|обнов\w*|update\w*|upgrade\w*|пункт\w*|п\.|clause|section|sdk|app\w*version|1с(?!\w)|бп(?!\w))[^\n]{0,14}$|(?<!\w)(?:ver|v)\.?[ \t:=#№(\"']{0,3}$", I)
_NETWORK_WORD = re.compile(r"(?<!\w)(?:ip|host|сервер\w*|server|адрес\w*|addr\w*|ping|dns|nginx|proxy)[^\n]{0,14}$", I)


def ipv4_ok(m: re.Match) -> bool:
    quad = [int(x) for x in m["quad"].split(".")]
    if max(quad) > 255 or quad[0] == 127 or quad == [0, 0, 0, 0]:
        return False
    tail = _before(m, 48)
    return bool(m["port"] or _NETWORK_WORD.search(tail)) or not _VERSION.search(tail) or max(quad) > 199


def ipv6_ok(m: re.Match) -> bool:
    v = m[0]
    if v.strip(":") in ("", "1") or "::" not in v and v.count(":") != 7 or v.count("::") > 1 or ":::" in v:
        return False
    groups = [g for g in v.split(":") if g]
    if re.fullmatch(r"[\d:]+", v) and all(len(g) <= 2 for g in groups):
        return False
    return len(groups) >= 2 and all(len(g) <= 4 for g in groups)


# ---- people, places, handles -----------------------------------------------

_CARD_WORD = re.compile(r"\b(?:visa|mastercard|master|maestro|mir|мир|gold|platinum|classic|standard|infinite|world|black|signature|premium|премиум|голд|платинум|классик|виза|amex|unionpay|bank|банк|card|name|mismatch)\b", I)


def cardholder_ok(m: re.Match) -> bool:
    return len(_CARD_WORD.sub("", value(m)).split()) >= 2


_STREET = re.compile(r"(?:ул|улиц|пр|просп|пер|переул|бул|шоссе|наб|мкр|дом|д|кв|street|st|ave|avenue|road|rd|lane|blvd|drive|apt|flat)\b", I)
_PROSE = re.compile(r"\b(?:не|можно|нельзя|нужн\w*|должн\w*|страниц\w*|дн\w*|символ\w*|час\w*|must|match|step|can|cannot|should|is|the|days?)\b", I)


def address_ok(m: re.Match) -> bool:
    v = value(m)
    return has_digit(m) and any(c.isalpha() for c in v) and not _PROSE.search(v) and not v.rstrip().endswith("?")


def street_address_ok(m: re.Match) -> bool:
    return address_ok(m) and bool(_STREET.search(value(m)) or re.search(r",\s*\d", value(m)))


_STAMP = re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{2,4},? \d{1,2}:\d{2}")
_LEVEL = re.compile(r"(?:info|warn|warning|error|debug|trace|fatal|critical)$", I)


def header_ok(m: re.Match) -> bool:
    return bool(_STAMP.search(m["stamp"])) and not _LEVEL.match(value(m).strip())


_NPM = re.compile(r"(?:npm|yarn|pnpm|npx|bun|node_modules)\b[^\n]{0,80}$", I)


def handle_ok(m: re.Match) -> bool:
    if re.match(r"\d+(?:x|\.\d)", m["val"]) or re.match(r"/[\w-]", _after(m, 2)) and _NPM.search(_before(m, 100)):
        return False
    return not _after(m, 1) == "/" or not _NPM.search(_before(m, 100))


def spaced_handle_ok(m: re.Match) -> bool:
    return "_" in m["val"] or any(c.isdigit() for c in m["val"])


def bare_handle_ok(m: re.Match) -> bool:
    v = value(m)
    return ("_" in v or any(c.isdigit() for c in v)) and not reads_as_identifier(v) and not re.fullmatch(r"[A-Z]+(?:_[A-Z0-9]+)+", v)


def pem_ok(m: re.Match) -> bool:
    return len(m["val"].strip()) > 0 and FILL not in m["val"]


FILL = "\ue000"


def exchange_ok(m: re.Match) -> bool:
    return bool(re.search(r"uid|id", m["kw"], I)) or len(digits_of(value(m))) >= 7


# ---- seed phrases ----------------------------------------------------------

_SEED_LABEL = r"(?:seed|mnemonic|recovery|secret)(?:[ -](?:phrase|words))|(?:сид|мнемоническ\w*|секретн\w*)[ -]?фраз\w{1,2}|seed|сид"
_SEED_PART = r"(?:\d{1,2}[.)][ \t]?)?[a-z]{3,8}"
_SEED_GAP = r"(?:[ \t]{1,3}|[ \t]?[,;][ \t]?|[ \t]?\n[ \t]?){1,2}"
SEED_RUN = rf"{_SEED_PART}(?:{_SEED_GAP}{_SEED_PART}){{11,23}}(?![a-z])"
#: A run of words without a label that may be a phrase.
SEED_WORDS = re.compile(rf"(?<![\w'-]){_SEED_PART}(?:{_SEED_GAP}{_SEED_PART}){{11,}}(?![\w'-])", I)
_SEED_WORD = re.compile(r"[a-z]{3,8}", I)
#: What every phrase without a label begins with: the start of the text, or a sign that may stand before one.
_SEED_FIRST = re.compile(rf"[ \t]*{_SEED_PART}(?:{_SEED_GAP}{_SEED_PART}){{11}}", I)
_SEED_HEAD = re.compile(rf"[\n:\"'«`(](?i:[ \t]*{_SEED_PART}(?:{_SEED_GAP}{_SEED_PART}){{11}})")
#: Lengths of phrases; words of ordinary sentences, none of which the wallets' list holds.
SEED_LENGTHS = frozenset({12, 15, 18, 21, 24})
_SENTENCE = frozenset("the and for not but with from have has had was were are been his her its our their your they she him who whom which why how does did than into onto such these those could should being".split())


def seed_spans(text: str, words: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """Seed phrases without a label.

    With the wallets' word list, every run of twelve of its words or more;
    without it, a run that fills a line or stands behind a colon or in quotes,
    of a phrase's length, and holds no word of ordinary sentences.
    """
    found = []
    if not words and not _SEED_HEAD.search(text) and not _SEED_FIRST.match(text):
        return found
    for run in SEED_WORDS.finditer(text):
        parts = [(m.start(), m.end(), m[0].lower()) for m in _SEED_WORD.finditer(text, *run.span())]
        if words:
            at = 0
            while at < len(parts):
                end = at
                while end < len(parts) and parts[end][2] in words:
                    end += 1
                if end - at >= 12:
                    found.append((parts[at][0], parts[end - 1][1]))
                at = end + 1
        elif len(parts) in SEED_LENGTHS and not any(w in _SENTENCE for _, _, w in parts) and len({text[a:b].islower() for a, b, _ in parts[1:]}) == 1:
            before, after = text[: run.start()].rstrip(" \t")[-1:], text[run.end() :].lstrip(" \t")[:1]
            if before in ("", "\n", ":", '"', "'", "«", "`", "(") and after in ("", "\n", '"', "'", "»", "`", ")"):
                found.append(run.span())
    return found


# ---- fragments -------------------------------------------------------------

_PASSWORD = r"(?:пароль|парол[яюе]м?|пороль|пасворд|password|passwd|passwort|pwd|pass|pw|кодовое слово)"
_PASS_TAIL = r"(?:[ \t]+(?:от|для|на|к|for|to|of)(?:[ \t]+\w{2,20}){1,4})?(?:[ \t]+(?:новый|старый|временный|new|old|temporary|был|сменил на|у него|такой))?"
_MONTH = r"(?:янв|фев|мар|апр|ма[йя]|июн|июл|авг|сен|окт|ноя|дек|jan|feb|apr|may|jun|jul|aug|sep|oct|nov|dec)[а-яa-z]{0,8}"
_DATE_VALUE = rf"\d{{1,2}}[./-]\d{{1,2}}[./-](?:\d{{4}}|\d{{2}})|\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}} {_MONTH} \d{{4}}"
_CAP = r"[А-ЯЁA-Z][а-яёa-z]{1,20}(?:-[А-ЯЁA-Z][а-яёa-z]{1,20})?"
_PATR = r"[А-ЯЁ][а-яё]{1,20}(?:ович|евич|ич|овна|евна|ична|инична)(?:[аеуы]|ем|ой)?"
_SUR_END = r"(?:ов|ев|ёв|ин|ын|ова|ева|ёва|ина|ына|ский|ская|цкий|цкая|енко|чук|ук|юк|дзе|швили|ян)(?:у|ым|ом|а|е|ой|ого|ому)?"
_PAIR_CH = r"[^\s:;,<>|\"'()\[\]\ue000]"
_TAG = r"<(?P<tag>(?:[A-Za-z][\w.-]{{0,40}}:)?[\w.-]{{0,40}}?(?:{words}))(?:\s[^<>]{{0,200}})?>(?P<val>[^<>\ue000]{{1,400}})</(?P=tag)\s*>"


def _element(name: str, placeholder: str, words: str) -> Rule:
    return shape(name, placeholder, _TAG.format(words=words), element_ok, ("</",), I)


#: Prefixes and shapes of well-known secrets.
KNOWN_SECRETS = (
    r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"(?:sk|rk|pk)_(?:live|test)_[0-9A-Za-z]{16,}", r"whsec_[0-9A-Za-z]{16,}", r"AIza[0-9A-Za-z_-]{35}", r"SK[0-9a-f]{32}",
    r"shp(?:at|ss|ca|pa)_[0-9a-fA-F]{32}", r"glpat-[0-9A-Za-z_-]{20,}", r"gh[pousr]_[0-9A-Za-z]{30,}", r"hf_[0-9A-Za-z]{30,}", r"xox[abprs]-[0-9A-Za-z-]{10,}", r"SG\.[0-9A-Za-z_-]{16,}\.[0-9A-Za-z_-]{16,}",
    r"sk-[0-9A-Za-z_-]{32,}", r"[MN][0-9A-Za-z_-]{23}\.[0-9A-Za-z_-]{6}\.[0-9A-Za-z_-]{27,}",
)

HEADER_RULES = [
    shape("td_header", "<name>", r"^(?P<lead>[ \t>]*)(?P<val>[^\n\[\]<>{}\ue000]{2,60}), \[(?P<stamp>[\d./: ,-]{8,30})\]", header_ok, (", [",), M),
    shape("td_companion", "<name>", r"^[ \t>]*\[(?:Forwarded from|In reply to|Переслано от|В ответ на) (?P<val>[^\]\n\ue000]{1,80})\]", None, ("forwarded", "reply", "переслано", "в ответ"), M | I),
]
PROXY_RULES = [
    shape("proxy", "<proxy>", rf"(?:https?|socks[45]h?)://{_PAIR_CH}{{1,64}}:{_PAIR_CH}{{1,64}}@[\w.-]+(?::\d{{2,5}})?", None, ("://",), I),
    shape("proxy", "<proxy>", rf"(?<![\d.])\d{{1,3}}(?:\.\d{{1,3}}){{3}}:\d{{2,5}}:{_PAIR_CH}{{1,64}}:{_PAIR_CH}{{1,64}}", digits=True),
    shape("proxy", "<proxy>", rf"(?<![\w@]){_PAIR_CH}{{1,64}}:(?:(?!@){_PAIR_CH}){{1,64}}@\d{{1,3}}(?:\.\d{{1,3}}){{3}}:\d{{2,5}}", None, ("@",)),
    shape("proxy", "<proxy>", rf"(?<![\w.])(?:[a-z0-9-]{{1,63}}\.){{1,4}}[a-z]{{2,12}}:\d{{2,5}}:{_PAIR_CH}{{1,64}}:{_PAIR_CH}{{1,64}}", digits=True, flags=I),
]
LINK_RULES = [
    shape("tg_link", "<tg-link>", r"(?:https?://)?(?:www\.)?(?<![\w.])(?:t\.me|telegram\.(?:me|dog|org))/[^\s<>\"'\ue000]+|tg://[^\s<>\"'\ue000]+", None, ("t.me", "telegram.", "tg://"), I),
    shape("url", "<url>", r"(?<![\w])(?:[a-z][a-z0-9+.-]{1,15}://|www\.)[^\s<>\"'\ue000]*[^\s<>\"'\ue000.,;:!?)\]}]", None, ("://", "www."), I),
    shape("url", "<url>", r"(?<![\w@./-])(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.){1,4}(?:com|net|org|info|biz|ru|kz|ua|by|io|me|co|uk|de|fr|es|app|dev|online|site|store|shop|pro|tv|cc|su|рф)(?::\d{2,5})?/[^\s<>\"'\ue000]*[^\s<>\"'\ue000.,;:!?)\]}]", None, ("/",), I),
]
TOKEN_RULES = [
    shape("bot_token", "<token>", r"(?<!\d)\d{8,10}:[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", digits=True),
    shape("jwt", "<token>", r"(?<![\w-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*)?", None, ("eyj",)),
]
ELEMENT_RULES = [
    _element("password", "<password>", r"password|passwd|pwd|пароль"),
    _element("cvv", "<cvv>", r"cvv2?|cvc2?"),
    _element("pin", "<pin>", r"pin|pin[_-]?code"),
    _element("otp", "<otp>", r"otp|sms[_-]?code"),
    _element("api_key", "<token>", r"token|secret|(?:api|access|private|auth)[_-]?key"),
    _element("kw_handle", "@user", r"login|user[_-]?name"),
]
FINANCE_RULES = [
    shape("private_key", "<private-key>", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?P<val>[^-]{1,20000}+)-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----", pem_ok, ("private key",)),
    shape("credentials", "<credentials>", r"(?<![\w.+-])[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,3}[:;|][^\s:;|<>\ue000]{4,64}(?:[:;|][^\s:;|<>\ue000]{1,64}){0,6}", None, ("@",)),
    shape("credentials", "<credentials>", r"(?<![\w:/.@])[\w.+-]{3,64}:[^\s:/<>|,;\ue000]{4,64}(?::[^\s:<>|,;\ue000]{2,64}){1,4}(?![\w:])", lambda m: has_both(m) and not re.fullmatch(r"[0-9A-Fa-f:]+", m[0]) and not _DATE.search(m[0]), (":",)),
    keyword("credentials", "<credentials>", r"-u|--user|логин\w{0,2}|login|акк(?:аунт)?\w{0,2}|учетк\w|учётк\w|доступ\w{0,2}|account|creds|credentials", r"[^\s:/<>\"'\ue000]{2,64}:[^\s:/<>\"'\ue000]{4,64}", user_pass_ok, (":",)),
    shape("credentials", "<credentials>", r"(?<![\w/:.-])(?:root|admin|administrator|postgres|mysql|ubuntu|test|user|guest):[^\s:/@<>\"'\ue000]{4,64}(?![\w@/])", default_account_ok, (":",), I),
    shape("cookie", "<cookie>", r"(?<![\w-])(?:PHPSESSID|JSESSIONID|session(?:_?id)?|sessid|sid|connect\.sid|laravel_session|csrftoken|xsrf-token|_ga|auth_token|remember_token)=(?P<val>[^\s;,\"'<>\ue000]{6,})", None, ("sess", "sid=", "csrf", "xsrf", "_ga", "token="), I),
    shape("fb_token", "<token>", r"(?<![A-Za-z0-9])EAA[A-Za-z0-9]{24,}", None, ("eaa",)),
    shape("known_secret", "<token>", rf"(?<![A-Za-z0-9_])(?:{'|'.join(KNOWN_SECRETS)})(?![A-Za-z0-9])"),
    shape("env_secret", "<token>", r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]{1,30}[_.-]){0,5}(?:secret(?:_key)?|token|api_?key|private_?key|access_?key|auth_?key)[\"']?\s{0,2}(?:=>|:=|[:=])\s{0,2}[\"']?(?P<val>[^\s\"',;<>\ue000]{6,200})", secret_ok, ("secret", "token", "key"), I),
    shape("password", "<password>", r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]{1,30}[_.-]){1,5}(?:password|passwd|pwd|pass)[\"']?\s{0,2}(?:=>|:=|[:=])\s{0,2}[\"']?(?P<val>[^\s\"',;<>\ue000]{3,200})", password_ok, ("pass", "pwd"), I),
    keyword("password", "<password>", _PASSWORD + _PASS_TAIL, r"(?<=[\"'«])[^\"'»\n\ue000]{3,60}(?=[\"'»])|[^\s\"'«»,;<>(){}\[\]\ue000]{3,64}", password_ok, ("парол", "порол", "пасворд", "pass", "pwd", "pw", "кодовое")),
    shape("password", "<password>", r"(?:mysql|mariadb|psql|mongo|redis-cli|sshpass|mysqldump|ftp|lftp)\b[^\n]{0,120}?\s-p[ =]?(?P<val>[^\s\"'<>\ue000]{4,64})", None, ("-p",), I),
    keyword("2fa_secret", "<2fa-secret>", r"2fa(?:[ -]?(?:secret|key|код|ключ|секрет))?|totp|authenticator(?: key)?|двухфактор\w*(?: ключ| код)?", r"[A-Za-z2-7]{16,64}|(?:[A-Za-z2-7]{4}[ -]){3,15}[A-Za-z2-7]{4}", base32_ok, ("2fa", "totp", "authent", "двухфактор")),
    keyword("basic_auth", "<token>", r"basic", r"[A-Za-z0-9+/]{8,}={0,2}", basic_ok, ("basic",)),
    keyword("api_key", "<token>", r"(?:api|апи)[ _-]?(?:key|ключ|token|токен)|access[ _-]token|auth[ _-]token|bearer|token|secret[ _-]key|токен(?: доступа)?|секретный ключ|ключ (?:апи|api)", r"[A-Za-z0-9_\-./+=]{12,200}", api_key_ok, ("key", "ключ", "token", "токен", "bearer"), digits=True),
    keyword("licence_key", "<token>", r"licen[cs]e key|activation key|product key|serial key|ключ активации|лицензионный ключ|ключ продукта", r"[A-Z0-9]{4,8}(?:-[A-Z0-9]{4,8}){2,7}", has_both, ("key", "ключ"), digits=True),
    keyword("seed_phrase", "<seed-phrase>", _SEED_LABEL, SEED_RUN, None, ("seed", "mnemonic", "recovery", "secret", "сид", "мнемон", "фраз")),
    shape("txid", "<txid>", r"(?<![0-9A-Za-z])(?:0x)?[0-9a-fA-F]{64}(?![0-9A-Za-z])", digits=True),
    shape("txid", "<txid>", r"(?<![0-9A-Za-z])[1-9A-HJ-NP-Za-km-z]{86,88}(?![0-9A-Za-z])", has_digit, digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])T[1-9A-HJ-NP-Za-km-z]{33}(?![0-9A-Za-z])", has_both, digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])0x[0-9a-fA-F]{40}(?![0-9A-Za-z])", None, ("0x",)),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])(?:bc1|ltc1|tb1)[02-9ac-hj-np-z]{25,87}(?![0-9A-Za-z])", None, ("bc1", "ltc1", "tb1"), I),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])[13][1-9A-HJ-NP-Za-km-z]{25,34}(?![0-9A-Za-z])", has_both, digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])[LM][1-9A-HJ-NP-Za-km-z]{26,33}(?![0-9A-Za-z])", lambda m: has_both(m) and any(c.islower() for c in m[0]), digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])D[5-9A-HJ-NP-U][1-9A-HJ-NP-Za-km-z]{32}(?![0-9A-Za-z])", has_both, digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z])r[1-9A-HJ-NP-Za-km-z]{24,34}(?![0-9A-Za-z])", lambda m: has_both(m) and any(c.isupper() for c in m[0]), digits=True),
    shape("wallet", "<wallet>", r"(?<![0-9A-Za-z_-])(?:EQ|UQ|kQ|0Q)[A-Za-z0-9_-]{46}(?![0-9A-Za-z_-])", None, ("eq", "uq", "kq", "0q")),
    keyword("wallet", "<wallet>", r"usdt|trc-?20|erc-?20|btc|eth|ton|sol|xmr|ltc|trx|bnb|кошел[её]к\w{0,2}|wallet(?: address)?|адрес кошелька", r"[A-Za-z0-9]{25,95}(?![A-Za-z0-9_-])", has_both, ("usdt", "trc", "erc", "btc", "eth", "ton", "sol", "xmr", "ltc", "trx", "bnb", "кошел", "wallet"), digits=True),
    keyword("memo", "<id>", r"memo|destination tag|dest tag|мемо", r"[A-Za-z0-9-]{4,40}", has_digit, ("memo", "tag", "мемо"), digits=True),
    keyword("exchange_uid", "<id>", r"(?:binance|bybit|okx|kucoin|huobi|htx|mexc|gate\.io|bitget)(?:[ _-]?(?:uid|id|айди))?|uid", r"\d{5,12}(?!\d)", exchange_ok, ("binance", "bybit", "okx", "kucoin", "huobi", "htx", "mexc", "gate", "bitget", "uid"), digits=True),
    keyword("tg_id", "<id>", r"(?:telegram|tg|тг|телеграм\w*|chat|user|чат|юзер)[ _-]?(?:id|айди|ид)", r"-?\d{6,13}(?!\d)", None, ("id", "айди", "ид"), digits=True),
    keyword("cvv", "<cvv>", r"cvv2?|cvc2?|цвв|свв|код безопасности|security code", r"\d{3,4}(?![\d.])", companion_ok, ("cvv", "cvc", "цвв", "свв", "безопасн", "security"), digits=True),
    keyword("expiry", "<exp>", r"exp(?:iry|ires?|iration)?(?: date)?|valid (?:thru|till|until)|срок\w{0,2}(?: действия)?(?: карты)?|дата окончания|валидн\w (?:до|по)|действует до", r"(?:0[1-9]|1[0-2])[ ]?[/.\-][ ]?(?:20)?(?:1[3-9]|[2-4]\d)(?![\d./-])(?!\s{0,2}(?:дн|час|мин|раб|сут|day|hour|min))|(?:0[1-9]|1[0-2])(?:1[3-9]|[2-4]\d)(?![\d./-])", companion_ok, ("exp", "valid", "срок", "окончания", "валидн", "действует"), digits=True),
    keyword("cardholder", "<cardholder>", r"card ?holder(?: name)?|name on card|держател[ьяю]\w{0,2}(?: карты)?|владелец карты|имя на карте", r"(?:[A-ZА-ЯЁ][\w'-]{1,20}[ \t]){1,4}[A-ZА-ЯЁ][\w'.-]{1,20}", cardholder_ok, ("holder", "on card", "держател", "владелец карты", "имя на карте"), flags=0, render=None),
    shape("person", "<name>", rf"(?<![\w.])(?:[А-ЯЁ][а-яё]{{1,20}}{_SUR_END[:0]}[ \t][А-ЯЁ]\.[ ]?[А-ЯЁ]\.|[А-ЯЁ]\.[ ]?[А-ЯЁ]\.[ \t]?[А-ЯЁ][а-яё]{{2,20}})(?!\w)", None, (".",)),
    keyword("person", "<name>", r"меня зовут|my name is|фио|ф\.и\.о\.?|получатель|контактное лицо|с уважением,?|recipient|beneficiary|best regards,?|sincerely,?|from:|full name", rf"{_CAP}(?:[ \t]{_CAP}){{1,3}}", None, ("зовут", "name", "фио", "ф.и.о", "получатель", "лицо", "уважением", "recipient", "beneficiary", "regards", "sincerely", "from:"), flags=0),
    keyword("person", "<name>", r"ИП|Индивидуальный предприниматель", rf"{_CAP}(?:[ \t]{_CAP}){{1,2}}|{_CAP}[ \t][А-ЯЁ]\.[ ]?[А-ЯЁ]\.", None, ("ип", "предприниматель"), flags=0),
    keyword("person", "<name>", r"меня зовут", rf"[а-яё]{{2,20}}[ \t][а-яё]{{2,20}}{_SUR_END}(?![а-яё])", None, ("зовут",)),
    keyword("person", "<name>", r"фио|получатель", r"[а-яё]{2,20}[ \t][а-яё]{2,20}[ \t][а-яё]{2,20}(?:ович|евич|овна|евна)[а-яё]{0,2}", None, ("фио", "получатель")),
    keyword("person", "<name>", r"менеджер\w{0,2}|директор\w{0,2}|бухгалтер\w{0,2}|manager|accountant|director", rf"{_CAP}[ \t][А-ЯЁ][а-яё]{{1,20}}{_SUR_END}(?![а-яё])", None, ("менеджер", "директор", "бухгалтер", "manager", "accountant", "director"), flags=0),
    shape("ad_account", "act_<id>", r"(?<![A-Za-z0-9])act_\d{6,}", None, ("act_",)),
    keyword("ad_account", "<ad-account>", r"(?:google ads|tiktok(?: ads)?|facebook|fb|meta|pixel|bm|business manager|рекламн\w{2} (?:кабинет\w{0,2}|аккаунт\w{0,2}))(?:[ _-]?(?:id|account|айди))?", r"\d{3}-\d{3}-\d{4}|\d{8,20}(?!\d)", None, ("ads", "tiktok", "facebook", "fb", "meta", "pixel", "bm", "business", "рекламн"), digits=True),
    keyword("bank_code", "<bank-code>", r"routing(?: number)?|aba|sort code|bsb|бик|мфо", r"\d[\d -]{3,10}\d", digit_count(5, 9), ("routing", "aba", "sort code", "bsb", "бик", "мфо"), digits=True),
    keyword("bank_account", "<account>", r"account (?:number|no\.?)|bank account|a/c|acct|расч[её]тн\w{2} сч[её]т\w{0,2}|р/с|лицев\w{2} сч[её]т\w{0,2}|номер сч[её]та|корр?\.? ?сч[её]т\w{0,2}|к/с", r"\d[\d -]{5,26}\d", digit_count(7, 20), ("account", "a/c", "acct", "счет", "счёт", "р/с", "к/с"), digits=True),
    keyword("backup_codes", "<otp>", r"backup codes?|recovery codes?|резервн\w{2} код\w{0,2}|коды восстановления", r"[A-Za-z0-9]{4,10}(?:-[A-Za-z0-9]{4,10})?(?:[ ,;\n]{1,2}[A-Za-z0-9]{4,10}(?:-[A-Za-z0-9]{4,10})?){0,15}", has_digit, ("backup", "recovery", "резервн", "восстановлен"), digits=True),
    keyword("otp", "<otp>", r"(?<!пин-)(?<!пин )(?<!pin-)код\w{0,2}(?: подтверждения| из смс)?|кодик|смс[- ]?код|пин из смс|пароль из смс|otp|one[- ]time (?:code|password)|(?:sms|verification|confirm(?:ation)?|3ds|security)[ _-]?code|code", r"\d{4,8}(?![\d.,]?\d)", otp_ok, ("код", "смс", "otp", "code", "one-time", "one time"), digits=True),
    keyword("pin", "<pin>", r"pin(?:[ -]?code)?|пин(?:[ -]?код\w{0,2})?|pinкод", r"\d{4,6}(?!\d)", companion_ok, ("pin", "пин"), digits=True),
    shape("kz_id", "<iin>", r"(?<![\d.])\d{12}(?![\d.]?\d)", kz_ok, digits=True, render=kz_render),
    shape("ua_rnokpp", "<rnokpp>", r"(?<![\d.+])\d{10}(?![\d.]?\d)", checked(ua_rnokpp_ok), digits=True),
    shape("by_id", "<personal-id>", r"(?<![A-Za-z0-9])[1-6]\d{6}[ABCEHKM]\d{3}(?:PB|BA|BI)\d(?![A-Za-z0-9])", digits=True),
    shape("kg_pin", "<personal-id>", r"(?<!\d)[12](?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d{2}\d{5}(?!\d)", not_reference, digits=True),
    keyword("snils", "<snils>", r"снилс|snils", r"\d{3}[ -]?\d{3}[ -]?\d{3}[ -]?\d{2}", None, ("снилс", "snils"), digits=True),
    keyword("tax_id", "<tax-id>", r"инн|иин|бин|рнокпп|ипн|tax (?:id|number)|tin|vat(?: number)?|ssn|унп|personal (?:number|code)", r"\d[\d -]{6,20}\d", digit_count(8, 16), ("инн", "иин", "бин", "рнокпп", "ипн", "tax", "tin", "vat", "ssn", "унп", "personal"), digits=True),
    keyword("passport", "<passport>", r"паспорт\w{0,3}(?: (?:серия|номер|№|рф))?|passport(?: (?:no\.?|number))?|уд\.? ?л(?:ичности|\.)|удостоверени\w личности|удв|id card", r"(?:(?-i:[A-ZА-Я]{1,2})[ ]?)?\d{2}[ ]?\d{2}[ ,]?(?:№|номер)?[ ]?\d{5,6}(?!\d)|(?-i:[A-ZА-Я]{1,3})[ №]{0,2}\d{6,9}(?!\d)|\d{8,9}(?!\d)", None, ("паспорт", "passport", "уд", "id card"), digits=True),
    shape("passport", "<passport>", r"(?<![^\W_])(?:passport|паспорт)\w{0,2}_(?P<val>\d{4}_?\d{6})(?!\d)", None, ("passport_", "паспорт"), I, digits=True),
    keyword("driver_licence", "<driver-licence>", r"водительск\w{2,3} (?:удостоверени\w|прав\w)|вод\.? ?уд\.?|в/у|driver'?s? licen[cs]e(?: number)?", r"\d{2}[ ]?(?:\d{2}|(?-i:[А-ЯA-Z]{2}))[ ]?\d{6}(?!\d)|(?-i:[A-Z]{1,2})\d{6,8}(?!\d)", None, ("водительск", "вод", "в/у", "licen"), digits=True),
    keyword("dob", "<dob>", r"дата рожд\w{0,6}\.?|день рождения|д/р|др|родил\w{2,4}|date of birth|dob|birth ?(?:date|day)|born(?: on)?", _DATE_VALUE, None, ("рожд", "д/р", "др", "родил", "birth", "dob", "born"), digits=True),
    shape("dob", "<dob>", rf"(?<![\d.])(?P<val>{_DATE_VALUE}|(?:19|20)\d{{2}})(?=[ ]?(?:г\.?[ ]?р\.?|года рождения|year of birth))", None, ("г", "birth"), I, digits=True),
    keyword("address", "<address>", r"адрес (?:регистрации|проживания|доставки|прописки)|по адресу|мой адрес|прописк[аи]|прожива\w{2,3}|зарегистрирован\w{0,2} по адресу|(?:billing|shipping|home|delivery|postal|street) address", r"[^\n\ue000]{6,120}?(?=[.;]?(?:\n|$)|[.;] [A-ZА-Я])", address_ok, ("адрес", "пропис", "прожива", "address"), digits=True),
    shape("address", "<address>", r"(?<!\w)(?:(?:г\.|город)[ ]?[А-ЯЁ][а-яё-]{2,20},[ ]?)?(?:ул\.|улица|пр-т|просп\.|проспект|пер\.|переулок|бульвар|шоссе|наб\.|мкр\.?)[ ]?(?:\d{1,2}-[а-я]{1,2} )?[А-ЯЁ][А-Яа-яЁё0-9 -]{1,30},?[ ]{0,2}(?:д(?:ом)?\.?[ ]?)?\d{1,4}[а-яА-Я]?(?:[/-]\d{1,3})?(?:,?[ ]?(?:корп|к|стр)\.?[ ]?\d{1,3})?(?:,?[ ]?(?:кв|оф)\.?[ ]?\d{1,4})?", None, ("ул", "пр", "пер", "бульвар", "шоссе", "наб", "мкр"), digits=True),
    shape("address", "<address>", r"(?<![\w.,])\d{1,5}[A-Z]?[ ](?:[A-Z][a-z]{1,20}[ ]){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Dr|Court|Ct|Square|Sq|Way)\b\.?(?:,? (?:Apt|Flat|Suite|Unit)\.? ?\w{1,6})?", None, ("st", "av", "r", "l", "b", "c", "way"), digits=True),
    keyword("address", "<address>", r"адрес|address", r"[^\n\ue000]{8,100}?(?=[.;]?(?:\n|$))", lambda m: street_address_ok(m) and ":" in m.string[m.end("kw") : m.start("val")], ("адрес", "address")),
    keyword("postcode", "<postcode>", r"индекс\w{0,2}|почтовый индекс|post ?code|postal code|zip(?: code)?", r"\d{5,6}(?!\d)", None, ("индекс", "post", "zip"), digits=True),
    shape("txn_ref", "<txn-ref>", r"(?<!\d)[27]\d{22}(?!\d)", digits=True),
    keyword("txn_ref", "<txn-ref>", r"rrn|arn|stan|auth(?:orization)? code|код авторизации|transaction id|txn id", r"[A-Za-z0-9]{6,32}(?![A-Za-z0-9])", has_digit, ("rrn", "arn", "stan", "auth", "авториз", "transaction", "txn"), digits=True),
    shape("user_agent", "<user-agent>", r"Mozilla/\d\.\d \([^()\n]{1,200}(?:\([^()\n]{1,100}\)[^()\n]{0,100})?\)(?: [A-Za-z]+/[\w.+-]+| \([^()\n]{1,100}\)| Mobile| like Gecko){0,12}", None, ("mozilla/",)),
    keyword("device_id", "<device-id>", r"imei|iccid|sim(?: card)?|serial(?: number| no\.?)?|серийный номер|s/n", r"[A-Za-z0-9-]{8,25}(?![A-Za-z0-9])", has_digit, ("imei", "iccid", "sim", "serial", "серийный", "s/n"), digits=True),
]
_ALT_AT = r"(?:\[at\]|\(at\)|\{at\}| at |\[собака\]| собака |\(собака\))"
_ALT_DOT = r"(?:[ ]?(?:\[dot\]|\(dot\)|\{dot\}|\[точка\])[ ]?|[ ](?:dot|точка)[ ]|\.)"
GENERIC_RULES = [
    shape("email_obfuscated", "<email>", rf"(?<![\w.+-])[\w.+-]{{2,64}} ?{_ALT_AT} ?[\w-]{{2,63}}{_ALT_DOT}(?:com|net|org|ru|kz|ua|by|io|me|co|info|biz)(?![\w])", None, ("[dot]", "(dot)", "{dot}", " dot ", "точка", ".com", ".net", ".org", ".ru", ".kz", ".ua", ".by", ".io", ".me", ".co", ".info", ".biz"), I),
    shape("email", "<email>", r"(?<![\w.+%-])[\w.+%-]{1,64}(?:@\n?|@ |[ ]@)[\w-]{1,63}(?:[.,][\w-]{2,63}){1,4}(?![\w])", lambda m: not re.search(r"@\d+x\.(?:png|jpe?g|webp|gif)$|@v?\d+\.\d", m[0], I), ("@",)),
    shape("handle", "@user", r"(?<![A-Za-z0-9.+@])@(?P<val>[A-Za-z][A-Za-z0-9_]{2,31})(?![A-Za-z0-9_])(?:[а-яё]{1,3}(?!\w))?", handle_ok, ("@",)),
    shape("handle_spaced", "@user", r"(?<![\w@])@[ ](?P<val>[A-Za-z][A-Za-z0-9_]{3,31})(?![A-Za-z0-9_])", spaced_handle_ok, ("@ ",)),
    shape("patronymic", "<name>", rf"(?<!\w)(?:{_CAP}[ ])?[А-ЯЁ][а-яё]{{1,20}}[ ]{_PATR}(?![а-яё])", None, ("вич", "вна", "ич")),
    shape("patronymic", "<name>", r"(?<!\w)(?:[А-ЯЁ]{2,20}[ ])?[А-ЯЁ]{2,20}[ ][А-ЯЁ]{2,20}(?:ОВИЧ|ЕВИЧ|ОВНА|ЕВНА|ИЧНА)[АЕУЫ]?(?![А-ЯЁ])", None, ("вич", "вна")),
    shape("hex_secret", "<token>", r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}(?![0-9A-Za-z])", has_digit, digits=True),
    shape("b64_secret", "<token>", r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_-]{40,}={0,2}(?::[^\s<>\ue000]{4,64})?", random_secret, digits=True),
    shape("ipv4", "<ip>", r"(?<![\d.])(?P<quad>\d{1,3}(?:\.\d{1,3}){3})(?P<port>:\d{2,5})?(?![\d.]?\d)", ipv4_ok, digits=True),
    shape("ipv6", "<ip>", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])", ipv6_ok, ("::", ":")),
    shape("iban", "<iban>", r"(?<![A-Za-z0-9])[A-Za-z]{2}\d{2}(?:[ -]?[A-Za-z0-9]{1,4}){3,8}(?![A-Za-z0-9])", iban_accept, digits=True),
    shape("iban", "<iban>", rf"(?<![A-Za-z0-9])(?:{'|'.join(f'{c}[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{n - 4}}}' for c, n in IBAN_LENGTHS.items())})", iban_accept, digits=True),
    keyword("iban", "<iban>", r"iban", r"[A-Za-z]{2}\d{2}(?:[ -]?[A-Za-z0-9]{2,4}){3,8}(?![A-Za-z0-9])", None, ("iban",), digits=True),
    shape("snils", "<snils>", r"(?<![\d-])\d{3}-\d{3}-\d{3}[ -]\d{2}(?![\d-])", checked(snils_ok), digits=True),
    shape("chat_id", "<id>", r"(?<![\w-])-100\d{10,13}(?!\d)", digits=True),
    shape("account", "<account>", r"(?<!\d)(?:40[1-8]|30[1-3]|42[0-6]|47[4-9])\d{17}(?!\d)", digits=True),
    shape("ogrn", "<ogrn>", r"(?<![\d.])[135]\d{12}(?:\d{2})?(?![\d.]?\d)", checked(ogrn_ok), digits=True),
    shape("inn", "<inn>", r"(?<![\d.+])\d{10}(?:\d{2})?(?![\d.]?\d)", checked(inn_ok), digits=True),
]
_SEP = r"[ .\-‐-―()\t]{0,3}"
PHONE_RULES = [
    shape("phone", "<phone>", rf"(?<![^\W\d_])(?:тел(?:ефон\w{{0,2}})?|моб(?:ильн\w{{2}})?|phone|tel|mobile|whats?app|ватсап|viber)\.?{GAP}(?P<val>\+?\d(?:{_SEP}\d){{6,14}})(?!\d)", keyword_phone_ok, ("тел", "моб", "phone", "tel", "mobile", "what", "ватсап", "viber"), I, True),
    shape("phone", "<phone>", rf"(?<![\d.])(?:\+7|8|7){_SEP}\(?[3-9]\d{{2}}\)?{_SEP}\d{{3}}{_SEP}\d{{2}}{_SEP}\d{{2}}(?![\d]|[.,]\d)", ru_phone_ok, digits=True),
    shape("phone", "<phone>", rf"(?<![\w.+])\+?\d(?:{_SEP}\d){{9,14}}(?!\d|[.,]\d)", phone_ok, digits=True),
    shape("phone", "<phone>", rf"(?<![\w.])\+?\d(?:[ .,\-()]{{0,3}}\d){{9,14}}(?!\d)", lambda m: bool(_PHONE_WORD.search(_before(m, 24))) and not_reference(m), digits=True),
    shape("phone", "<phone>", r"(?<![\d.])[78][ ]\d{3}[ ]\d{3}[. ]\d{2}[ ]?\d{2}(?!\d)", lambda m: bool(_PHONE_WORD.search(_before(m, 24)) or re.match(r"\W{0,3}(?:тел|моб|phone|call)", _after(m, 12), I)), digits=True),
]
LAST_RULES = [
    keyword("kw_handle", "@user", r"skype|скайп|инст[аы]\w{0,4}|insta(?:gram)?|логин\w{0,2}|login|telegram|телеграм\w{0,2}|тг|ник(?:нейм)?|nick(?:name)?|username|user name|discord", r"[A-Za-z][A-Za-z0-9_.]{3,31}(?![A-Za-z0-9_@])", bare_handle_ok, ("skype", "скайп", "инст", "insta", "логин", "login", "telegram", "телеграм", "тг", "ник", "nick", "user", "discord")),
]

#: The table in the order of application.
TABLE: tuple[Rule, ...] = (*HEADER_RULES, *PROXY_RULES, *LINK_RULES, *TOKEN_RULES, *ELEMENT_RULES, *FINANCE_RULES, *GENERIC_RULES, *PHONE_RULES, *LAST_RULES)
#: Rules that count only where a card was masked.
CONTEXTUAL: tuple[Rule, ...] = (
    keyword("cvv", "<cvv>", r"код|code", r"\d{3}(?!\d)", companion_ok, ("код", "code"), digits=True),
    keyword("expiry", "<exp>", r"до|till|until", r"(?:0[1-9]|1[0-2])[ ]?[/.\-]?[ ]?(?:20)?(?:1[3-9]|[2-4]\d)(?![\d./-])", companion_ok, ("до", "till", "until"), digits=True),
)
#: Long numbers without a label (rules of these names that accept any match): inside a hash they count only where no rule takes the hash.
NUMBERS = frozenset({"txn_ref", "account"})
BEFORE_CARDS: tuple[Rule, ...] = tuple(r for r in TABLE if r.name == "iban" and r.accept is iban_accept)
#: Identities whose further copies go with the first.
IDENTITIES = frozenset({"inn", "ogrn", "snils", "kz_id", "ua_rnokpp", "passport", "tax_id", "account", "phone"})
