"""Checksums of identifiers as column expressions, and as plain functions for text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the checks.
INN_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_11 = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12 = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
SNILS = (9, 8, 7, 6, 5, 4, 3, 2, 1)
KZ_1 = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)
KZ_2 = (3, 4, 5, 6, 7, 8, 9, 10, 11, 1, 2)
UA = (-1, 5, 7, 9, 4, 6, 10, 5, 7)
#: Account number lengths by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def _digit(digits: Column, i: int) -> Column:
    return F.substring(digits, i + 1, 1).cast("int")


def _weighted(digits: Column, weights: tuple[int, ...]) -> Column:
    return sum((_digit(digits, i) * w for i, w in enumerate(weights)), F.lit(0))


def _is(digits: Column, n: int) -> Column:
    return digits.rlike(f"^[0-9]{{{n}}}$")


def luhn(digits: Column) -> Column:
    return F.coalesce(F.call_function("luhn_check", digits), F.lit(False))


def inn(digits: Column) -> Column:
    """Russian tax number of 10 digits (one check digit) or 12 (two)."""
    ten = _weighted(digits, INN_10) % 11 % 10 == _digit(digits, 9)
    twelve = (_weighted(digits, INN_11) % 11 % 10 == _digit(digits, 10)) & (_weighted(digits, INN_12) % 11 % 10 == _digit(digits, 11))
    return F.coalesce(F.when(_is(digits, 10), ten).when(_is(digits, 12), twelve), F.lit(False))


def ogrn(digits: Column) -> Column:
    """Russian registration number of 13 or 15 digits."""
    thirteen = F.substring(digits, 1, 12).try_cast("bigint") % 11 % 10 == _digit(digits, 12)
    fifteen = F.substring(digits, 1, 14).try_cast("bigint") % 13 % 10 == _digit(digits, 14)
    return F.coalesce(F.when(_is(digits, 13), thirteen).when(_is(digits, 15), fifteen), F.lit(False))


def snils(digits: Column) -> Column:
    """Russian insurance number of 11 digits."""
    total = _weighted(digits, SNILS)
    check = F.when(total < 100, total).when(total.isin(100, 101), F.lit(0)).otherwise(total % 101 % 100)
    return F.coalesce(F.when(_is(digits, 11), check == F.substring(digits, 10, 2).cast("int")), F.lit(False))


def kz_id(digits: Column) -> Column:
    """Kazakh number of 12 digits; a second pass where the first gives 10."""
    one, two = _weighted(digits, KZ_1) % 11, _weighted(digits, KZ_2) % 11
    check = F.when(one < 10, one).when(two < 10, two)
    return F.coalesce(F.when(_is(digits, 12), check == _digit(digits, 11)), F.lit(False))


def ua_rnokpp(digits: Column) -> Column:
    """Ukrainian tax number of 10 digits."""
    return F.coalesce(F.when(_is(digits, 10), F.pmod(_weighted(digits, UA), F.lit(11)) % 10 == _digit(digits, 9)), F.lit(False))


def iban(text: Column) -> Column:
    """Account number with a known country, 15 to 34 characters and remainder 1 modulo 97."""
    plain = F.upper(F.regexp_replace(text, r"[\s-]", ""))
    moved = F.concat(F.substring(plain, 5, 30), F.substring(plain, 1, 4))
    step = lambda a, c: F.when(c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + c.try_cast("int")) % 97)
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c).cast("int")))
    shaped = plain.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$") & F.substring(plain, 1, 2).isin(sorted(IBAN_LENGTHS))
    return F.coalesce(F.when(shaped, rest == 1), F.lit(False))


def _dot(s: str, weights: tuple[int, ...]) -> int:
    return sum(int(c) * w for c, w in zip(s, weights, strict=False))


def luhn_ok(s: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def inn_ok(s: str) -> bool:
    if len(s) == 10:
        return _dot(s, INN_10) % 11 % 10 == int(s[9])
    return len(s) == 12 and _dot(s, INN_11) % 11 % 10 == int(s[10]) and _dot(s, INN_12) % 11 % 10 == int(s[11])


def ogrn_ok(s: str) -> bool:
    return len(s) in (13, 15) and int(s[:-1]) % (len(s) - 2) % 10 == int(s[-1])


def snils_ok(s: str) -> bool:
    total = _dot(s, SNILS)
    return len(s) == 11 and (total if total < 100 else total % 101 % 100) == int(s[9:])


def kz_id_ok(s: str) -> bool:
    if len(s) != 12:
        return False
    check = _dot(s, KZ_1) % 11
    return (check if check < 10 else _dot(s, KZ_2) % 11) == int(s[11])


def kz_person(s: str) -> bool:
    """Whether a Kazakh number begins with a birth date and a century digit, as a person's does."""
    return 1 <= int(s[2:4]) <= 12 and 1 <= int(s[4:6]) <= 31 and 1 <= int(s[6]) <= 6


def ua_rnokpp_ok(s: str) -> bool:
    return len(s) == 10 and _dot(s, UA) % 11 % 10 == int(s[9])


def iban_ok(s: str) -> bool:
    s = "".join(c for c in s.upper() if c.isalnum())
    if not 15 <= len(s) <= 34 or s[:2] not in IBAN_LENGTHS or not s[2:4].isdigit() or not s.isascii():
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
