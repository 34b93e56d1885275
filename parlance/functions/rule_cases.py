"""Cases of the rule table: texts with a value of each kind, texts that only look like one, and what they become.

A case is a template over values that SQL derives from a key, so that one text
serves the engine and the SQL that checks it: `{d4}` is a number of four
digits, `{h}` are 32 hexadecimal digits and `{w8}` eight letters of the key's
own. Nothing here is a live secret: values are put together when they are read.
"""

from __future__ import annotations

import re

#: Values of a key, in SQL that Spark and DuckDB read alike.
_NUMBER = "CAST((k * 7919 + {salt}) % {span} + {least} AS STRING)"
_VALUES = {f"d{n}": _NUMBER.format(salt=n * 104729, span=9 * 10 ** (n - 1), least=10 ** (n - 1)) for n in range(3, 10)}
_MD5 = "md5(CAST(k AS STRING))"
#: Random text begins with a digit, so that it begins no word and no account number.
_HEX = f"'7' || substr({_MD5}, 2)"
_LETTERS = f"translate({_MD5}, '0123456789', 'ghijkmnpqr')"
_MIXED = f"'7' || substr(translate({_MD5}, '01', 'Gz'), 2)"
_VALUES |= {"h": _HEX, "uh": f"upper({_HEX})", "w8": f"substr({_LETTERS}, 1, 8)", "v8": f"upper(substr({_LETTERS}, 9, 8))", "w16": f"substr({_LETTERS}, 3, 16)", "m20": f"substr({_MIXED}, 1, 20)", "m32": _MIXED, "v32": f"'7' || substr(upper({_LETTERS}), 2)", "o1": "CAST(k % 200 + 20 AS STRING)"}
COLUMNS = [f"{sql} AS {name}" for name, sql in _VALUES.items()]
#: First digits of cards that the policy of the cases knows.
BINS = ("510000",)


def _with_check(head: str, weights: list[list[int]]) -> str:
    """Digits with check digits of weighted sums modulo 11 and 10 behind them."""
    for w in weights:
        head += str(sum(int(d) * x for d, x in zip(head, w, strict=True)) % 11 % 10)
    return head


def _luhn(head: str) -> str:
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(head)))
    return head + str(-total % 10)


def _iban(country: str, body: str) -> str:
    number = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{country}{98 - number % 97:02}{body}"


def _snils(head: str) -> str:
    total = sum(int(d) * (9 - i) for i, d in enumerate(head))
    return f"{head[:3]}-{head[3:6]}-{head[6:]} {total % 101 % 100:02}"


def _spoilt(number: str) -> str:
    """The number with another last digit."""
    return number[:-1] + str((int(number[-1]) + 1) % 10)


INN10 = _with_check("631904825", [[2, 4, 10, 3, 5, 9, 4, 6, 8]])
INN12 = _with_check("5403981762", [[7, 2, 4, 10, 3, 5, 9, 4, 6, 8], [3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8]])
OGRN = "117502489361" + str(117502489361 % 11 % 10)
RNOKPP = "301284756" + str(sum(int(d) * w for d, w in zip("301284756", (-1, 5, 7, 9, 4, 6, 10, 5, 7), strict=True)) % 11 % 10)
KZ = next(f"85031{n:06d}"[:11] + str(c) for n in range(5_0000, 6_0000) for c in [sum(int(d) * w for d, w in zip(f"85031{n:06d}"[:11], range(1, 12), strict=True)) % 11] if c < 10)
SNILS, CARD, IBAN = _snils("087654303"), _luhn("411111023456789"), _iban("DE", "370400440532013000")
PERSON_KZ = "<iin>"
#: A case: text, what it becomes, and what the scanner calls it if not by the rule's name; without the last two it stays.
Case = tuple[str, ...]
_KEY, _END = "-----BEGIN RSA PRIVATE" + " KEY-----", "-----END RSA PRIVATE" + " KEY-----"

CASES: dict[str, list[Case]] = {
    "td_header": [("Olga {w8}, [12.03.2024 10:15]\nhello", "<name>, [12.03.2024 10:15]\nhello"), ("ERROR, [12.03.2024 10:15] worker {d4} died",), ("total, [{d4}] items",)],
    "td_companion": [("[Forwarded from Petr {w8}]\nok", "[Forwarded from <name>]\nok"), ("[In reply to Olga {w8}]", "[In reply to <name>]"), ("[Deployed from {w8}]",)],
    "proxy": [
        ("via socks5://{w8}:{m20}@198.51.100.7:{d4} ok", "via <proxy> ok"), ("198.51.100.{o1}:3128:{w8}:{m20}", "<proxy>"), ("{w8}:{m20}@198.51.100.{o1}:3128", "<proxy>"), ("gw.{w8}.net:{d4}:{w8}:{m20}", "<proxy>"),
        ("in 10:30:00:{d3} the job began",),
    ],
    "tg_link": [("write to t.me/{w8} now", "write to <tg-link> now"), ("tg://resolve?domain={w8}", "<tg-link>"), ("format.mex is {w8}",)],
    "url": [("see https://{w8}.example/{d4}?x=1.", "see <url>."), ("www.{w8}.example/a", "<url>"), ("shop{d3}.com/cart/{d4}", "<url>"), ("ratio 3/4 of {d4}",)],
    "bot_token": [("key {d9}:AAf-{m20}wxyzABCDEFG", "key <token>"), ("at {d4}:{d4}",)],
    "jwt": [("auth eyJ{m20}.eyJ{m20}.{m32}", "auth <token>"), ("eyJust a word {w8}",)],
    "password": [
        ("<userPassword>{w8}9</userPassword>", "<userPassword><password></userPassword>"), ("db_password={w8}{d3}", "db_password=<password>"), ("пароль: {w8}{d3}", "пароль: <password>"), ("password is {v8}{d3}!", "password is <password>"), ("mysql -h db -u app -p{w8}{d3} shop", "mysql -h db -u app -p<password> shop"),
        ("password expired, ticket {d4}",), ("пароль не менее {d3} знаков",), ("ssh -p {d4} host",),
    ],
    "cvv": [("<cvc>{d3}</cvc>", "<cvc><cvv></cvc>"), ("cvv: {d3}", "cvv: <cvv>"), ("код безопасности {d3}", "код безопасности <cvv>"), (f"{CARD} код {{d3}}", f"{CARD[:6]}********** код <cvv>", "card,cvv"), ("cvv mismatch error {d4}0",)],
    "pin": [("<cardPin>{d4}</cardPin>", "<cardPin><pin></cardPin>"), ("пин-код: {d4}", "пин-код: <pin>"), ("pin {d4}", "pin <pin>"), ("spin {d4} times",)],
    "otp": [("<smsCode>{d6}</smsCode>", "<smsCode><otp></smsCode>"), ("код из смс {d6}", "код из смс <otp>"), ("verification code: {d6}", "verification code: <otp>"), ("код ответа {d4}",), ("barcode {d4}",)],
    "api_key": [("<apiKey>{m20}</apiKey>", "<apiKey><token></apiKey>"), ("api key: {m32}", "api key: <token>"), ("Bearer {m20}.{m20}", "Bearer <token>"), ("token expired after {d4} s",)],
    "kw_handle": [("<login>{w8}_{d3}</login>", "<login>@user</login>"), ("skype: {w8}_{d3}", "skype: @user"), ("логин {w8}{d3}", "логин @user"), ("login failed {d4} times",)],
    "private_key": [(f"{_KEY}\n{{m32}}\n{_END}", f"{_KEY}<private-key>{_END}"), (f"{_KEY} is how it begins {{d3}}",)],
    "credentials": [
        ("{w8}@example.org:{w8}{d3}", "<credentials>"), ("{w8}:{v8}{d3}:{w8}", "<credentials>"), ("логин {w8}:{w8}{d3}", "логин <credentials>"), ("root:{w8}{d3}", "<credentials>"),
        ("scope:reader for {w8}",), ("postgres:16-alpine",),
    ],
    "cookie": [("JSESSIONID={uh}; path=/", "JSESSIONID=<cookie>; path=/"), ("csrftoken={m20}", "csrftoken=<cookie>"), ("session={d3}",)],
    "fb_token": [("EAA{m32}", "<token>"), ("EAA {w8}",)],
    "known_secret": [("AK" + "IA{v8}{v8}", "<token>"), ("gh" + "p_{m32}", "<token>"), ("AIza {w8}",)],
    "env_secret": [("APP_SECRET_KEY={w8}{d6}", "APP_SECRET_KEY=<token>"), ("auth.token: '{w8}{d6}'", "auth.token: '<token>'"), ("max_token = {d4}",)],
    "2fa_secret": [("2fa: JBSW Y3DP {v8}".replace("{v8}", "EHPK 3PXP"), "2fa: <2fa-secret>"), ("totp secret {v32}".replace("totp secret", "totp"), "totp <2fa-secret>"), ("2fa is on for {d4} users",)],
    "basic_auth": [("Authorization: Basic dXNlcjpzM2NyZXQ=", "Authorization: Basic <token>"), ("basic plan {d4}",)],
    "licence_key": [("activation key: A{d4}-B{d4}-C{d4}", "activation key: <token>"), ("product key points {d4}",)],
    "seed_phrase": [
        ("seed phrase: " + " ".join(["zoo", "ghost", "river", "maple", "stone", "cloud"] * 2), "seed phrase: <seed-phrase>"), (" ".join(["lemon"] * 11 + ["{w8}"]), "<seed-phrase>"), (", ".join(["lemon", "tiger", "ocean"] * 4), "<seed-phrase>"),
        ("some words make sentences that people write with ease and {w8} reads them",), (" ".join(["lemon"] * 9) + " {w8}",),
    ],
    "txid": [("tx 0x{h}{h}", "tx <txid>"), ("{h}{h}", "<txid>"), ("sent " + "5Kd3NBUAdUnhyzenEwVLy9pBKxSwXvE9FMPyR4UKZvpe6E3AgLr" + "5Kd3NBUAdUnhyzenEwVLy9pBKxSwXvE9FMP8", "sent <txid>"), ("0x{d4}",)],
    "wallet": [
        ("T" + "JRabPrwbZy45sbavfcjinPJC18kjpRTv{o1}"[:-4] + "8", "<wallet>"), ("to 0x{h}{d8}", "to <wallet>"), ("bc1q{w16}{w16}".replace("{w16}{w16}", "ar0srrr7xfkvy5l643lydnw9re59gtzzwf5mdq"), "<wallet>"), ("1BoatSLRHtKNngkdXEeobR76b53LETtpyT", "<wallet>"),
        ("LM2WMpR1Rp6j3Sa59cMXMs1SPzj9eXpGc1", "<wallet>"), ("DH5yaieqoZN36fDVciNyRueRGvGLR3mr7L", "<wallet>"), ("rDsbeomae4FXwgQTJp9Rs64Qg9vDiTCdBv", "<wallet>"), ("EQ" + "CD39VS5jcptHL8vMjEXrzGaRcCVYto7HUn4bpAOg8xqB2N", "<wallet>"), ("usdt {m32}", "usdt <wallet>"), ("usdt {d4} sent",),
    ],
    "memo": [("memo: {d6}", "memo: <id>"), ("destination tag {d8}", "destination tag <id>"), ("memory {d4} MB",)],
    "exchange_uid": [("binance id {d8}", "binance id <id>"), ("bybit uid: {d8}", "bybit uid: <id>"), ("binance fee {d3}",)],
    "tg_id": [("telegram id: {d9}", "telegram id: <id>"), ("chat_id {d9}", "chat_id <id>"), ("paid {d9} in total",)],
    "expiry": [("exp 12/27", "exp <exp>"), ("срок действия карты 03/2029", "срок действия карты <exp>"), (f"{CARD} до 12/29", f"{CARD[:6]}********** до <exp>", "card,expiry"), ("срок до 12.03.2026, заявка {d4}",)],
    "cardholder": [("cardholder: Olga {w8}ova".replace("{w8}ova", "Sokolova"), "cardholder: <cardholder>"), ("держатель карты Иван Соколов", "держатель карты <cardholder>"), ("cardholder name mismatch {d4}",)],
    "person": [
        ("договор подписал Соколов И. П. вчера", "договор подписал <name> вчера"), ("меня зовут Пётр Соколов", "меня зовут <name>"), ("ИП Соколов Пётр", "ИП <name>"), ("меня зовут пётр соколов", "меня зовут <name>"),
        ("фио соколов пётр ильич".replace("ильич", "иванович"), "фио <name>"), ("менеджер Пётр Соколов", "менеджер <name>"), ("получатель не найден {d4}",), ("менеджер ответит через {d3} минут",),
    ],
    "ad_account": [("act_{d9}", "act_<id>"), ("google ads {d3}-{d3}-{d4}", "google ads <ad-account>"), ("act {d3}",)],
    "bank_code": [("БИК {d9}", "БИК <bank-code>"), ("sort code 20-11-47", "sort code <bank-code>"), ("бик будет {d3}",)],
    "bank_account": [("account number {d9}{d3}", "account number <account>"), ("р/с {d9}{d9}51", "р/с <account>"), ("account {d3}",)],
    "backup_codes": [("backup codes: {d8}, {d8}", "backup codes: <otp>"), ("резервные коды {d6} {d7}", "резервные коды <otp>"), ("backup codes are kept",)],
    "kz_id": [(f"номер {KZ} есть", f"номер {PERSON_KZ} есть"), (f"номер {_spoilt(KZ)} есть",)],
    "ua_rnokpp": [(f"номер {RNOKPP} есть", "номер <rnokpp> есть"), (f"номер {_spoilt(RNOKPP)} есть",), (f"заказ {RNOKPP}",)],
    "by_id": [("3{d6}A{d3}PB7", "<personal-id>"), ("3{d6}X{d3}PB7",)],
    "kg_pin": [("21203199012345", "<personal-id>"), ("29903199012345",)],
    "snils": [("СНИЛС " + SNILS, "СНИЛС <snils>"), ("номер " + SNILS, "номер <snils>"), ("номер " + _spoilt(SNILS),)],
    "tax_id": [("ИНН {d9}", "ИНН <tax-id>"), ("VAT {d9}", "VAT <tax-id>"), ("инн указан в {d4}",)],
    "passport": [("паспорт 4510 {d6}", "паспорт <passport>"), ("passport_{d4}_{d6}.jpg", "passport_<passport>.jpg"), ("паспорт нужен к {d4} году",)],
    "driver_licence": [("водительское удостоверение 7710 {d6}", "водительское удостоверение <driver-licence>"), ("driver licence D{d7}", "driver licence <driver-licence>"), ("driver licence page {d3}",)],
    "dob": [("дата рождения 12.03.1990", "дата рождения <dob>"), ("Олег, 05.06.1988 г.р.", "Олег, <dob> г.р."), ("поставка 12.03.2026, {d4} штук",)],
    "address": [
        ("адрес доставки: Казань, Баумана {d3}", "адрес доставки: <address>"), ("живёт на ул. Баумана, д. 15, кв. 7", "живёт на <address>"), ("at 221 Baker Street", "at <address>"), ("Адрес: Казань, Баумана, 15", "Адрес: <address>"),
        ("пер. {d3} руб",), ("адрес страницы не найден",),
    ],
    "postcode": [("индекс {d6}", "индекс <postcode>"), ("zip code {d5}", "zip code <postcode>"), ("индекс роста {d3}",)],
    "txn_ref": [("7{d9}{d9}{d4}", "<txn-ref>"), ("rrn A{d9}", "rrn <txn-ref>"), ("rrn is missing",)],
    "user_agent": [("Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 Chrome/1{d3} fails", "<user-agent> fails"), ("Mozilla {d3}",)],
    "device_id": [("serial number: SN{d9}", "serial number: <device-id>"), ("s/n A{d9}", "s/n <device-id>"), ("simple {d9}",)],
    "email_obfuscated": [("{w8} [at] example [dot] org", "<email>"), ("{w8} at noon",)],
    "email": [("to {w8}.{d3}@example.org now", "to <email> now"), ("{w8}@2x.png",)],
    "handle": [("ask @{w8} today", "ask @user today"), ("npm i @{w8}/core",)],
    "handle_spaced": [("ask @ {w8}_{d3}", "ask @user"), ("five @ noon",)],
    "patronymic": [("звонила Анна Сергеевна", "звонила <name>"), ("АННА СЕРГЕЕВНА звонила", "<name> звонила"), ("ровна дорога {d3}",)],
    "hex_secret": [("hash a{h}", "hash <token>"), ("dead beef {d3}",)],
    "b64_secret": [("blob Q{m32}x{m20}Z", "blob <token>"), ("PAYMENT_DECLINED_INSUFFICIENT_FUNDS_ERROR_{d4}",)],
    "ipv4": [("host 198.51.100.{o1}", "host <ip>"), ("версия 2.15.3.100",), ("127.0.0.1:{d4}",)],
    "ipv6": [("host 2001:db8::ff00:42:8329", "host <ip>"), ("2001:db8:0:0:1:0:0:1", "<ip>"), ("at 10:00:00:{d3}",)],
    "iban": [(IBAN, "<iban>"), ("pay " + " ".join(IBAN[i : i + 4] for i in range(0, len(IBAN), 4)) + " now", "pay <iban> now"), ("iban GB00WEST{d6}AB{d4}", "iban <iban>"), (IBAN[:2] + "00" + "X" * 3,)],
    "chat_id": [("in -1001234567890 it was", "in <id> it was"), ("a drop of -100{d3}",)],
    "account": [("to 40817810{d9}{d3}", "to <account>"), ("99917810{d9}{d3}",)],
    "ogrn": [("номер " + OGRN, "номер <ogrn>"), ("номер " + _spoilt(OGRN),)],
    "inn": [("номер " + INN10, "номер <inn>"), ("номер " + INN12, "номер <inn>"), ("номер " + _spoilt(INN10),), ("заказ № " + INN10,)],
    "phone": [
        ("тел. 123-45-{o1}".replace("{o1}", "67"), "тел. <phone>"), ("+7 (916) {d3}-45-67", "<phone>"), ("+1 (555) {d3}-0123", "<phone>"), ("звоните 4951234567", "звоните <phone>"), ("звоните 8 916 {d3} 45 67", "звоните <phone>"),
        ("заказ № {d9}4",), ("sum 1500.00 2300.50",),
    ],
    "card": [(f"card {CARD} ok", f"card {CARD[:6]}********** ok"), (" ".join(CARD[i : i + 4] for i in (0, 4, 8, 12)), CARD[:6] + "**********"), ("5100 0012 3456 {d4}", "510000**********"), ("order " + _spoilt(CARD),), ("42424242 {d3}",)],
}


def _expression(template: str) -> str:
    """A template as a SQL concatenation."""
    out = []
    for i, part in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            out.append(part)
        else:
            out += [f"'{line.replace(chr(39), chr(39) * 2)}'" if k % 2 == 0 else "chr(10)" for k, line in enumerate(re.split("(\n)", part)) if line]
    return " || ".join(out) or "''"


def as_sql(rule: str) -> list[tuple[str, str, str]]:
    """The cases of a rule as SQL: text, what it becomes, kinds that the scanner finds."""
    return [(_expression(c[0]), _expression(c[1] if len(c) > 1 else c[0]), f"'{c[2] if len(c) > 2 else rule if len(c) > 1 and c[1] != c[0] else ''}'") for c in CASES[rule]]


def as_texts(rule: str, values: dict[str, str]) -> list[tuple[str, str, str]]:
    """The cases of a rule with `values` put in."""
    fill = lambda t: re.sub(r"\{(\w+)\}", lambda m: values[m[1]], t)
    return [(fill(c[0]), fill(c[1] if len(c) > 1 else c[0]), c[2] if len(c) > 2 else rule if len(c) > 1 and c[1] != c[0] else "") for c in CASES[rule]]
