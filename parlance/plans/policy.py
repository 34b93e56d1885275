"""Settings: dataclasses, a strict TOML reader and an env-file reader."""

from __future__ import annotations

import difflib
import re
import tomllib
from dataclasses import dataclass, field, fields
from pathlib import Path
from zoneinfo import ZoneInfo


class PolicyError(ValueError):
    """A setting that is unknown or has a wrong value."""


#: Sections that a settings file may hold for the chat client, which is no part of this engine.
OF_THE_CLIENT = frozenset({"telegram", "export"})
#: Kinds of chats.
CHAT_KINDS = frozenset({"private", "bot", "group", "supergroup", "channel"})


# Names, defaults and order of the settings, which files share.


@dataclass(frozen=True)
class ChatFilter:
    include_types: frozenset[str] = frozenset({"group", "supergroup"})
    include_ids: frozenset[int] = frozenset()
    exclude_ids: frozenset[int] = frozenset()
    exclude_title_regex: tuple[str, ...] = ()
    include_archived: bool = True
    exclude_internal: bool = True


@dataclass(frozen=True)
class Staff:
    support: tuple[str, ...] = ()
    sales: tuple[str, ...] = ()
    other: tuple[str, ...] = ()


@dataclass(frozen=True)
class Anonymize:
    name_mode: str = "first"
    keep_chat_titles: bool = False
    keep_service_messages: bool = False
    url_mode: str = "drop"
    allow_domains: tuple[str, ...] = ()
    keep_terms: tuple[str, ...] = ()
    custom_terms: tuple[str, ...] = ()
    custom_patterns: tuple[str, ...] = ()
    #: Words of the wallets' list of seed phrases; without them phrases are told by their shape.
    seed_words: tuple[str, ...] = ()
    scrub_last_names: bool = True
    scrub_chat_titles: bool = True
    keep_bot_messages: bool = True
    keep_file_names: bool = False
    card_bins: tuple[str, ...] = ()
    scrub_domains: bool = True
    generic_title_share: float = 0.2


@dataclass(frozen=True)
class Output:
    timezone: str = "UTC"
    episode_gap_hours: float = 6.0
    max_chars: int = 200_000
    max_message_chars: int = 2000
    turn_merge_seconds: int = 120


@dataclass(frozen=True)
class Policy:
    chats: ChatFilter = field(default_factory=ChatFilter)
    staff: Staff = field(default_factory=Staff)
    anonymize: Anonymize = field(default_factory=Anonymize)
    output: Output = field(default_factory=Output)

    def public_snapshot(self) -> dict:
        """What may be published of the policy: no ids, names, terms or patterns."""
        a, o = self.anonymize, self.output
        flags = {n: getattr(a, n) for n in ("name_mode", "keep_chat_titles", "keep_service_messages", "url_mode", "scrub_last_names", "scrub_chat_titles", "keep_bot_messages", "keep_file_names", "scrub_domains", "generic_title_share")}
        sizes = {f"n_{n}": len(getattr(a, n)) for n in ("allow_domains", "keep_terms", "custom_terms", "custom_patterns", "seed_words", "card_bins")}
        return flags | sizes | {f.name: getattr(o, f.name) for f in fields(o)}


def _unknown(kind: str, name: str, known: list[str]) -> PolicyError:
    near = difflib.get_close_matches(name, known, 1)
    return PolicyError(f"unknown {kind} {name!r}" + (f"; did you mean {near[0]!r}?" if near else ""))


def _value(name: str, value: object, default: object) -> object:
    """`value` in the type of `default`; a flag never passes as a number."""
    if isinstance(default, bool):
        if not isinstance(value, bool):
            raise PolicyError(f"{name} must be true or false")
        return value
    if isinstance(default, (int, float)):
        if isinstance(value, bool) or not isinstance(value, (int, float)) or isinstance(default, int) and not isinstance(value, int):
            raise PolicyError(f"{name} must be a number")
        if value < 0:
            raise PolicyError(f"{name} must not be negative")
        return type(default)(value)
    if isinstance(default, str):
        if not isinstance(value, str):
            raise PolicyError(f"{name} must be a string")
        return value
    if not isinstance(value, list) or any(isinstance(x, (bool, list, dict, float)) for x in value):
        raise PolicyError(f"{name} must be a list")
    if name.endswith("_ids"):
        if any(not isinstance(x, int) for x in value):
            raise PolicyError(f"{name} must hold ids")
        return frozenset(value)
    if name not in ("support", "sales", "other") and any(not isinstance(x, str) for x in value):
        raise PolicyError(f"{name} must hold strings")
    return frozenset(map(str, value)) if isinstance(default, frozenset) else tuple(map(str, value))


def _check(policy: Policy) -> Policy:
    for kind in policy.chats.include_types - CHAT_KINDS:
        raise _unknown("chat type", kind, sorted(CHAT_KINDS))
    a = policy.anonymize
    if a.name_mode not in ("first", "full", "none"):
        raise PolicyError("name_mode must be first, full or none")
    if a.url_mode not in ("drop", "domain", "keep"):
        raise PolicyError("url_mode must be drop, domain or keep")
    for pattern in (*policy.chats.exclude_title_regex, *a.custom_patterns):
        try:
            compiled = re.compile(pattern)
        except re.error as e:
            raise PolicyError(f"pattern does not compile: {e}") from None
        if pattern in a.custom_patterns and compiled.match(""):
            raise PolicyError("a custom pattern must not match empty text")
    if not 0 < a.generic_title_share <= 1:
        raise PolicyError("generic_title_share must be above 0 and at most 1")
    if any(not re.fullmatch(r"\d{6,8}", b) for b in a.card_bins):
        raise PolicyError("card_bins must have 6 to 8 digits")
    if any(len(t.strip()) < 2 for t in a.custom_terms):
        raise PolicyError("custom_terms must have two characters or more")
    if policy.output.episode_gap_hours <= 0:
        raise PolicyError("episode_gap_hours must be positive")
    try:
        ZoneInfo(policy.output.timezone)
    except (KeyError, ValueError, OSError):
        raise PolicyError(f"unknown timezone {policy.output.timezone!r}") from None
    return policy


def from_dict(data: dict) -> Policy:
    """A policy from nested tables; unknown names are errors, sections of the chat client are passed over."""
    sections = {f.name: f.default_factory() for f in fields(Policy)}
    for name, table in data.items():
        if name in OF_THE_CLIENT:
            continue
        if name not in sections:
            raise _unknown("section", name, list(sections))
        known = {f.name: getattr(sections[name], f.name) for f in fields(sections[name])}
        for key in table:
            if key not in known:
                raise _unknown("setting", key, list(known))
        sections[name] = type(sections[name])(**{**known, **{k: _value(k, v, known[k]) for k, v in table.items()}})
    return _check(Policy(**sections))


def load(path: str | Path) -> Policy:
    with open(path, "rb") as f:
        return from_dict(tomllib.load(f))


def read_env(path: str | Path) -> dict[str, str]:
    """KEY=value lines; blank lines and comments are skipped, an `export` and quotes are dropped."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip().removeprefix("export ")
        key, sep, value = line.partition("=")
        if sep and not line.startswith("#"):
            value = value.strip()
            out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out
