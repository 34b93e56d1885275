"""Scrub and scan agree on random mixtures of what must go and what must stay."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from parlance.functions.scrub import Scrubber
from parlance.plans.policy import Anonymize

from .test_scrub import CASES, ROSTER, STAY

FRAGMENTS = CASES + [x for x in STAY if "{" not in x] + ["@mara_lind", "Зимину", "Берёзке", "8 903 111-22-33", "привет", "order 4821", "код", "пароль", "cvv", "token", "тел.", "до 12/27", "123", "1 500,00 руб", "—"]
OWN = Scrubber(Anonymize(), ROSTER)


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(FRAGMENTS), min_size=1, max_size=6), st.sampled_from([" ", "\n", ", ", "; "]))
def test_scanner_is_silent_on_scrubbed_text(parts, separator):
    clean = OWN.scrub(separator.join(parts))
    assert OWN.scan(clean) == []
    assert OWN.scrub(clean) == clean


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text(max_size=200))
def test_any_text(text):
    clean = OWN.scrub(text)
    assert OWN.scrub(clean) == clean
    assert (OWN.scan(text) == []) == (OWN.hits(text) == [] or all(s == new for _, _, _, s, new in OWN.hits(text)))
