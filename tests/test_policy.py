from __future__ import annotations

import pytest

from parlance.plans import policy
from parlance.plans.policy import PolicyError, from_dict


def test_defaults_and_values():
    assert from_dict({}) == policy.Policy()
    p = from_dict({"output": {"episode_gap_hours": 3}, "anonymize": {"card_bins": ["510000"]}, "chats": {"include_ids": [1, -5]}})
    assert p.output.episode_gap_hours == 3.0 and p.anonymize.card_bins == ("510000",) and p.chats.include_ids == {1, -5}
    snap = p.public_snapshot()
    assert snap["n_card_bins"] == 1 and "include_ids" not in snap


@pytest.mark.parametrize("data", [
    {"anonymise": {}}, {"anonymize": {"url_mod": "drop"}}, {"anonymize": {"url_mode": "x"}}, {"anonymize": {"keep_chat_titles": 1}}, {"output": {"max_chars": True}}, {"output": {"timezone": "Mars/X"}},
    {"anonymize": {"custom_patterns": ["a*"]}}, {"anonymize": {"custom_patterns": ["("]}}, {"anonymize": {"card_bins": ["12"]}}, {"anonymize": {"generic_title_share": 0}}, {"chats": {"include_types": ["grop"]}}, {"output": {"episode_gap_hours": 0}},
])
def test_errors(data):
    with pytest.raises(PolicyError):
        from_dict(data)


def test_did_you_mean():
    with pytest.raises(PolicyError, match="url_mode"):
        from_dict({"anonymize": {"url_mod": "drop"}})


def test_files(tmp_path):
    (tmp_path / "c.toml").write_text('[output]\nmax_chars = 0\n')
    assert policy.load(tmp_path / "c.toml").output.max_chars == 0
    (tmp_path / ".env").write_text("# x\nexport A='1'\nB = two\n")
    assert policy.read_env(tmp_path / ".env") == {"A": "1", "B": "two"}
