"""The whole plan on a small raw store: anonymize, write, verify, then plant a leak."""

from __future__ import annotations

import json

import pytest

from parlance import cli
from parlance.operators import audit
from parlance.plans import anonymize as plan_
from parlance.plans import policy


def _write(folder):
    user = lambda i, first, last="", username="", phone="", **k: {"id": i, "first_name": first, "last_name": last, "username": username, "phone": phone, "is_bot": False, "is_deleted": False, "usernames": [username] if username else []} | k
    users = [user(1, "Olga", username="olga_support"), user(2, "Pavel", "Sales", username="pavel_s"), user(3, "Ivan", "Petrov", "ivan_petrov", "79161234567"), user(4, "Anna", "Smith", "anna_smith"), user(5, "Robo", is_bot=True), user(6, "Gone", is_deleted=True)]
    chat = lambda i, kind, title, **k: {"id": i, "kind": kind, "title": title, "username": "", "is_archived": False, "is_forum": False, "is_accessible": True, "participant_ids": []} | k
    chats = [chat(-10, "group", "Romashka old", migrated_to=-100), chat(-100, "supergroup", "Romashka support", participant_ids=[1, 3, 5]), chat(-200, "supergroup", "Vasilek", participant_ids=[2, 4])]
    msg = lambda c, i, day, hour, who, text, **k: {"chat_id": c, "id": i, "date": f"2024-01-{day:02d}T{hour:02d}:00:00Z", "sender_id": who, "sender_kind": "user", "text": text} | k
    rows = [
        msg(-10, 1, 1, 9, 3, "old hello"), msg(-10, 2, 1, 9, 3, "", action="migrate"),
        msg(-100, 1, 2, 10, 3, "my mail is ivan@example.com and I am @ivan_petrov"), msg(-100, 2, 2, 10, 1, "hi @ivan_petrov, card " + "4242" * 4, entities=[{"type": "Mention", "offset": 3, "length": 12}], reply_to_id=1),
        msg(-100, 3, 2, 21, 5, "bot says"), msg(-100, 4, 3, 10, 6, "deleted asks"), msg(-100, 5, 3, 10, 3, ""), msg(-100, 6, 3, 11, 3, "doc", media={"kind": "document", "ext": "pdf", "size": 2_000_000}),
        msg(-100, 7, 3, 11, 99, "stub writes for Romashka"), msg(-100, 6, 3, 11, 3, "doc edited", edit_date="2024-01-03T12:00:00Z", media={"kind": "document", "ext": "pdf", "size": 2_000_000}),
        msg(-200, 1, 5, 9, 4, "Petrov called +7 916 123-45-67", forward={"kind": "user", "from_id": 3}), msg(-200, 2, 5, 9, 2, "ok", reply_to_id=1),
    ]
    (folder / "messages").mkdir(parents=True)
    (folder / "messages" / "a.json").write_text("\n".join(map(json.dumps, rows)) + '\n{"chat_id": -200, "id": 3, "te')
    (folder / "users.json").write_text(json.dumps({u["id"]: u for u in users}))
    (folder / "chats.json").write_text(json.dumps({c["id"]: c for c in chats}))
    (folder / "state.json").write_text(json.dumps({"me_id": 1}))


@pytest.fixture(scope="module")
def store_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("store")
    _write(folder / "raw")
    (folder / "c.toml").write_text('[staff]\nsales = ["@pavel_s"]\n')
    return folder


@pytest.fixture(scope="module")
def made(spark, store_dir):
    raw = cli._raw(spark, str(store_dir / "raw"))
    empty = spark.createDataFrame([], "kind string, raw_id bigint, vid string")
    return plan_.anonymize(raw, policy.load(store_dir / "c.toml"), empty, cli._persist(spark, str(store_dir / "tables")))


def test_messages(made):
    rows = made.messages.orderBy("chat", "seq").collect()
    assert len(rows) == 9
    vid = {r["raw_id"]: r["vid"] for r in made.mapping.collect()}
    merged = [r for r in rows if r["chat"] == vid[-100]]
    assert [r["seq"] for r in merged] == [1, 2, 3, 4, 5, 6, 7] and len({vid[-100], vid[-200]}) == 2 and -10 not in vid
    assert merged[1]["text"] == f"my mail is <email> and I am @{vid[3]}"
    assert merged[2]["text"] == f"hi @{vid[3]}, card 424242**********" and merged[2]["reply_to"] == 2
    assert [r["role"] for r in merged] == ["client", "client", "support", "bot", "deleted", "client", "deleted"]
    assert merged[5]["text"] == "doc edited" and merged[5]["edited"] and merged[5]["media_label"] == "[document:pdf 2.0 MB]"
    assert merged[6]["text"] == "stub writes for <org>"
    assert [r["episode"] for r in merged] == [1, 2, 2, 3, 4, 4, 4]
    other = [r for r in rows if r["chat"] == vid[-200]]
    assert other[0]["text"] == "<name> called <phone>" and other[0]["forwarded"] == vid[3] and other[1]["role"] == "sales"


def test_reports(made):
    assert {r["drop_reason"]: r["n"] for r in made.dropped.collect()} == {"service": 1, "empty": 1}
    m = made.manifest()
    assert m["messages"] == 9 and m["chats"] == 2 and m["users_by_role"]["client"] == 2 and m["episodes"] == 5
    names = {r["name"] for r in made.users.collect()}
    assert {"Olga", "Ivan", "Anna", "Deleted"} <= names and not any("Petrov" in n for n in names)
    assert made.hits.where("rule = 'email'").first()["n"] == 1
    report = made.report()
    assert report["rules"]["email"]["hits"] == 1 and len(report["rules"]["email"]["samples"]) == 1 and report["dropped"] == {"service": 1, "empty": 1}
    assert "10:00" in made.transcripts.orderBy("chat").first()["text"] or made.transcripts.count() == 2
    plan_.checked(made)


def test_ids_are_stable(spark, made, store_dir):
    again = plan_.anonymize(cli._raw(spark, str(store_dir / "raw")), made.policy, made.mapping, cli._persist(spark, str(store_dir / "tables2")))
    assert sorted(map(tuple, again.mapping.collect())) == sorted(map(tuple, made.mapping.collect()))


def test_command_line(spark, store_dir, capsys):
    args = ["--raw", str(store_dir / "raw"), "--work", str(store_dir / "work"), "--out", str(store_dir / "out"), "--config", str(store_dir / "c.toml")]
    assert cli.main(["chats", *args], spark) == 0
    assert cli.main(["run", *args], spark) == 0
    out = store_dir / "out"
    assert {p.name for p in out.iterdir() if not p.name.startswith(".")} == {"messages", "episodes", "users", "chats", "transcripts", "chunks", "index", "manifest.json", "README.md"}
    assert json.loads((out / "manifest.json").read_text())["messages"] == 9
    assert json.loads((store_dir / "work" / "report.json").read_text())["rules"] and (store_dir / "work").stat().st_mode & 0o077 == 0
    assert not (store_dir / "out.old").exists() and not (store_dir / "out.staging").exists()
    assert len([p for p in (out / "chunks").iterdir() if p.name.startswith("chunk=")]) == 1
    assert cli.main(["verify", *args[:-1], str(store_dir / "missing.toml")], spark) == 1
    (store_dir / "out" / "extra.jsonl").write_text(json.dumps({"text": "ivan_petrov lives, Petrov too, at Romashka 79161234567"}) + "\n")
    assert cli.main(["verify", *args], spark) == 4
    kinds = json.loads((store_dir / "work" / "leaks.json").read_text())["by_kind"]
    assert {"username", "name", "title", "phone"} <= set(kinds)


def test_self_check_stops(spark, made):
    bad = made.units().limit(0).unionByName(spark.createDataFrame([("x:1", "write to a.b@example.com")], "location string, text string"))
    with pytest.raises(audit.LeakError):
        audit.self_check(bad, made.policy.anonymize, made.roster)
