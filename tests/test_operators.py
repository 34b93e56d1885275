from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from parlance.functions.scrub import Scrubber
from parlance.operators import audit, chats, identity, messages, render
from parlance.plans.policy import ChatFilter, Output
from parlance.sources import schemas, store
from parlance.streaming import ingest


def _messages(tmp_path, rows, name="log"):
    path = tmp_path / name
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(rows) + "\n")
    return str(path)


def test_message_log(spark, tmp_path):
    row = lambda i, text, edit=None: json.dumps({"chat_id": 1, "id": i, "date": "2024-01-01T00:00:00Z", "text": text} | ({"edit_date": edit} if edit else {}))
    path = _messages(tmp_path, [row(1, "a"), row(2, "b"), row(1, "c", "2024-01-02T00:00:00Z"), row(2, "b2"), '{"chat_id": 1, "id": 3, "da'])
    got = {r["id"]: r["text"] for r in store.read_messages(spark, path).collect()}
    assert got == {1: "c", 2: "b2"}


def test_object_file(spark, tmp_path):
    (tmp_path / "users.json").write_text(json.dumps({"7": {"id": 7, "first_name": "A", "is_bot": False, "usernames": ["x"]}}, indent=1))
    got = store.read_objects(spark, str(tmp_path / "users.json"), schemas.USER).collect()
    assert [(r["id"], r["first_name"], r["usernames"]) for r in got] == [(7, "A", ["x"])]


def test_inspections(spark):
    rows = spark.sql("select 1L me_id, 2L chat_id, timestamp'2024-01-01 00:00:00' inspected_at, cast(null as string) error union all select 1L, 3L, timestamp'2023-12-01 00:00:00', null")
    got = store.fresh_inspections(rows, 1, 24.0, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert [r["chat_id"] for r in got.collect()] == [2]


def test_private_json(tmp_path):
    store.write_private_json(tmp_path / "a" / "r.json", {"x": 1})
    assert json.loads((tmp_path / "a" / "r.json").read_text()) == {"x": 1}
    assert (tmp_path / "a" / "r.json").stat().st_mode & 0o777 == 0o600


def test_select_only(spark):
    c = spark.createDataFrame([(1, "group", "A", True, False, None), (2, "supergroup", "B", True, False, None), (3, "group", "C", True, False, 2)], "id long, kind string, title string, is_accessible boolean, is_archived boolean, migrated_to long")
    plan = chats.plan(c, ChatFilter())
    got, missing = chats.select_only(plan, [2, 9])
    assert sorted(r["id"] for r in got.collect()) == [2, 3] and missing == [9]
    assert [r["id"] for r in chats.ordered(plan).collect()][0] == 1


def test_code_flag_of_odd_texts(spark):
    """An empty text is covered by any code entity; without text or length the answer is unknown."""
    rows = spark.createDataFrame([("a", "", [("Pre", 0)]), ("b", "", [("Bold", 0)]), ("c", "abcd", [("Pre", 2)]), ("d", "abcde", [("Code", 2)]), ("e", "x", [("Pre", 0)]), ("f", None, [("Pre", None)]), ("g", "x", None)], "k string, text string, entities array<struct<type string, length int>>")
    got = {r["k"]: r["code"] for r in rows.select("k", messages.code_flag(F.col("text"), F.col("entities")).alias("code")).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False, "f": None, "g": None}


def test_id_allocation(spark):
    empty = spark.createDataFrame([], "kind string, raw_id bigint, vid string")
    one = identity.allocate_ids(empty, spark.range(1, 60).withColumnRenamed("id", "raw_id"), "U", digits=2)
    rows = one.collect()
    assert len(rows) == 59 and len({r["vid"] for r in rows}) == 59 and all(len(r["vid"]) == 3 for r in rows)
    kept = spark.createDataFrame(rows, one.schema)
    more = identity.allocate_ids(kept, spark.range(1, 80).withColumnRenamed("id", "raw_id"), "U").collect()
    assert {(r["raw_id"], r["vid"]) for r in rows} <= {(r["raw_id"], r["vid"]) for r in more} and len({r["vid"] for r in more}) == 79
    with pytest.raises(identity.MappingError):
        identity.allocate_ids(kept, spark.range(1, 200).withColumnRenamed("id", "raw_id"), "U")
    with pytest.raises(identity.MappingError):
        identity.check_mapping(spark.createDataFrame([("U", 1, "U12345"), ("U", 2, "U12345")], "kind string, raw_id long, vid string"))


def test_ids_that_outgrow_the_width(spark):
    """A new map takes a width that holds its ids; what it has given stays, and what is given later is new and no wider."""
    empty = spark.createDataFrame([], "kind string, raw_id bigint, vid string")
    one = identity.allocate_ids(empty, spark.range(200).withColumnRenamed("id", "raw_id"), "U", digits=2)
    rows = one.collect()
    assert len(rows) == 200 and len({r["vid"] for r in rows}) == 200 and all(len(r["vid"]) == 4 for r in rows)
    assert [r["vid"] for r in sorted(rows, key=lambda r: r["raw_id"])] != sorted(r["vid"] for r in rows)
    more = identity.allocate_ids(spark.createDataFrame(rows, one.schema), spark.range(900).withColumnRenamed("id", "raw_id"), "U").collect()
    assert {tuple(r) for r in rows} <= {tuple(r) for r in more} and {r["vid"] for r in more} == {f"U{n}" for n in range(100, 1000)}


def test_display_names():
    s, none = Scrubber(), frozenset()
    show = lambda first, last=None, mode="first", users=none, surnames=none: identity.display_name(first, last, mode, users, surnames, s)
    assert show("Иван Петров") == "Иван" and show("Vasya_Pupkin") == "" and show("Kotik", users=frozenset({"kotik"})) == ""
    assert show("Петров", surnames=frozenset({"петров"})) == "" and show("Anna", "Smith", "full") == "Anna Smith" and show("Anna", mode="none") == ""
    assert identity.is_label("Служба поддержки") and not identity.is_label("Иванов")


def test_episode_gap_is_strict(spark):
    rows = spark.sql("select 1 as c, 1 as i, timestamp'2024-01-01 00:00:00' as ts union all select 1, 2, timestamp'2024-01-01 06:00:00' union all select 1, 3, timestamp'2024-01-01 12:00:00.000001'")
    assert [r["episode"] for r in messages.episodes(rows, ["c"], ["ts", "i"], "ts").orderBy("i").collect()] == [1, 1, 2]


def test_hot_chat_is_numbered_over_ranges(spark, tmp_path):
    rows = spark.range(900).select(F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 5).alias("chat"), F.lit(1).alias("chat_id"), (F.col("id") * 37 % 900).alias("id"), (F.col("id") * 37 % 50).alias("date"), (F.col("id") % 3).alias("topic_id"))

    def persist(df, name):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    for forum in (None, F.col("chat") == 1):
        want = messages.sequence(rows, forum=forum).select("chat", "id", F.col("seq").cast("long")).collect()
        got = messages.sequence_skewed(rows, persist, forum=forum, partitions=7).select("chat", "id", "seq").collect()
        assert sorted(got) == sorted(want)


def test_parts_and_chunks(spark):
    rows = [("C1", e, e * 100 + i, "2024-01-01 10:00:00", "x" * 2000) for e in range(1, 4) for i in range(4)] + [("C2", 1, i, "2024-01-01 10:00:00", "y" * 3000) for i in range(7)]
    lines = spark.createDataFrame(rows, "chat string, episode int, seq int, date string, line string")
    parts = {(r["chat"], r["part"]): r["text"] for r in render.render_parts(lines, Output(max_chars=5)).collect()}
    assert sorted(parts) == [("C1", 1), ("C1", 2), ("C1", 3), ("C2", 1), ("C2", 2), ("C2", 3)]
    assert parts["C1", 2].startswith("# C1 (part 2 of 3)\n\n## Episode 2 - 2024-01-01 10:00 .. 10:00 (4 messages)\n\nxxx") and parts["C1", 2].endswith("x\n\n")
    assert [parts["C2", i].count("y" * 3000 + "\n") for i in (1, 2, 3)] == [3, 3, 1]  # an episode above the budget, by its messages
    whole = render.render_parts(lines, Output(max_chars=0)).collect()
    assert len(whole) == 2 and not any("part" in r["text"].split("\n")[0] for r in whole)
    chunks = render.pack_chunks(spark.createDataFrame([(i, 4000) for i in range(5)], "i int, n int"), ["i"], "n", 10_000)
    assert [r["chunk"] for r in chunks.orderBy("i").collect()] == [1, 1, 2, 2, 3]
    names = spark.createDataFrame([("C12345.part02.md",), ("chunk-001.md",), ("x.md",)], "n string")
    assert [r[0] for r in names.select(render.is_own_file_name(F.col("n"))).collect()] == [True, True, False]


def test_transcript(spark):
    schema = "chat string, episode int, seq int, date string, sender string, side string, role string, name string, text string, reply_to int, media_label string, forwarded string, action string, code boolean, continues boolean"
    day = "2024-01-01 10:0"
    long = " ".join(["word"] * 20)
    rows = [
        ("C1", 1, 1, day + "0:00", "U10001", "CLIENT", "client", "Ann", "  hello \n\n there ", None, None, None, None, False, False),
        ("C1", 1, 2, day + "1:00", "U10002", "STAFF", "support", "", "hi", 1, "[photo]", None, None, False, False),
        ("C1", 1, 3, day + "1:09", "U10002", "STAFF", "support", "", "a\nb", None, None, None, None, False, True),
        ("C1", 1, 4, day + "2:00", "U10003", "STAFF", "anonymous", "Bo", "x\ny", None, None, "U10001", None, True, False),
        ("C1", 1, 5, day + "3:00", None, "UNKNOWN", "system", None, None, 9, None, None, "pinned", False, False),
        ("C1", 1, 6, day + "4:00", "U10001", "CLIENT", "client", "Ann", long, None, None, None, None, False, False),
        ("C1", 1, 7, day + "5:00", "U10001", "CLIENT", "client", "Ann", " ", 6, None, None, None, False, False),
    ]
    m = spark.createDataFrame(rows, schema)
    got = [r["line"] for r in render.transcript_lines(m, Output()).orderBy("seq").collect()]
    assert got == [
        "[2024-01-01 10:00] #1 CLIENT U10001 Ann: hello \n    \n     there", '[2024-01-01 10:01] #2 STAFF U10002 (support) ↳#1 U10001 "hello ⏎ there": [photo] hi', "    #3: a\n    b",
        "[2024-01-01 10:02] #4 STAFF U10003 (anonymous admin) (forwarded from U10001):\n```\nx\ny\n```", "[2024-01-01 10:03] #5 SYSTEM ↳#9: [pinned]", f"[2024-01-01 10:04] #6 CLIENT U10001 Ann: {long}",
        f'[2024-01-01 10:05] #7 CLIENT U10001 Ann ↳#6 U10001 "{" ".join(["word"] * 11)}...": [empty]',
    ]
    split = [tuple(r["s"]) for r in spark.createDataFrame([(x,) for x in (got[1], "    #3: a", "[2024-01-01 10:02] #4 STAFF U10003 (support) (forwarded from U10001): x", "## Episode 1")], "l string").select(render.split_transcript_line(F.col("l")).alias("s")).collect()]
    assert split == [("[2024-01-01 10:01] #2 STAFF U10002 (support) ↳#1 U10001", "hello ⏎ there", "", "[photo] hi"), ("    #3", "", "", "a"), ("[2024-01-01 10:02] #4 STAFF U10003 (support)", "", "(forwarded from U10001)", "x"), ("", "", "", "## Episode 1")]


def test_shorten(spark):
    text = "alpha beta <url:shop.example.com> gamma delta epsilon"
    got = spark.createDataFrame([(text,), ("x" * 90,), ("short",)], "t string").select(render.shorten(F.col("t"), 40).alias("s")).collect()
    assert [r["s"] for r in got] == [f"alpha beta\n[... {len(text) - 17} chars omitted ...]\nepsilon", "x" * 30 + "\n[... 50 chars omitted ...]\n" + "x" * 10, "short"]


def test_audit_finds_plants(spark, tmp_path):
    (tmp_path / "messages.jsonl").write_text(json.dumps({"text": "fine", "sender": "U12345"}) + "\n" + json.dumps({"text": "mail a.b@example.com"}) + "\n")
    (tmp_path / "users.json").write_text(json.dumps({"U12345": {"name": "Ann"}}))
    (tmp_path / "t.md").write_text("10:00 U12345: tel +7 916 123-45-67\n")
    units = audit.file_units(spark, str(tmp_path))
    leaks = audit.scan_units(units)
    assert sorted(r["kind"] for r in leaks.collect()) == ["email", "phone"]
    counts, rows = audit.leak_report(leaks)
    assert {r["kind"]: r["n"] for r in counts.collect()} == {"email": 1, "phone": 1} and rows.count() == 2
    with pytest.raises(audit.LeakError) as e:
        audit.self_check(units)
    assert "example.com" not in str(e.value)
    assert audit.self_check(units.where("text = 'fine'")).count() == 1


def test_stream(spark, tmp_path):
    row = lambda i, text, edit=None: json.dumps({"chat_id": 1, "id": i, "date": "2024-01-01T00:00:00Z", "text": text} | ({"edit_date": edit} if edit else {}))
    path = _messages(tmp_path, [row(1, "a"), row(2, "b")])
    table, mark = str(tmp_path / "table"), str(tmp_path / "mark")
    run = lambda: ingest.start(ingest.message_stream(spark, path, schemas.MESSAGE), table, mark, ["chat_id", "id"], "edit_date", "date").awaitTermination(60)
    run()
    assert ingest.latest(spark, table).count() == 2
    _messages(tmp_path, [row(2, "b2", "2024-01-03T00:00:00Z"), row(3, "c"), row(1, "a")])
    run()
    assert {r["id"]: r["text"] for r in ingest.latest(spark, table).collect()} == {1: "a", 2: "b2", 3: "c"}
