"""Every query against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from parlance import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def _rows(frame, columns):
    def plain(v):
        if pd.isna(v):
            return None
        return v.isoformat() if hasattr(v, "isoformat") else v.item() if hasattr(v, "item") else v

    return sorted((tuple(plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False, name=None)), key=repr)


#: Cases of all rules are tested without Spark in test_scrub; their queries are alike, so some are enough here.
NAMES = [n for i, n in enumerate(sorted(queries.ORACLES)) if not n.startswith("rule_") or i % 6 == 0]


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, db, name):
    got = queries.QUERIES[name](spark, DATA)
    want = db.execute(queries.ORACLES[name])
    names = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == names
    assert _rows(got.toPandas(), names) == _rows(want.df(), names)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_scrubbed_documents_are_clean(spark):
    rows = {r["state"]: r["leaks"] for r in queries.QUERIES["leak_scan_counts"](spark, DATA).collect()}
    assert rows["raw"] > 0 and rows["scrubbed"] == 0


def test_entry_points(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert __spark_entry__.entry(spark).columns == ["doc_id", "text", "n_hits"]


def _against_sql(spark, tmp_path, name, texts):
    """Rows of a documents query over `texts`, and what its SQL gives."""
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    frame.to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = sorted(d[0] for d in want.description)
    return _rows(queries.QUERIES[name](spark, str(tmp_path)).toPandas(), names), _rows(want.df(), names)


def test_card_runs_inside_hashes(spark, tmp_path):
    """A run that passes Luhn counts inside a hash, beside letters, and if its digits are all the same."""
    got, want = _against_sql(spark, tmp_path, "cards_masked_bin", ['token = "068c002651439458202064d35406d6b34bf01abe"', "a4111111111111111b 4111111111111111,4111111111111112", "0000000000000", None, ""])
    assert got == want and len(got) == 4


def test_check_column_agrees_with_scrubber_and_scanner(spark):
    """Texts that repeat, texts that change and texts that don't, in several batches."""
    from pyspark.sql import functions as F

    from parlance.functions.scrub import check_column, rules_column, scan_column, scrub_column, text_column

    raw = [None, "", "plain words", "пароль: Zx81kk", "to ann@example.org and ann@example.org", "+7 (916) 123-45-67", "<email> x", "x" * 300 + " ann@example.org"] * 3
    t = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, t string")
    one = t.select("i", "t", check_column(F.col("t")).alias("c"), text_column(F.col("t")).alias("shown"), rules_column(F.col("t")).alias("rules"))
    two = t.select("i", scrub_column(F.col("t")).alias("s"), scan_column(F.col("t")).alias("raw")).select("i", "s", "raw", scan_column(F.col("s.text")).alias("left"))
    for r in one.join(two, "i").collect():
        assert r["c"]["text"] == r["shown"] == r["s"]["text"] and r["rules"] == [h["rule"] for h in r["s"]["hits"]]
        assert r["c"]["kinds"] == sorted({x["kind"] for x in r["raw"]}) and (r["c"]["raw"], r["c"]["left_over"]) == (len(r["raw"]), len(r["left"]))
