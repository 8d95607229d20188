"""What the driver calls."""

import __spark_entry__ as entry
from helpers import make_tables


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_the_training_data_operators(monkeypatch):
    monkeypatch.setattr(entry, "find_spec", lambda name: None)
    names = set(entry.queries())
    assert "segment_summary" in names and not [name for name in names if name.startswith("op") or name == "pipeline"]
    assert set(entry.oracle_sql()) == names


def test_inspected_sessions_can_be_written(spark, monkeypatch, tmp_path):
    sessions = [dict(session_id=10 * user + i, user_id=user, trip_id=user) for user in (1, 2, 3) for i in range(8)]
    tables = make_tables(spark, sessions, users=[dict(user_id=user) for user in (1, 2, 3)])
    monkeypatch.setattr(entry, "_tables", lambda *_: tables)
    found = entry.queries()["session_inspection"](spark, "")
    found.write.parquet(str(tmp_path / "found"))  # user 3 is not among the inspected ones
    rows = spark.read.parquet(str(tmp_path / "found")).select("user_id", "session_id").collect()
    assert sorted(map(tuple, rows)) == [(user, 10 * user + i) for user in (1, 2) for i in range(8)]
    assert found.columns == [name for name, _ in dict.fromkeys(entry.COLUMNS["session_inspection"])]
