import re

import pytest

from lakestrata.sources import ledger as led
from lakestrata.sources.config import DEFAULT_TABLES, identifier, load_config
from lakestrata.sources.landing import apply_lookback


@pytest.mark.parametrize("bad", ["customer; drop table x", "a b", "x'--", "updated_at) OR 1=1", "", "1a", "a\n"])
def test_unsafe_identifiers_are_rejected(bad):
    with pytest.raises(ValueError):
        identifier(bad)


def test_lookback():
    assert apply_lookback("2026-01-01 00:00:00") == "2025-12-31 23:00:00"
    assert apply_lookback("not-a-date") == "not-a-date"
    assert apply_lookback(None) is None


def test_batch_ids_fit_and_increase():
    ids = [led.build_batch_id("t" * 200) for _ in range(500)]
    assert len(set(ids)) == 500
    assert all(len(i) <= 50 for i in ids)
    suffixes = [int(i.rsplit(":", 1)[1]) for i in ids]
    assert suffixes == sorted(suffixes)
    assert re.fullmatch(r"\d{16}", ids[0].rsplit(":", 1)[1])
    assert led.build_batch_id("short").startswith("short:")


def test_config_overlay(tmp_path):
    path = tmp_path / "c.yml"
    path.write_text("source_name: shop\ntables:\n  - {name: a, bronze_table: oltp_a, watermark_column: updated_at}\n")
    cfg = load_config(str(path), {"INGESTION_SOURCE_NAME": "other", "X": "y"})
    assert cfg.source_name == "other"
    assert cfg.table("a").strategy == "incremental"
    with pytest.raises(ValueError):
        cfg.table("unmapped")
    assert len(load_config(env={}).tables) == len(DEFAULT_TABLES) == 20


def test_ledger_states_and_watermarks(spark, tmp_path):
    now = iter(f"2026-01-01 00:00:{i:02d}" for i in range(60))
    ledger = led.Ledger(spark, str(tmp_path), clock=lambda: next(now))
    assert led.last_watermark(ledger.frame(), "t") is None
    one = ledger.start("t", "oltp", "incremental_append", initiated_by="job")
    ledger.complete(one, 5, 5, "2025-12-01 00:00:00")
    two = ledger.start("t", "oltp", "incremental_append", initiated_by="job")
    ledger.complete(two, 0, 0, None)
    three = ledger.start("t", "oltp", "incremental_append", initiated_by="job")
    ledger.fail(three, "x" * 5000)
    four = ledger.start("t", "oltp", "incremental_append", initiated_by="job")
    other = ledger.start("t", "oltp", "incremental_append", initiated_by="someone")
    frame = ledger.frame()
    assert frame.count() == 5
    # an empty load carries no mark and does not hide the older one
    assert led.last_watermark(frame, "t") == "2025-12-01 00:00:00"
    assert len(frame.where(f"batch_key = {three.key}").first()["error_message"]) == 2000
    assert ledger.fail_open("job") == 1
    state = {r["batch_key"]: r["batch_status"] for r in ledger.frame().collect()}
    assert state[four.key] == "failed" and state[other.key] == "running"
    # a new process continues the numbering
    assert led.Ledger(spark, str(tmp_path)).start("u", "s", "l", initiated_by="j").key == other.key + 1


def test_two_ledgers_never_share_a_key(spark, tmp_path):
    a, b = (led.Ledger(spark, str(tmp_path)) for _ in range(2))
    keys = [x.start("t", "oltp", "full", initiated_by="job").key for x in (a, b, a, a, b)]
    assert keys == [1, 2, 3, 4, 5]
    assert a.frame().count() == 5


def test_a_crash_while_writing_blocks_nothing(spark, tmp_path):
    from lakestrata.sources.files import Files

    files = Files(spark, str(tmp_path))
    (tmp_path / "1.json.writing").write_text("half")
    (tmp_path / "1.json.0.writing").write_text("half")
    files.create_text(str(tmp_path / "1.json"), "whole")
    assert files.read_text(str(tmp_path / "1.json")) == "whole"
    with pytest.raises(FileExistsError):
        files.create_text(str(tmp_path / "1.json"), "again")
