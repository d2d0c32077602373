import json

import pytest

from recsense.sources import logs

FIELDS = "subject string, session int, annotated string"


def manifest(path, schema, trials):
    path.write_text(json.dumps({"schema": schema, "trials": trials}, indent=1))


def test_manifests_are_read_whole_and_missing_fields_are_null(spark, tmp_path):
    manifest(tmp_path / "one.json", 1, [{"subject": "p1", "session": 2, "annotated": "x.csv"}, {"session": 3, "annotated": "y.csv", "more": [1]}])
    manifest(tmp_path / "two.json", 1, [])
    got = sorted(tuple(r) for r in logs.scan_manifest(spark, str(tmp_path), FIELDS).collect() if r.subject) + [tuple(r) for r in logs.scan_manifest(spark, str(tmp_path), FIELDS).filter("subject is null").collect()]
    assert got == [("p1", 2, "x.csv"), (None, 3, "y.csv")]


@pytest.mark.parametrize("schema", [2, None])
def test_a_manifest_of_another_schema_is_refused(spark, tmp_path, schema):
    manifest(tmp_path / "one.json", 1, [])
    manifest(tmp_path / "two.json", schema, [])
    with pytest.raises(ValueError, match="schema"):
        logs.scan_manifest(spark, str(tmp_path), FIELDS)


NAMES = ["01_Time", "02_A"]


def log(path, rows, tail=""):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("01_Time,02_A" + tail + "\n" + "".join(f"{k},{v}{tail}\n" for k, v in enumerate(rows)))


def contents(table):
    return sorted((r.path[-17:], r["02_A"]) for r in table.read().collect())


def test_equal_names_in_two_sessions_survive_a_change_of_one(spark, tmp_path):
    raw, table = tmp_path / "raw", logs.Transcoded(spark, str(tmp_path / "cache"))
    one, two = raw / "20250101" / "log1.csv", raw / "20250102" / "log1.csv"
    log(one, range(5))
    log(two, range(10, 15), ",")
    assert table.refresh(str(raw), NAMES) == 2 and table.version() == 1
    assert table.refresh(str(raw), NAMES) == 0 and table.version() == 2
    log(one, range(6))
    assert table.refresh(str(raw), NAMES) == 1
    want = sorted([("20250101/log1.csv", float(v)) for v in range(6)] + [("20250102/log1.csv", float(v)) for v in range(10, 15)])
    assert contents(table) == want
    assert table.read(1).count() == 10  # an older snapshot stays as it was
    two.unlink()
    assert table.refresh(str(raw), NAMES) == 0
    assert contents(table) == want[:6]
    assert len(table.vacuum()) == 4 and contents(table) == want[:6]  # three manifests and the first part


def test_unchanged_files_are_not_opened(spark, tmp_path):
    raw, table = tmp_path / "raw", logs.Transcoded(spark, str(tmp_path / "cache"))
    log(raw / "s" / "a.csv", range(3))
    log(raw / "s" / "b.csv", range(3))
    table.refresh(str(raw), NAMES)
    import os

    kept = (raw / "s" / "a.csv").stat()
    (raw / "s" / "a.csv").write_text("x" * kept.st_size)  # would break the scan; same size and time
    os.utime(raw / "s" / "a.csv", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    log(raw / "s" / "b.csv", range(4))
    assert table.refresh(str(raw), NAMES) == 1
    assert table.read().count() == 7


def test_a_failed_run_and_a_second_writer_change_nothing(spark, tmp_path, monkeypatch):
    raw, table = tmp_path / "raw", logs.Transcoded(spark, str(tmp_path / "cache"))
    log(raw / "s" / "a.csv", range(3))
    table.refresh(str(raw), NAMES)
    log(raw / "s" / "a.csv", range(8))
    with monkeypatch.context() as m:
        m.setattr(logs, "scan_raw_csv", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.refresh(str(raw), NAMES)
    assert table.read().count() == 3
    late = logs.Transcoded(spark, str(tmp_path / "cache"))
    monkeypatch.setattr(late, "version", lambda: 1)
    table.refresh(str(raw), NAMES)
    with pytest.raises(RuntimeError, match="another writer"):
        late.refresh(str(raw), NAMES)
    assert table.version() == 2 and table.read().count() == 8


def test_an_empty_folder_has_an_empty_snapshot(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    table = logs.Transcoded(spark, str(tmp_path / "cache"))
    assert table.refresh(str(tmp_path / "raw"), NAMES) == 0 and table.manifest().count() == 0
    with pytest.raises(ValueError, match="no snapshot"):
        table.read()
