import datetime as dt
import os

import pytest

from strata.operators import quality
from strata.operators.incremental import ConcurrentUpdate, SnapshotTable

SCHEMA = "id string, d date, v int, upd timestamp, ext timestamp, _loaded_at timestamp"


def T(s):
    return dt.datetime.fromisoformat(s)


def rows(t):
    return sorted((r.id, r.d.day if r.d else None, r.v) for r in t.read().collect())


def test_create_then_merge(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    assert not t.exists()
    b1 = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, None, T("2024-01-02"), None),
                                ("b", dt.date(2024, 1, 2), 1, None, T("2024-01-02"), None),
                                ("c", dt.date(2024, 1, 3), 1, None, T("2024-01-02"), None)], SCHEMA).drop("_loaded_at")
    t.upsert(b1, hw_column="ext")
    b2 = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2, None, T("2024-01-03"), None),
                                ("d", dt.date(2024, 1, 4), 2, None, T("2024-01-03"), None),
                                ("x", dt.date(2024, 1, 4), 9, None, T("2024-01-01"), None)], SCHEMA).drop("_loaded_at")
    info = t.upsert(b2, hw_column="ext")
    # matched replaced, unmatched inserted, nothing deleted, stale stamp skipped
    assert rows(t) == [("a", 1, 2), ("b", 2, 1), ("c", 3, 1), ("d", 4, 2)]
    m = t.current()
    assert m["partitions"]["2024-01-02"] == 1 and m["partitions"]["2024-01-01"] == 2
    assert sorted(info["partitions"]) == ["2024-01-01", "2024-01-04"]
    # older versions are never overwritten in place
    assert os.path.isdir(tmp_path / "t" / "snapshot_version=000001" / "d=2024-01-01")
    # a source with nothing newer is a no-op
    assert t.upsert(b1, hw_column="ext")["rows"] == 0


def test_key_moves_partition(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    t.upsert(spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, None, T("2024-01-02"), None)], SCHEMA).drop("_loaded_at"), hw_column="ext")
    t.upsert(spark.createDataFrame([("a", dt.date(2024, 1, 5), 2, None, T("2024-01-03"), None)], SCHEMA).drop("_loaded_at"), hw_column="ext")
    assert rows(t) == [("a", 5, 2)]
    assert "2024-01-01" not in t.current()["partitions"]


def test_loaded_at_keeps_late_and_newer(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    order = [("upd", "desc"), ("ext", "desc")]
    kw = dict(mode="loaded_at", hw_column="ext", order=order)
    t.upsert(spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, T("2024-01-01 05:00"), T("2024-01-02"), T("2024-01-02 06:00"))], SCHEMA), **kw)
    # late file: same extraction stamp, loaded later -> kept; an older update of "a" must not win
    t.upsert(spark.createDataFrame([("b", dt.date(2024, 1, 1), 1, T("2024-01-01 01:00"), T("2024-01-02"), T("2024-01-02 07:00")),
                                    ("a", dt.date(2024, 1, 1), 0, T("2024-01-01 04:00"), T("2024-01-02"), T("2024-01-02 07:00"))],
                                   SCHEMA), **kw)
    assert rows(t) == [("a", 1, 1), ("b", 1, 1)]
    assert "_loaded_at" not in t.read().columns


def test_null_partition_value(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    t.upsert(spark.createDataFrame([("a", None, 1, None, T("2024-01-02"), None)], SCHEMA).drop("_loaded_at"), hw_column="ext")
    t.upsert(spark.createDataFrame([("a", None, 2, None, T("2024-01-03"), None)], SCHEMA).drop("_loaded_at"), hw_column="ext")
    assert rows(t) == [("a", None, 2)]


def _write(spark, ids, day=1, v=1):
    return spark.createDataFrame([(i, dt.date(2024, 1, day), v, None, T("2024-01-02"), None) for i in ids], SCHEMA)


def test_interleaved_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """B commits between A's read of the table and A's commit: both merges are kept."""
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    t.upsert(_write(spark, ["a"]), mode="newer")
    plain, done = SnapshotTable._write_version, []

    def slow(self, df, version):
        if not done:
            done.append(1)
            SnapshotTable(spark, t.root, key="id", partition_by="d").upsert(_write(spark, ["c"]), mode="newer")
        return plain(self, df, version)

    monkeypatch.setattr(SnapshotTable, "_write_version", slow)
    t.upsert(_write(spark, ["b"]), mode="newer")
    assert [r[0] for r in rows(t)] == ["a", "b", "c"]


@pytest.mark.parametrize("how", ["replace", "replace_partitions"])
def test_a_rebuild_on_an_old_state_fails(spark, tmp_path, monkeypatch, how):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    t.upsert(_write(spark, ["a"]), mode="newer")
    plain, done = SnapshotTable._write_version, []

    def slow(self, df, version):
        if not done:
            done.append(1)
            SnapshotTable(spark, t.root, key="id", partition_by="d").upsert(_write(spark, ["c"]), mode="newer")
        return plain(self, df, version)

    monkeypatch.setattr(SnapshotTable, "_write_version", slow)
    with pytest.raises(ConcurrentUpdate):
        t.replace(_write(spark, ["z"])) if how == "replace" else t.replace_partitions(_write(spark, ["z"]), ["2024-01-01"])
    assert [r[0] for r in rows(t)] == ["a", "c"]
    t.replace(_write(spark, []))
    assert rows(t) == []


def test_superseded_manifests_claims_and_folders_go(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d", keep_versions=2)
    for n in range(6):
        t.upsert(_write(spark, [f"k{n}"], day=1 + n % 2, v=n), mode="newer")
    names = sorted(os.listdir(tmp_path / "t" / "_manifest"))
    assert [n for n in names if n.endswith(".json")] == ["v=000005.json", "v=000006.json"]
    assert len([n for n in names if n.endswith(".claim")]) <= 3
    folders = sorted(n for n in os.listdir(tmp_path / "t") if n.startswith("snapshot"))
    assert folders == [f"snapshot_version={v:06d}" for v in (4, 5, 6)]
    assert sorted(r[0] for r in rows(t)) == [f"k{n}" for n in range(6)]


def test_written_rows_are_observed(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    assert t.replace(_write(spark, ["a", "b", "c"]))["rows"] == 3
    assert t.replace_partitions(_write(spark, ["x"]), ["2024-01-01"])["rows"] == 1
    assert t.replace(_write(spark, []))["rows"] == 0
    one = SnapshotTable(spark, str(tmp_path / "u"))
    assert one.replace(_write(spark, ["a", "b"]))["rows"] == 2 and one.replace(_write(spark, []))["rows"] == 0


def test_a_merge_shuffles_few_keys_of_the_table(spark, tmp_path):
    """The keys of a small batch are looked for behind a range and a Bloom filter at the scan."""
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    big = spark.range(20_000).selectExpr("concat('k', id) AS id", "date_add(date'2024-01-01', cast(id % 5 as int)) AS d", "1 AS v",
                                         "cast(null as timestamp) AS upd", "timestamp'2024-01-02' AS ext", "cast(null as timestamp) AS _loaded_at")
    t.upsert(big, mode="newer")
    batch = big.where("id in ('k7', 'k4321', 'k19999')").selectExpr("id", "date'2024-01-09' AS d", "2 AS v", "upd", "ext", "_loaded_at")
    found = t.candidates(batch.select("id"), 3)
    assert {"k7", "k4321", "k19999"} <= {r.id for r in found.collect()} and found.count() < 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,k19999)" in plan and "LessThanOrEqual(id,k7)" in plan and "Exchange" not in plan
    t.upsert(batch, mode="newer")
    assert t.read().count() == 20_000 and t.read().where("d = date'2024-01-09'").count() == 3


@pytest.mark.parametrize("kind", ["string", "bigint", "date", "timestamp", "decimal(20,3)", "double", "boolean"])
def test_key_filter_keeps_every_key(spark, kind):
    from strata.operators.bloom import key_filter
    to = {"date": "date_add(date'1969-12-01', cast(id as int))", "timestamp": "timestamp_seconds(id * 1000 - 500)",
          "boolean": "id % 2 = 0"}.get(kind, f"cast(id as {kind})")
    rows_ = spark.range(500).selectExpr(f"{to} AS k", "cast(id % 3 as int) AS j")
    keys = rows_.where("j = 1").unionByName(rows_.limit(1).selectExpr(f"cast(null as {kind}) AS k", "j"))
    kept = rows_.where(key_filter(keys, ["k", "j"], 170))
    assert kept.join(keys, ["k", "j"], "left_semi").count() == rows_.join(keys, ["k", "j"], "left_semi").count()
    assert rows_.where(key_filter(keys.limit(0), ["k", "j"], 0)).count() == 0


def test_quality_checks_pass_and_fail(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (3, 10)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,), (None,)], "k int")
    assert quality.not_null(child, "fk").count() == 1
    assert quality.not_null(child, "id").isEmpty()
    assert [tuple(r) for r in quality.unique(child, "id").collect()] == [(3, 2)]
    assert quality.unique(parent, "k").isEmpty()  # NULL keys ignored
    assert [r.fk for r in quality.relationships(child, "fk", parent, "k").collect()] == [99]
    g = quality.grain(child.union(child.limit(0)), ["id", "fk"])
    assert g.isEmpty()
    assert quality.grain(child.union(child.where("id = 1")), ["id", "fk"]).count() == 1
    nc = quality.null_counts(child, ["id", "fk"]).first()
    assert (nc.id_nulls, nc.fk_nulls) == (0, 1)
    res = quality.run_checks([quality.Check("nn", "c", lambda ts: quality.not_null(ts["c"], "fk"), "fk")], {"c": child})
    assert res[0].failures == 1 and not res[0].passed and len(res[0].sample) == 1


def test_key_that_moves_partition_stays_one_row(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d", keep_versions=2)
    row = lambda i, day, v, ext: (i, day, v, None, T(ext), None)
    for step in range(1, 6):
        t.upsert(spark.createDataFrame([row("a", dt.date(2024, 1, step), step, f"2024-01-0{step + 1}"),
                                        row(f"k{step}", dt.date(2024, 1, 1), step, f"2024-01-0{step + 1}")], SCHEMA)
                 .drop("_loaded_at"), hw_column="ext")
    got = {r[0]: r for r in rows(t)}
    assert got["a"][1:3] == (5, 5) and len(got) == 6 and len(rows(t)) == 6
    from strata import fs
    assert not fs.list_dirs(spark, f"{t.root}/_staging")
    assert len(fs.list_dirs(spark, t.root)) <= 2 + 4  # superseded versions are gone


def test_second_writer_of_a_version_fails(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id", partition_by="d")
    t.upsert(spark.createDataFrame([("a", dt.date(2024, 1, 1), 1, None, T("2024-01-02"), None)], SCHEMA).drop("_loaded_at"), hw_column="ext")
    from strata import fs
    version = t._claim()
    with pytest.raises(Exception):
        fs.write_text(spark, f"{t._manifest_dir()}/v={version:06d}.claim", "", overwrite=False)
    assert t._claim() == version + 1 and len(rows(t)) == 1


def test_whole_number_high_water(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), key="id")
    up = lambda *r: t.upsert(spark.createDataFrame(list(r), "id string, v int, n bigint"), hw_column="n")
    up(("a", 1, 9), ("b", 1, 10))
    up(("a", 2, 10), ("b", 2, 11), ("c", 2, 100))
    up(("a", 3, 20))
    assert sorted((r.id, r.v) for r in t.read().collect()) == [("a", 1), ("b", 2), ("c", 2)]
