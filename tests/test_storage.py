"""Scopes, versions, partition upserts, streaming, publishing."""

import pytest
from match_rows import rows
from pyspark.sql import functions as F

from matchlake.sources import journal, storage
from matchlake.streaming import incremental


def table(spark, data):
    return spark.createDataFrame(data, "id bigint, v string, d string").selectExpr(
        "id", "v", "CAST(d AS DATE) AS _fixture_date", "CAST(left(d, 4) AS INT) AS _season_id")


BASE = [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2025-01-03")]


def test_scopes(spark, tmp_path):
    base = table(spark, BASE)
    path = str(tmp_path / "s")
    storage.replace_scope(spark, path, base.drop("_fixture_date"), "season")
    storage.replace_scope(spark, path, table(spark, [(9, "z", "2024-05-05")]).drop("_fixture_date"), "season")
    assert rows(spark.read.parquet(path).select("id", "_season_id")) == [(3, 2025), (9, 2024)]
    path = str(tmp_path / "d")
    storage.replace_scope(spark, path, base.drop("_season_id"), "date", "2000-01-01", "2030-01-01")
    storage.replace_scope(spark, path, table(spark, [(8, "y", "2024-01-02")]).drop("_season_id"), "date", "2024-01-01", "2024-01-02")
    assert rows(spark.read.parquet(path).select("id")) == [(3,), (8,)]
    storage.replace_scope(spark, path, base, "global")
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (2,), (3,)]


def test_date_window_keeps_what_lies_outside(spark, tmp_path):
    path = str(tmp_path / "d")
    base = table(spark, [(1, "a", "2024-01-01"), (2, "b", None), (3, "c", None), (4, "d", "2024-02-01"), (5, "e", "2024-02-01")]).drop("_season_id")
    storage.replace_scope(spark, path, base, "date", "2000-01-01", "2030-01-01")
    batch = table(spark, [(10, "x", "2024-01-01"), (11, "y", None), (12, "z", "2024-02-01")]).drop("_season_id")
    storage.replace_scope(spark, path, batch, "date", "2024-01-01", "2024-01-02")
    assert rows(storage.stored(spark, path, base.schema).select("id")) == [(10,), (11,), (12,), (2,), (3,), (4,), (5,)]


def test_season_with_an_empty_reload_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    base = table(spark, BASE).drop("_fixture_date")
    storage.replace_scope(spark, path, base, "season")
    storage.replace_scope(spark, path, base.limit(0), "season", seasons=[2025])
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (2,)]
    storage.replace_scope(spark, path, storage.stored(spark, path, base.schema).filter("id = 2"), "season", seasons=[2024])
    assert rows(spark.read.parquet(path).select("id")) == [(2,)]


def test_partition_upsert_with_null_and_text_partitions(spark, tmp_path):
    path = str(tmp_path / "n")
    make = lambda data: spark.createDataFrame(data, "id bigint, v string, p string")
    storage.upsert_partitions(spark, path, make([(1, "a", "01"), (2, "b", None), (3, "c", None)]), ["id"], "p")
    storage.upsert_partitions(spark, path, make([(8, "h", "01"), (9, "i", None)]), ["id"], "p")
    storage.upsert_partitions(spark, path, make([(3, "C", None)]), ["id"], "p")
    got = storage.stored(spark, path, make([]).schema)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", "01"), (2, "b", None), (3, "C", None), (8, "h", "01"), (9, "i", None)], key=str)


def test_moving_rows_leave_their_old_partition(spark, tmp_path):
    path = str(tmp_path / "m")
    make = lambda data: spark.createDataFrame(data, "id bigint, v string, p int")
    storage.upsert_partitions(spark, path, make([(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", None), (5, "e", 3)]), ["id"], "p")
    storage.upsert_partitions(spark, path, make([(2, "B", 1), (3, "C", 9), (4, "D", 1)]), ["id"], "p", moving=True)
    assert rows(storage.stored(spark, path, make([]).schema)) == [(1, "a", 1), (2, "B", 1), (3, "C", 9), (4, "D", 1), (5, "e", 3)]
    assert sorted(p.name for p in (tmp_path / "m").iterdir() if p.is_dir()) == ["p=1", "p=3", "p=9"]


def test_stream_rewrites_touched_partitions_only(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    table(spark, BASE).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    go = lambda: incremental.stream_upsert_partitions(spark, incremental.landed_stream(spark, src, schema, files_per_batch=1), out,
                                                      ["id"], "_season_id", str(tmp_path / "progress"))
    go()
    untouched = sorted(p.name for p in (tmp_path / "out" / "_season_id=2025").iterdir())
    table(spark, [(2, "new", "2024-01-02"), (7, "g", "2024-01-07")]).coalesce(1).write.mode("append").parquet(src)
    go()
    assert rows(spark.read.parquet(out).select("id", "v")) == [(1, "a"), (2, "new"), (3, "c"), (7, "g")]
    assert untouched == sorted(p.name for p in (tmp_path / "out" / "_season_id=2025").iterdir())


def test_versions(spark, tmp_path):
    t = storage.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.upsert(table(spark, BASE), "id")
    t.upsert(table(spark, [(2, "B", "2024-01-02"), (4, "d", "2024-01-04")]), "id")
    assert t.version() == 2
    assert rows(t.read().select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    (tmp_path / "t" / "v=00000003").mkdir()  # an unfinished version is not seen
    assert t.version() == 2


def test_partition_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    storage.write_table(table(spark, BASE).select("id", "v", "_season_id"), path, ["_season_id"])
    untouched = sorted(p.name for p in (tmp_path / "p" / "_season_id=2025").iterdir())
    batch = table(spark, [(2, "B", "2024-01-02"), (5, "e", "2024-03-03")]).select("id", "v", "_season_id")
    storage.upsert_partitions(spark, path, batch, ["id"], "_season_id")
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (5, "e")]
    assert untouched == sorted(p.name for p in (tmp_path / "p" / "_season_id=2025").iterdir())


def test_stream_equals_batch_and_survives_restart(spark, tmp_path):
    src, out = str(tmp_path / "in"), storage.VersionedTable(spark, str(tmp_path / "out"))
    table(spark, BASE).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    go = lambda: incremental.stream_upsert(spark, incremental.landed_stream(spark, src, schema, files_per_batch=1), out, ["id"],
                                           str(tmp_path / "ckpt"), lambda df: df.withColumn("v", F.upper("v")))
    go()
    first = out.version()
    table(spark, [(2, "new", "2024-01-02"), (7, "g", "2024-01-07")]).coalesce(1).write.mode("append").parquet(src)
    go()
    assert rows(out.read().select("id", "v")) == [(1, "A"), (2, "NEW"), (3, "C"), (7, "G")]
    go()
    assert out.version() == first + 1


def test_publish(spark, tmp_path):
    t = table(spark, BASE)
    counts = storage.publish(spark, {"gold.a": t, "silver.b": t.limit(1)}, str(tmp_path / "pub"), schemas=["gold"])
    assert rows(counts) == [("gold.a", 3)]


def test_shared_folder_comes_from_the_session(spark):
    assert storage.workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


class Lost(Exception):
    pass


def failing_at(monkeypatch, step, times=1):
    """The writer is lost after the given step has been done so many times."""
    left = [times]

    def lose(done):
        if done == step:
            left[0] -= 1
            if left[0] == 0:
                raise Lost(step)
    monkeypatch.setattr(journal, "watch", lose)


STEPS = [("staged", 1, "old"), ("journaled", 1, "new"), ("dropped", 1, "new"), ("cleared", 1, "new"), ("moved", 1, "new"), ("cleared", 2, "new"),
         ("moved", 2, "new")]


@pytest.mark.parametrize("step, times, result", STEPS)
def test_lost_partition_swap_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, times, result):
    path = str(tmp_path / "s")
    base = table(spark, [*BASE, (4, "d", "2026-01-01")]).drop("_fixture_date")
    storage.replace_scope(spark, path, base, "season")
    batch = table(spark, [(8, "x", "2024-05-05"), (9, "y", "2025-05-05")]).drop("_fixture_date")
    failing_at(monkeypatch, step, times)
    with pytest.raises(Lost):
        storage.replace_scope(spark, path, batch, "season", seasons=[2024, 2025, 2026])
    monkeypatch.setattr(journal, "watch", lambda done: None)
    want = [(1,), (2,), (3,), (4,)] if result == "old" else [(8,), (9,)]
    assert rows(storage.stored(spark, path, base.schema).select("id")) == want
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s"]  # neither journal nor staged files stay
    storage.replace_scope(spark, path, batch, "season", seasons=[2024, 2025, 2026])
    assert rows(storage.stored(spark, path, base.schema).select("id")) == [(8,), (9,)]


@pytest.mark.parametrize("step", ["staged", "journaled", "cleared", "moved"])
def test_lost_global_swap(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "g")
    base = table(spark, BASE)
    storage.replace_scope(spark, path, base, "global")
    failing_at(monkeypatch, step)
    with pytest.raises(Lost):  # the batch reads the table that it replaces
        storage.replace_scope(spark, path, storage.stored(spark, path, base.schema).filter("id > 1"), "global")
    monkeypatch.setattr(journal, "watch", lambda done: None)
    assert rows(storage.stored(spark, path, base.schema).select("id")) == ([(1,), (2,), (3,)] if step == "staged" else [(2,), (3,)])


@pytest.mark.parametrize("step, times, result", STEPS[:2] + STEPS[3:])
def test_lost_publication_switches_all_tables_or_none(spark, tmp_path, monkeypatch, step, times, result):
    target = str(tmp_path / "pub")
    t = table(spark, BASE)
    storage.publish(spark, {"gold.a": t, "gold.b": t}, target)
    failing_at(monkeypatch, step, times)
    with pytest.raises(Lost):
        storage.publish(spark, {"gold.a": t.limit(1), "gold.b": t.limit(2)}, target)
    monkeypatch.setattr(journal, "watch", lambda done: None)
    storage.recover_published(spark, target)
    assert [spark.read.parquet(f"{target}/gold/{n}").count() for n in "ab"] == ([3, 3] if result == "old" else [1, 2])


def test_replayed_batch_is_skipped_or_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    make = lambda data: spark.createDataFrame(data, "id bigint, v string, p int")
    once = lambda batch, number: incremental.upsert_once(spark, make(batch), number, path, ["id"], "p", "stream")
    assert once([(1, "a", 1), (2, "b", 2)], 0)
    assert not once([(1, "other", 1)], 0)
    assert once([(1, "a", 2)], 1)  # moves to another partition
    failing_at(monkeypatch, "cleared")
    with pytest.raises(Lost):
        once([(2, "B", 2)], 2)
    monkeypatch.setattr(journal, "watch", lambda done: None)
    assert not once([(2, "twice", 2)], 2)  # decided before the failure: it is finished, not done again
    failing_at(monkeypatch, "staged")
    with pytest.raises(Lost):
        once([(3, "c", 3)], 3)
    monkeypatch.setattr(journal, "watch", lambda done: None)
    assert once([(3, "c", 3)], 3)
    assert rows(storage.stored(spark, path, make([]).schema)) == [(1, "a", 2), (2, "B", 2), (3, "c", 3)]


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_packed_files_are_not_taken_for_small_tables(spark, tmp_path):
    """Rows that compress well look small to a plan; a broadcast holds them unpacked in the driver."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    rows_ = session.range(0, 600_000, 1, 2).selectExpr("id", "id + 1 AS sk", "'one name' AS name")
    rows_.write.parquet(str(tmp_path / "dim"))
    session.range(100).write.parquet(str(tmp_path / "small"))
    storage.configure(session)
    dim, small = session.read.parquet(str(tmp_path / "dim")), session.read.parquet(str(tmp_path / "small"))
    fact = session.read.parquet(str(tmp_path / "dim")).withColumnRenamed("id", "k").select("k")
    assert broadcasts(fact.join(dim.select("id", "sk"), fact.k == dim.id, "left")) == 0
    assert broadcasts(fact.join(small, fact.k == small.id, "left")) == 1
    assert session.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == str(10 << 20)


def test_a_stricter_broadcast_limit_stays(spark):
    session = spark.newSession()
    for limit in ("-1", "1000"):
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        storage.configure(session)
        assert session.conf.get("spark.sql.autoBroadcastJoinThreshold") == limit


def test_rows_stay_where_they_are_made(spark, tmp_path):
    rows_ = spark.range(0, 1000, 1, 3).selectExpr("id", "CAST(id % 2 AS INT) AS part")
    for rebalance in (True, False):
        path = str(tmp_path / f"t{rebalance}")
        storage.replace_table(spark, path, rows_, ["part"], rebalance=rebalance)
        assert spark.read.parquet(path).exceptAll(rows_).isEmpty() and spark.read.parquet(path).count() == 1000
    written = [f.name for f in (tmp_path / "tFalse").rglob("*.parquet")]
    assert len(written) == 6 and all(".zstd." in n for n in written)
