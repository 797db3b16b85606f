"""Bucketed, versioned tables: merges in place, commits that exclude each other, claims that overlap."""

import threading

import pytest
from pyspark.sql import functions as F

from prospectra.functions.reviews import as_time
from prospectra.operators.merge import merge_upsert
from prospectra.session import new_path
from prospectra.sources.buckets import BucketTable, Conflict
from prospectra.sources.claims import STATE, claim


def made(spark, rows=200, buckets=8):
    table = BucketTable(spark, new_path(spark, "bucket-table"))
    table.create(spark.range(rows).select("id", F.lit("old").alias("v"), F.col("id").alias("w")), ["id"], buckets)
    return table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_merge_reads_and_rewrites_touched_buckets_only(spark):
    table = made(spark)
    before = table.manifest()
    source = spark.createDataFrame([(5, "new"), (1000, "new")], "id long, v string")
    after = table.merge(source, policies={"v": "overwrite"})
    assert after.version == 2 and set(after.touched) == {r[0] for r in source.select(F.pmod(F.hash("id"), F.lit(8))).collect()}
    for b, folder in after.folders.items():
        assert (folder != before.folders.get(b)) == (int(b) in after.touched)
    assert rows(table.read().filter("id <> 1000")) == [(i, "new" if i == 5 else "old", i) for i in range(200)]
    assert table.read().filter("id = 1000").first().v == "new"
    assert rows(table.read(1)) == [(i, "old", i) for i in range(200)]


def test_the_master_side_of_a_merge_is_not_shuffled(spark):
    table = made(spark)
    source = spark.range(10).select("id", F.lit("new").alias("v"))
    plan = merge_upsert(table.read(), source.repartition(8, "id"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "Bucketed: true" in plan


def test_writers_of_other_buckets_both_commit(spark):
    table = made(spark)
    a, b = (spark.createDataFrame([(i, "new")], "id long, v string") for i in (1, 2))
    assert a.select(F.pmod(F.hash("id"), F.lit(8))).first() != b.select(F.pmod(F.hash("id"), F.lit(8))).first()

    def overtaken(old):
        if table.manifest().version == 1:
            BucketTable(spark, table.root).merge(b)
        return merge_upsert(old, a.repartition(8, "id"), ["id"]).select("id", "v", "w")

    calls = []
    assert table.change(a, lambda old: calls.append(1) or overtaken(old)).version == 3 and len(calls) == 1
    assert rows(table.read().filter("v = 'new'").select("id")) == [(1,), (2,)]


def test_writers_of_the_same_bucket_work_anew_or_give_up(spark):
    table = made(spark)
    one = spark.createDataFrame([(1, 0)], "id long, w long")
    raised = lambda old: old.withColumn("w", F.when(F.col("id") == 1, F.col("w") + 10).otherwise(F.col("w")))
    other, calls = BucketTable(spark, table.root), []

    def overtaken(old, always):
        calls.append(1)
        if always or len(calls) == 1:
            other.change(one, raised)
        return raised(old)

    table.change(one, lambda old: overtaken(old, False))
    assert len(calls) == 2 and table.read().filter("id = 1").first().w == 21
    version = table.manifest().version
    with pytest.raises(Conflict):
        table.change(one, lambda old: overtaken(old, True), attempts=2)
    assert table.manifest().version == version + 2 and table.read().filter("id = 1").first().w == 41


def test_a_failed_commit_leaves_the_old_version(spark):
    table = made(spark)

    def fails(old):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table.change(spark.range(3), fails)
    broken = table.read().withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        table.change(spark.range(3), lambda old: broken)
    assert table.versions() == [1] and table.read().count() == 200


def test_only_one_of_many_commits_takes_a_name(spark):
    table = made(spark, 5, 2)
    name, won = f"{table.root}/versions/race.json", []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if table.store.put_absent(name, str(k)) else None) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and table.store.read(name) == str(won[0])
    assert table.store.names(f"{table.root}/versions") == ["00000000000000000001.json", "race.json"]


def test_overlapping_claims_grant_each_id_once(spark):
    root = new_path(spark, "claim-table")
    now = as_time("2026-01-15 12:00:00")
    BucketTable(spark, root).create(spark.createDataFrame([(1, "imported", None, "r0", None, None), (2, "failed", "x", "r0", None, None)], STATE), ["business_id"], 4)
    out = {}
    runs = [threading.Thread(target=lambda r=r, ids=ids: out.update({r: [x[0] for x in claim(BucketTable(spark, root), spark.createDataFrame([(i,) for i in ids], "business_id long"), r, now, attempts=20).collect()]}))
            for r, ids in (("a", [1, 2, 3, 4, 5, None]), ("b", [4, 5, 6, 7, 2]))]
    for t in runs:
        t.start()
    for t in runs:
        t.join()
    assert sorted(out["a"] + out["b"]) == [2, 3, 4, 5, 6, 7]
    state = {r.business_id: (r.status, r.run_id) for r in BucketTable(spark, root).read().collect()}
    assert all(state[i] == ("claimed", run) for run, ids in out.items() for i in ids) and state[1] == ("imported", "r0")
    assert [r[0] for r in claim(BucketTable(spark, root), spark.createDataFrame([(1,), (9,)], "business_id long"), "c", as_time("2026-01-15 13:00:00")).collect()] == [9]
    assert sorted(r[0] for r in claim(BucketTable(spark, root), spark.createDataFrame([(1,), (3,)], "business_id long"), "d", as_time("2026-01-15 20:00:00"), force=True).collect()) == [1, 3]
