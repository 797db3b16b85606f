"""Refresh from changes between versions, and quantiles across ranges."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from prospectra.operators import quantiles as Q
from prospectra.plans import incremental
from prospectra.session import new_path
from prospectra.sources.buckets import BucketTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def totals(parts):
    own = parts["facts"].groupBy(F.col("owner").alias("id")).agg(F.sum("n").alias("n"))
    return parts["owners"].join(own, "id", "left").select("id", "name", F.coalesce("n", F.lit(0)).alias("n"))


def test_refresh_equals_the_full_run_and_reads_changed_buckets(spark):
    pick = random.Random(1)
    owners, facts, result = (BucketTable(spark, new_path(spark, x)) for x in ("owners", "facts", "totals"))
    owners.create(spark.range(60).select("id", F.concat(F.lit("n"), "id").alias("name")), ["id"], 8)
    facts.create(spark.createDataFrame([(i, pick.randrange(60), pick.randrange(9)) for i in range(300)], "fact long, owner long, n long"), ["fact"], 8)
    full = lambda: totals({"owners": owners.read(), "facts": facts.read()})
    result.create(full(), ["id"], 8)
    facts.merge(spark.createDataFrame([(5, 7, 1000), (900, 3, 50), (901, None, 1)], "fact long, owner long, n long"))
    facts.change(spark.createDataFrame([(6,), (7,)], "fact long"), lambda old: old.filter("fact NOT IN (6, 7)"))
    owners.merge(spark.createDataFrame([(1000, "new"), (2, "renamed")], "id long, name string"))
    owners.change(spark.createDataFrame([(4,)], "id long"), lambda old: old.filter("id <> 4"))
    before = result.manifest()
    after = incremental.refresh({"owners": incremental.Input(owners, 1), "facts": incremental.Input(facts, 1, "owner")}, result, totals, new_path(spark, "ids"))
    assert rows(result.read()) == rows(full())
    assert all(after.folders[b] == f for b, f in before.folders.items() if int(b) not in after.touched)
    again = incremental.refresh({"owners": incremental.Input(owners, owners.manifest().version), "facts": incremental.Input(facts, facts.manifest().version, "owner")}, result, totals, new_path(spark, "ids"))
    assert again.touched == [] and again.folders == after.folders


def test_changes_name_inserts_updates_and_deletes(spark):
    table = BucketTable(spark, new_path(spark, "changes"))
    table.create(spark.createDataFrame([(i, "x", None) for i in range(40)], "id long, v string, w long"), ["id"], 8)
    table.merge(spark.createDataFrame([(1, "x"), (2, "y"), (50, "z")], "id long, v string"))
    table.change(spark.createDataFrame([(3,)], "id long"), lambda old: old.filter("id <> 3"))
    assert rows(incremental.changes(table, 1, carry=("v",))) == [(2, "update", "x", "y"), (3, "delete", "x", None), (50, "insert", None, "z")]
    assert rows(incremental.changes(table, 2)) == [(3, "delete")]
    touched = incremental.touched_since(table, 2)
    assert len(touched) == 1 and len(table.read(None, touched).inputFiles()) <= 1


def test_exact_quantiles_across_ranges(spark):
    pick = random.Random(2)
    own = [(pick.choice(["hot", "hot", "hot", None, "b"]), pick.choice([None, pick.randrange(1000) / 4, 7.0])) for _ in range(3000)] + [("none", None), ("one", 5.0)]
    df = spark.createDataFrame(own, "g string, v double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: (r.q0, r.q1, r.q2, r.q3) for r in Q.quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 1.0]).collect()}
        whole = Q.quantiles(df, [], "v", [0.5]).first().q0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g in {g for g, v in own if v is not None}:
        values = sorted(v for k, v in own if k == g and v is not None)
        quarter = statistics.quantiles(values, n=4, method="inclusive")[0] if len(values) > 1 else values[0]
        assert got.pop(g) == pytest.approx((values[0], quarter, statistics.median(values), values[-1]))
    assert not got and whole == pytest.approx(statistics.median([v for _, v in own if v is not None]))


def test_sketched_quantiles_keep_their_bound(spark):
    pick = random.Random(3)
    own = [(k % 2, pick.gauss(0, 1) if k % 2 else pick.expovariate(1)) for k in range(20_000)]
    got = {r.g: list(r)[1:] for r in Q.sketched_quantiles(spark.createDataFrame(own, "g int, v double").repartition(6), ["g"], "v", [0.1, 0.5, 0.99]).collect()}
    for g, found in got.items():
        values = sorted(v for k, v in own if k == g)
        for p, x in zip((0.1, 0.5, 0.99), found):
            assert abs(sum(v <= x for v in values) / len(values) - p) < 1.7 / 1000 ** 0.9 + 1e-3
