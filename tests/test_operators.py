"""Reusable operators against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from prospectra.operators import collapse, coverage, match, merge, skew, topk


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_merge_policies_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", 1, ["x"], "keep"), (2, None, 2, None, "keep")], "id int, n string, s int, t array<string>, own string")
    source = spark.createDataFrame([(1, None, None, ["y", "x"]), (3, "c", 3, ["z"])], "id int, n string, s int, t array<string>")
    policies = {"n": "coalesce_new", "s": "overwrite", "t": "union_array"}
    expected = [(1, "a", None, ["x", "y"], "keep"), (2, None, 2, None, "keep"), (3, "c", 3, ["z"], None)]
    for small in (False, True):
        once = merge.merge_upsert(target, source, ["id"], policies, small_source=small)
        assert sorted((tuple(r) for r in once.collect()), key=lambda r: r[0]) == expected
        twice = merge.merge_upsert(once, source, ["id"], policies, small_source=small)
        assert sorted((tuple(r) for r in twice.collect()), key=lambda r: r[0]) == expected


def test_unknown_policy_is_refused(spark):
    df = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(ValueError):
        merge.merge_upsert(df, df, ["id"], {"v": "guess"})


def test_provenance_never_shrinks(spark):
    t = spark.createDataFrame([(1, ["a"])], "id int, s array<string>")
    s = spark.createDataFrame([(1, ["a", "b"]), (1, ["c"])], "id int, s array<string>").filter("size(s) = 2")
    out = merge.merge_upsert(t, s, ["id"], {"s": "append_array"}).first()["s"]
    assert out == ["a", "a", "b"]


@pytest.mark.parametrize("fallback", ["if_unmatched", "if_null"])
@pytest.mark.parametrize("hot", [0, 3])
def test_waterfall_against_brute_force(spark, fallback, hot):
    rng = random.Random(5)
    pick = lambda n: rng.choice([None, "hot", *[f"k{i}" for i in range(n)]])
    right = [(i, pick(5), pick(7), pick(9), rng.choice([None, 1, 5, 9])) for i in range(60)]
    left = [(i, pick(5), pick(7), pick(9)) for i in range(80)]
    ldf = spark.createDataFrame(left, "lid int, a string, b string, c string")
    rdf = spark.createDataFrame(right, "rid int, a string, b string, c string, w int")
    got = rows(match.waterfall_match(ldf, rdf, "lid", "rid", ["a", "b", "c"], [F.coalesce(-F.col("w"), F.lit(1))], fallback, hot),
               "lid", F.coalesce("matched_id", F.lit(-1)), F.coalesce("key_rank", F.lit(0)), F.coalesce("candidates", F.lit(0)))
    want = []
    for lid, *keys in left:
        answer = (lid, -1, 0, 0)
        for rank, key in enumerate(keys):
            if key is None:
                continue
            hits = [r for r in right if r[1 + rank] == key]
            if hits:
                best = min(hits, key=lambda r: (1 if r[4] is None else -r[4], r[0]))
                answer = (lid, best[0], rank + 1, len(hits))
                break
            if fallback == "if_null":
                break
        want.append(answer)
    assert got == sorted(want)


def test_salted_join_keeps_every_row(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        assert rows(skew.salted_join(big, lookup, ["k"], how, 2, 8), "id", "k", F.coalesce("v", F.lit(-1))) == \
            rows(big.join(lookup, "k", how), "id", "k", F.coalesce("v", F.lit(-1)))


def test_packed_chunks_are_the_sorted_rows(spark):
    """One key and the NULL key hold nearly all rows; chunk after chunk gives them in order."""
    pick = random.Random(1)
    own = [(pick.choice(["hot", "hot", None, None, "a", "b", f"k{i % 50}"]), pick.choice([None, "x", "y", f"v{i % 300:04d}"]), pick.randrange(40), i % 7) for i in range(4000)]
    df = spark.createDataFrame(own, "k string, s string, n int, v int").repartition(9)
    for limit in (1, 100, 333, 10_000):
        packed = skew.pack_rows(df if limit > 1 else df.limit(0).unionByName(df.filter("k = 'a'")), ["k"], ["s", "n"], ["v"], "items", limit)
        got = {}
        for r in sorted(packed.collect(), key=lambda r: r.chunk):
            got.setdefault(r.k, []).append([tuple(x) for x in r["items"]])
        order = lambda x: tuple((c is not None, c if c is not None else 0) for c in x)
        for key in {r[0] for r in own} if limit > 1 else {"a"}:
            chunks = got.pop(key)
            assert [x for c in chunks for x in c] == sorted((r[1:] for r in own if r[0] == key), key=order)
            assert all(len(c) == limit for c in chunks[:-1])
        assert not got


def test_best_or_none(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 7, "c"), (2, 1, "d")], "k int, s int, v string")
    assert rows(topk.best_or_none(df, ["k"], "s", "v"), "k", "s", F.coalesce("v", F.lit("-")), "tied") == [(1, 5, "-", 2), (2, 7, "c", 1)]


@pytest.mark.parametrize("newest_first, current, expected", [
    (["W", "W", "W", "H", "W"], "W", 3), (["W"] * 10, "W", 10), (["W"] * 14, "W", 10), (["H", "W", "W"], "W", 0),
])
def test_trailing_streak(spark, newest_first, current, expected):
    ticks = [(1, len(newest_first) - i, v) for i, v in enumerate(newest_first)]
    df = spark.createDataFrame(ticks, "f int, at int, verdict string")
    assert topk.trailing_streak(df, ["f"], "at", "verdict", "at", F.lit(current)).first()["streak"] == expected


def test_running_streak_over_chunk_borders(spark):
    rng = random.Random(3)
    data = [(k, s, rng.random() < 0.8) for k in (1, 2) for s in sorted(rng.sample(range(1000), 300))]
    got = rows(topk.running_streak(spark.createDataFrame(data, "k int, s int, f boolean"), "k", "s", "f", 17), "k", "s", "position", "streak")
    want, last, n, run = [], None, 0, 0
    for k, s, f in data:
        n, run = (1, int(f)) if k != last else (n + 1, run + 1 if f else 0)
        last = k
        want.append((k, s, n, run))
    assert got == sorted(want)


def test_collapse_takes_first_non_blank(spark):
    df = spark.createDataFrame([
        (1, "A", None, "", "b"), (2, "A", "", "555", "a"), (3, "A", None, "777", "b"), (4, "B", "x", None, None),
    ], "id int, name string, city string, phone string, cat string")
    out = collapse.collapse_listings(df, ["name", "city"], "id", ["phone"], "cat")
    assert rows(out, "name", "city", "phone", "categories", "source_row_count", "min_source_id") == [
        ("A", "", "555", ["a", "b"], 3, 1), ("B", "x", "", [], 1, 4)]


def test_group_cap_counts_working_groups(spark):
    geos = spark.createDataFrame([("g1", 1), ("g2", 2), ("g3", 3)], "geo_target string, position int")
    log = spark.createDataFrame([("t in g1", "s"), ("u in g1", "s"), (None, "s"), ("t in g2", "s")], "query string, service_category string")
    plan = coverage.plan_searches(geos, ["t", "u"], log, "s", "p", max_geo=1)
    assert rows(plan, "keyword") == [("u in g2",)]
    assert coverage.plan_searches(geos, ["t", "u"], log, "s", "p", force=True).count() == 6


def test_window_limit_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = merge.first_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_keys_are_spread_and_kept(spark):
    big = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"), F.lit("x").alias("a"))
    lookup = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = skew.salted_join(big, lookup, ["k"], "left", 1, 8)
    assert got.count() == 400 and got.filter("k IS NULL AND v IS NOT NULL").count() == 0
    assert got.filter("k IS NOT NULL AND v <> k * 10").count() == 0
    right = lookup.select(F.col("v").alias("rid"), "k")
    found = match.waterfall_match(big.select(F.col("id").alias("lid"), "k"), right, "lid", "rid", ["k"])
    assert found.count() == 400 and found.filter("matched_id IS NULL").count() == 200
    assert found.filter("key_rank IS NULL").count() == 200


def test_stream_decides_as_the_whole_log(spark):
    from prospectra.plans.health import decide
    from prospectra.session import new_path
    from prospectra.streaming.health import decide_stream
    verdicts = F.element_at(F.array(*map(F.lit, ("WEDGED", "WEDGED", "PROXY_DEGRADED", "HEALTHY"))), (F.floor(F.col("id") / 90) % 4 + 1).cast("int"))
    ticks = spark.range(720).select(
        F.col("id").alias("tick_id"), (F.col("id") % 5).alias("fleet"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 1800).alias("checked_at"),
        F.when((F.col("id") % 5 == 4) & (F.col("id") > 300), "WEDGED").otherwise(verdicts).alias("verdict"),
        F.when(F.col("id") % 97 == 0, "restart").when(F.col("id") % 89 == 0, "proxy_refresh").otherwise("none").alias("action"), (F.col("id") % 2 == 0).alias("action_ok"))
    ticks = ticks.filter("fleet <> 3 OR tick_id < 200")  # a fleet that falls silent for days keeps its decision
    source, log, state, out, mark = (new_path(spark, x) for x in ("t-in", "t-log", "t-state", "t-out", "t-mark"))
    ticks.repartitionByRange(4, "tick_id").write.parquet(source)
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(source)
    decide_stream(stream, log, state, out, mark, "fleet", 3).awaitTermination()
    after = spark.read.parquet(out)
    last = after.agg(F.max("batch")).first()[0]
    assert last == 3
    newest = spark.read.parquet(source).agg(F.max("checked_at").alias("m")).scalar()
    cols = ["fleet", "verdict", "streak", "since_restart", "since_refresh", "decision"]
    assert sorted(after.filter(F.col("batch") == last).select(*cols).collect()) == sorted(decide(ticks, "fleet", newest, F.lit(3)).select(*cols).collect())


def test_rows_are_dealt_to_tasks_of_bounded_size(spark):
    from prospectra.sources.tables import dealt
    rows = spark.range(100).withColumnRenamed("id", "k")
    assert dealt(rows, 100, "k", most=10).rdd.getNumPartitions() == 10
    assert dealt(rows, 101, "k", most=10).rdd.getNumPartitions() == 11 and dealt(rows, 100, "k").count() == 100
