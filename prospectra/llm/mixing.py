"""Mixing sources to target weights along a curriculum.

Every source has a weight and a weight schedule over the training run. The weights share
the mix's words by water level: a source stops at a multiple of its own size, and what it
can't give is shared again by weight. A source's documents stand in hashed order and are
streamed as often as its target asks; the schedule is integrated to a cumulative demand,
and inverting the demand at the place where a copy of a document begins gives its training
position: copy n begins n times the source's size after the first. ``curriculum`` has a row
per copy, ``mix`` a row per document; both come out sorted by range of position.

All work is DataFrame and SQL functions. Running sums are built from sums per hashed
bucket, so no task holds a source. The one unpartitioned window has a row per source.

A null text has size 0. A null source is a source of its own, listed last. Documents
without words and mixes without words take nothing. Repeated rows take part one by one;
rows that agree in id and size are interchangeable. Columns beyond key, text and source
are left out. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from prospectra.llm.common import cut

WEIGHTS = (3, 1, 2)
#: Words of the mix per word of the sources, and the most of its own size that a source gives.
SHARE_PERCENT, MOST_TIMES = 150, 2
#: Weight schedules as (time, relative weight) knots, dealt to the sources in turn; each has the mean 1.
SCHEDULES = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)
#: Hexadecimal digits of the hash that name a bucket.
BUCKET_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def position_sql(schedule: tuple[tuple[float, float], ...], demand: str) -> str:
    """SQL for the time at which the integral of a schedule reaches a share of its total."""
    double = lambda x: f"CAST({x!r} AS DOUBLE)"
    whole = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))
    cases, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (w0 + w1) / 2 / whole
        rest = f"({demand} - {double(done)})"
        slope, level = (w1 - w0) / (t1 - t0) / 2 / whole, w0 / whole
        time = f"{double(t0)} + 2 * {rest} / ({double(level)} + SQRT(GREATEST({double(level * level)} + {double(4 * slope)} * {rest}, {double(0.0)})))"
        done += part
        cases.append(f"WHEN {demand} < {double(done)} THEN {time}")
        last = time
    return f"CASE {' '.join(cases)} ELSE {last} END"


def schedule_sql(rank: str, demand: str, schedules=SCHEDULES) -> str:
    """SQL for the training time of a demand share of the source with a rank."""
    cases = " ".join(f"WHEN {i} THEN {position_sql(s, demand)}" for i, s in enumerate(schedules))
    return f"ROUND(CASE {rank} % {len(schedules)} {cases} END, 9)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
            most_times: int = MOST_TIMES) -> DataFrame:
    """``source`` totals with ``rank``, ``weight`` and ``target``; columns ``_none, _source, source_size`` come in.

    Numerators stay whole numbers, so that the level doesn't depend on an order of summing.
    """
    listed = Window.orderBy("_none", "_source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    rows = totals.withColumn("rank", (F.row_number().over(listed) - 1).cast("long")).withColumn("weight", weight)
    # Sources by the level at which they are full: before each one, the earlier are full.
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    every = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("source_size").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    words = F.sum("source_size").over(every)
    rows = rows.select("*", (share_percent * words - 100 * most_times * full).alias("_left"), rest.alias("_rest"))
    capped = F.col("_left") * F.col("weight") > 100 * most_times * F.col("source_size") * F.col("_rest")
    rows = rows.withColumn("_capped", capped)
    open_left = F.first(F.when(~F.col("_capped"), F.col("_left")), True).over(every)
    open_rest = F.first(F.when(~F.col("_capped"), F.col("_rest")), True).over(every)
    rows = rows.select("*", open_left.alias("_open_left"), open_rest.alias("_open_rest"))
    level = (F.col("_open_left") * F.col("weight")).cast("double") / (100 * F.col("_open_rest"))
    target = F.when(F.col("_capped"), (most_times * F.col("source_size")).cast("double")).otherwise(level)
    return rows.select("_none", "_source", "source_size", "rank", "weight", target.alias("target"))


def placed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           weights: tuple[int, ...] = WEIGHTS, schedules=SCHEDULES, share_percent: int = SHARE_PERCENT,
           most_times: int = MOST_TIMES) -> DataFrame:
    """``key, source_rank, size, source_size, target, taken, copies`` of every row.

    ``copies`` has ``copy, words, position`` of each copy of which something is taken.
    """
    code = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    sizes = cut(docs.select(
        F.col(key).alias("_key"), F.col(source).isNull().alias("_none"), F.coalesce(F.col(source), F.lit("")).alias("_source"),
        code.alias("_code"), F.substring(code, 1, BUCKET_DIGITS).alias("_bucket"), word_count(F.col(text)).alias("size"),
    ), "mix-sizes")
    same = ["_none", "_source"]
    buckets = sizes.groupBy(*same, "_bucket").agg(F.sum("size").alias("_words"))
    levels = targets(buckets.groupBy(*same).agg(F.sum("_words").alias("source_size")), weights, share_percent, most_times)
    earlier = Window.partitionBy(*same).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    known = buckets.join(levels, same).drop("_words")
    within = Window.partitionBy(*same, "_bucket").orderBy("_code", "_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(known, [*same, "_bucket"])
    rows = rows.withColumn("_start", F.col("_before") + F.col("_inside")).withColumn("_goal", F.floor(F.col("target") + 0.5))

    def copy(n: int) -> Column:
        return F.least("size", F.greatest(F.col("_goal") - n * F.col("source_size") - F.col("_start"), F.lit(0))).cast("long")

    def share(n: int) -> Column:
        begin = (F.col("_start") + n * F.col("source_size")).cast("double")
        return F.try_divide(begin, F.col("_goal")).alias(f"_share_{n}")

    rows = rows.select("*", *(copy(n).alias(f"_words_{n}") for n in range(most_times)), *map(share, range(most_times)))
    taken = sum((F.col(f"_words_{n}") for n in range(most_times)), F.lit(0).cast("long"))
    copies = F.array_compact(F.array(*(
        F.when(F.col(f"_words_{n}") > 0, F.struct(
            F.lit(n).alias("copy"), F.col(f"_words_{n}").alias("words"), F.expr(schedule_sql("rank", f"_share_{n}", schedules)).alias("position"),
        )) for n in range(most_times)
    )))
    return rows.select(F.col("_key").alias(key), F.col("rank").alias("source_rank"), "size", "source_size", "target",
                       taken.alias("taken"), copies.alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``key, source_rank, size, source_size, target, taken, position, positions`` of every row, sorted by ranges of position.

    ``positions`` are the training times of a document's copies, ``position`` is that of the first, null if nothing is taken.
    """
    positions = F.col("copies.position")
    out = placed(docs, key, **options).select(
        key, "source_rank", "size", "source_size", "target", "taken", F.get(positions, F.lit(0)).alias("position"), positions.alias("positions"),
    )
    return out.repartitionByRange(F.col("position").asc_nulls_last(), key).sortWithinPartitions(F.col("position").asc_nulls_last(), key)


def curriculum(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``key, source_rank, copy, words, position`` of every copy taken, sorted by ranges of position."""
    out = placed(docs, key, **options).select(key, "source_rank", F.inline("copies"))
    order = ("position", key, "copy")
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


#: The mix of ``documents`` in SQL.
ORACLE_SQL = f"""
WITH sizes AS (
    SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS code,
           COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
totals AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
           ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes GROUP BY source),
weighed AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight FROM totals),
leveled AS (
    SELECT *, {SHARE_PERCENT} * SUM(source_size) OVER () - {100 * MOST_TIMES} * COALESCE(SUM(source_size) OVER (
               ORDER BY source_size / CAST(weight AS DOUBLE), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
           SUM(weight) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM weighed),
judged AS (SELECT *, remaining * weight > {100 * MOST_TIMES} * source_size * rest AS capped FROM leveled),
opened AS (
    SELECT arg_min(remaining, source_size / CAST(weight AS DOUBLE)) AS open_left,
           arg_min(rest, source_size / CAST(weight AS DOUBLE)) AS open_rest FROM judged WHERE NOT capped),
aimed AS (
    SELECT source, rank, source_size, CASE WHEN capped THEN CAST({MOST_TIMES} * source_size AS DOUBLE)
           ELSE CAST(open_left * weight AS DOUBLE) / CAST(100 * open_rest AS DOUBLE) END AS target FROM judged, opened),
placed AS (
    SELECT s.doc_id, s.size, a.rank, a.source_size, a.target, CAST(FLOOR(a.target + 0.5) AS BIGINT) AS goal,
           CAST(COALESCE(SUM(s.size) OVER (PARTITION BY s.source ORDER BY s.code, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM sizes s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
given AS (
    SELECT *, CAST(LEAST(size, GREATEST(goal - start, 0)) + LEAST(size, GREATEST(goal - source_size - start, 0)) AS BIGINT) AS taken,
           CAST(start AS DOUBLE) / goal AS share FROM placed)
SELECT doc_id, CAST(rank AS BIGINT) AS source_rank, CAST(size AS BIGINT) AS size, source_size, target, taken,
       CASE WHEN taken > 0 THEN {schedule_sql('rank', 'share')} END AS position FROM given
"""
