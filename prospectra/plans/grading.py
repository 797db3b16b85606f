"""Answer grading, draft analysis aggregates and call usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import provider_of

# Rubric weights, minimum scores, pass mark.
RUBRIC = {"correctness": 0.35, "completeness": 0.20, "relevance": 0.15, "clarity": 0.15, "groundedness": 0.15}
MINIMUM = {"correctness": 3}
PASS_MARK = 3.5
TOKEN_FIELDS = ("prompt_tokens", "completion_tokens", "reasoning_tokens", "cached_tokens")


def weighted_score(scores: dict[str, Column]) -> Column:
    """Weighted mean of the rubric scores."""
    total = sum(RUBRIC.values())
    return sum((scores[c] * F.lit(w) for c, w in RUBRIC.items()), F.lit(0.0)) / F.lit(total)


def passes(scores: dict[str, Column], unmet: Column) -> Column:
    """True at the pass mark, with no criterion below its minimum and nothing unmet."""
    enough = F.lit(True)
    for criterion, low in MINIMUM.items():
        enough = enough & (scores[criterion] >= low)
    return (F.round(weighted_score(scores), 9) >= PASS_MARK) & enough & (unmet == 0)


def prefer_rewrite(first_unmet: Column, first_score: Column, second_unmet: Column, second_score: Column) -> Column:
    """True when the rewrite is returned: nothing unmet first, then the score, a tie to the rewrite."""
    first = F.struct((first_unmet == 0).cast("int").alias("a"), first_score.alias("b"))
    second = F.struct((second_unmet == 0).cast("int").alias("a"), second_score.alias("b"))
    return second >= first


def parse_evaluation(reply: Column) -> dict[str, Column]:
    """Scores 1-5 and unmet requirements out of a reply that may wrap its JSON in prose."""
    found = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    v = F.try_parse_json(F.when(found != "", found))
    out = {}
    for criterion in RUBRIC:
        raw = F.coalesce(
            F.try_variant_get(v, f"$.scores.{criterion}", "double"), F.try_variant_get(v, f"$.{criterion}", "double"))
        out[criterion] = F.least(F.lit(5), F.greatest(F.lit(1), F.bround(raw).cast("int"))) * F.when(raw.isNotNull(), 1)
    unmet = F.coalesce(F.try_variant_get(v, "$.unmet_requirements", "array<string>"), F.array().cast("array<string>"))
    out["unmet"] = F.filter(F.transform(unmet, lambda u: F.trim(u)), lambda u: u != "")
    complete = F.lit(True)
    for criterion in RUBRIC:
        complete = complete & out[criterion].isNotNull()
    out["usable"] = v.isNotNull() & complete
    return out


def critic(text: Column) -> dict[str, Column]:
    """Criticism lines, how many are severe, and the confidence they leave."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("|")))
    severe = F.size(F.filter(lines, lambda x: F.contains(F.upper(x), F.lit("SEVERITY: HIGH"))))
    return {"criticisms": lines, "severe": severe,
            "confidence": F.greatest(F.lit(0.1), F.lit(1.0) - severe * F.lit(0.3))}


def score_aggregates(rows: DataFrame, metrics: list[str], analysed: Column) -> DataFrame:
    """Mean, minimum, maximum and count of every metric over the analysed rows."""
    long = rows.filter(analysed).select(*[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot([], metrics, "metric", "value").filter(F.col("value").isNotNull())
    mean = F.sum(F.col("value").cast("decimal(20,4)")).cast("double") / F.count("value")
    return long.groupBy("metric").agg(
        F.round(mean, 6).alias("mean"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.count("value").alias("count"))


def usage(calls: DataFrame) -> DataFrame:
    """Calls, failures and tokens by provider and by model, in one grouping-sets pass."""
    named = calls.withColumn("provider", provider_of("model"))
    sums = [F.sum(F.coalesce(F.col(t), F.lit(0))).alias(t) for t in TOKEN_FIELDS]
    return named.groupingSets([["provider"], ["model"]], "provider", "model").agg(
        F.grouping("provider").alias("_g"), F.count(F.lit(1)).alias("calls"),
        F.count_if(~F.col("ok")).alias("failed"), *sums,
    ).select(
        F.when(F.col("_g") == 0, "provider").otherwise("model").alias("level"),
        F.coalesce("provider", "model").alias("name"), "calls", "failed", *TOKEN_FIELDS)
