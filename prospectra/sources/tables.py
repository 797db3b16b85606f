"""Tables on shared storage: written tables, logs by date, records by stage, reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def written(df: DataFrame, path: str) -> DataFrame:
    """The DataFrame written out and read back: lineage ends here and survives lost executors."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def optional_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that may not exist yet; then an empty one of the same schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_log(df: DataFrame, path: str, at: str) -> None:
    """Appends log rows, one folder per date."""
    df.withColumn("log_date", F.to_date(at)).write.mode("append").partitionBy("log_date").parquet(path)


def write_records(df: DataFrame, path: str, stage: str) -> None:
    """Audit records of one stage as JSON."""
    df.withColumn("stage", F.lit(stage)).write.mode("append").partitionBy("stage").json(path)


def replay_records(spark: SparkSession, path: str, stage: str, schema, ids: list | None = None, key: str = "id") -> DataFrame:
    """Audit records of a stage, optionally of single entities."""
    df = spark.read.schema(schema).json(f"{path}/stage={stage}")
    return df.filter(F.col(key).isin(*ids)) if ids else df


def read_drafts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Drafts from JSON files holding an array or a single object."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A tab-separated report with header."""
    df.write.option("sep", "\t").option("header", True).mode("errorifexists").csv(path)


def rows_from_json(df: DataFrame, payload: str, row_schema: str) -> DataFrame:
    """Rows of a JSON array held in one column."""
    return df.select(F.inline(F.from_json(F.col(payload), f"array<struct<{row_schema}>>")))


def snapshot(df: DataFrame, keys: list[str], columns: list[str], path: str) -> DataFrame:
    """The columns a run is about to overwrite, saved by key."""
    return written(df.select(*keys, *columns), path)


def bounded(column: Column, low: float, high: float) -> Column:
    """True when a value respects its bounds; unknown values pass."""
    return F.coalesce(column.between(low, high), F.lit(True))


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and the others with the names of the checks they break."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull()
    )
    judged = df.withColumn("broken_checks", broken)
    return judged.filter(F.size("broken_checks") == 0).drop("broken_checks"), judged.filter(F.size("broken_checks") > 0)


def dealt(df: DataFrame, rows: int, *keys: str, most: int = 500_000) -> DataFrame:
    """Dealt by keys to so many tasks that one gets about ``most`` of ``rows`` rows, however many they are."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most)), *keys)


def spread(df: DataFrame) -> DataFrame:
    """Rows spread over all cores when the scan has fewer splits than there are cores.

    A few large files would leave most of a cluster idle under per-row text work.
    A scan with enough splits, the normal case at scale, is returned untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
