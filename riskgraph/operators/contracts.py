"""Data-quality contracts: rules as data, one evaluation for clean rows, quarantine and metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.operators.lineage import cut, scratch
from riskgraph.operators.ranking import first_of_key

TOTAL_RULE = "rows_quarantined_total"  # fixed value
RULE_ACTION = "quarantine_row"  # fixed value
TOTAL_ACTION = "excluded_from_trusted"  # fixed value

QUARANTINE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("run_id", "dataset", "record_key", "quarantine_reason", "quarantined_at_utc")]
)
QUALITY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("rule_name", T.StringType()), T.StructField("total_rows", T.LongType()),
    T.StructField("violations", T.LongType()), T.StructField("violation_pct", T.DoubleType()),
    T.StructField("action_applied", T.StringType()), T.StructField("measured_at_utc", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    """A named predicate; ``holds`` builds a two-valued column, ``reason`` is the code of a violation."""

    name: str
    reason: str
    holds: Callable[[], Column]


@dataclass(frozen=True)
class Contract:
    """Rules of one dataset. ``unique`` names an extra uniqueness rule on ``key`` as (rule name, reason)."""

    dataset: str
    key: str
    rules: tuple[Rule, ...]
    unique: tuple[str, str] | None = None

    @property
    def outcomes(self) -> list[tuple[str, str]]:
        """(rule name, reason) in rule order, the uniqueness rule last."""
        return [(r.name, r.reason) for r in self.rules] + ([self.unique] if self.unique else [])


@dataclass(frozen=True)
class Evaluated:
    """A standardised frame with the rule flags attached in one array column ``_ok``."""

    frame: DataFrame
    contract: Contract
    columns: tuple[str, ...]
    run_id: str
    run_ts: str

    def _flag(self, position: int) -> Column:
        return F.get("_ok", F.lit(position))

    @property
    def _clean(self) -> Column:
        """All flags, as one conjunction of the rules themselves: a filter on it is compiled, and no array is built for it."""
        return reduce(lambda a, b: a & b, [self._flag(i) for i in range(len(self.contract.outcomes))], F.lit(True))

    def clean(self) -> DataFrame:
        return self.frame.where(self._clean).select(
            *self.columns, F.lit(self.run_id).alias("_run_id"), F.lit(self.run_ts).alias("_processed_at_utc")
        )

    @property
    def _reason(self) -> Column:
        """The reason codes of all broken rules in rule order."""
        return F.concat_ws(";", *[F.when(~self._flag(i), reason) for i, (_, reason) in enumerate(self.contract.outcomes)])

    def quarantine(self) -> DataFrame:
        """One row per violating row, with the reason codes of all broken rules in rule order."""
        return self.frame.where(~self._clean).select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.contract.dataset).alias("dataset"),
            F.col(self.contract.key).cast("string").alias("record_key"),
            self._reason.alias("quarantine_reason"),
            F.lit(self.run_ts).alias("quarantined_at_utc"),
        )

    @property
    def _counts(self) -> list[Column]:
        """All rule counts of one pass: the rows, the violations of each rule, the rows with any."""
        broken = [F.count_if(~self._flag(i)).alias(f"broken_{i}") for i in range(len(self.contract.outcomes))]
        return [F.count(F.lit(1)).alias("total_rows"), *broken, F.count_if(~self._clean).alias(f"broken_{len(broken)}")]

    def metrics(self) -> DataFrame:
        """All rule counts from one aggregate over the data; the reshaping to rows touches a single row."""
        return self._as_metrics(self.frame.agg(*self._counts))

    def _as_metrics(self, one: DataFrame) -> DataFrame:
        names = [name for name, _ in self.contract.outcomes] + [TOTAL_RULE]
        counts = F.array(*[F.col(f"broken_{i}") for i in range(len(names))])
        labelled = F.arrays_zip(F.array(*map(F.lit, names)).alias("rule_name"), counts.alias("violations"))
        rows = one.select("total_rows", F.explode(labelled).alias("m"))
        share = F.try_divide(F.col("m.violations") * F.lit(100.0), F.col("total_rows"))
        return rows.select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.contract.dataset).alias("dataset"),
            F.col("m.rule_name").alias("rule_name"),
            "total_rows",
            F.col("m.violations").alias("violations"),
            F.round(F.coalesce(share, F.lit(0.0)), 4).alias("violation_pct"),
            F.when(F.col("m.rule_name") == TOTAL_RULE, TOTAL_ACTION).otherwise(RULE_ACTION).alias("action_applied"),
            F.lit(self.run_ts).alias("measured_at_utc"),
        )

    def split(self, path: str | None = None, batch_id: int | None = None) -> Split:
        """Write all rows once, in folders of clean and violating ones; the metrics are observed while that write runs.

        The source is evaluated by this one job. Without a ``path`` the table is one of the shared folder. ``batch_id``
        adds a partition that a replay of the same batch overwrites.
        """
        spark = self.frame.sparkSession
        path = path or scratch(spark, "split")
        seen = Observation()
        rows = self.frame.observe(seen, *self._counts).select(
            *self.columns, F.lit(self.run_id).alias("_run_id"), F.lit(self.run_ts).alias("_processed_at_utc"),
            F.when(~self._clean, self._reason).alias("_reason"), self._clean.alias("_is_clean"))
        writer = rows.write if batch_id is None else rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic")
        writer.partitionBy(*([] if batch_id is None else ["batch_id"]), "_is_clean").parquet(path)
        counts = seen.get
        one = spark.createDataFrame([[counts[n] for n in counts]], ", ".join(f"{n} long" for n in counts))
        schema = T.StructType([*rows.schema.fields, *([] if batch_id is None else [T.StructField("batch_id", T.LongType())])])
        return Split(spark.read.schema(schema).parquet(path), self.contract, self._as_metrics(one))


@dataclass(frozen=True)
class Split:
    """The written rows of an evaluated frame. Clean rows and quarantine each read their own folder."""

    rows: DataFrame
    contract: Contract
    quality: DataFrame

    def clean(self) -> DataFrame:
        return self.rows.where("_is_clean").drop("_reason", "_is_clean")

    def quarantine(self) -> DataFrame:
        carried = ["batch_id"] if "batch_id" in self.rows.columns else []
        return self.rows.where("not _is_clean").select(
            F.col("_run_id").alias("run_id"), F.lit(self.contract.dataset).alias("dataset"),
            F.col(self.contract.key).cast("string").alias("record_key"), F.col("_reason").alias("quarantine_reason"),
            F.col("_processed_at_utc").alias("quarantined_at_utc"), *carried)

    def metrics(self) -> DataFrame:
        return self.quality


def evaluate(standardised: DataFrame, contract: Contract, run_id: str, run_ts: str, new_keys: DataFrame | None = None) -> Evaluated:
    """Evaluate every rule once per row. Only a uniqueness rule shuffles.

    ``new_keys`` (one column, distinct) are the keys that no earlier batch has had: only their first row is unique.
    """
    columns = tuple(standardised.columns)
    flags = [rule.holds() for rule in contract.rules]
    frame = standardised
    if contract.unique:
        rest = [c for c in columns if c != contract.key]
        frame = first_of_key(frame, [contract.key], rest, "_first")
        if new_keys is not None:
            frame = cut(frame)  # read twice below: the ranking of the rows is not repeated
            fresh = new_keys.select(F.col(contract.key).alias("_fresh"), F.lit(True).alias("_is_new"))
            firsts = frame.where("_first").join(fresh, F.col(contract.key).eqNullSafe(F.col("_fresh")), "left")  # one row a key
            firsts = firsts.select(*columns, F.coalesce("_is_new", F.lit(False)).alias("_first"))
            frame = firsts.unionByName(frame.where("not _first"))
        flags.append(F.col("_first"))
    return Evaluated(frame.select(*columns, F.array(*flags).alias("_ok")), contract, columns, run_id, run_ts)


def union_quarantine(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def missing_sources(canonical: DataFrame, required: list[str]) -> DataFrame:
    """Required source names that contribute no row."""
    wanted = canonical.sparkSession.createDataFrame([(n,) for n in required], "source_dataset string")
    present = canonical.select("source_dataset").where(F.col("source_dataset").isin(*required)).distinct()
    return wanted.join(present, "source_dataset", "left_anti").orderBy("source_dataset")


def require_sources(canonical: DataFrame, required: list[str]) -> None:
    absent = [r.source_dataset for r in missing_sources(canonical, required).collect()]
    if absent:
        raise ValueError(f"required sources are absent: {absent}")
