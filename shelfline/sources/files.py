"""File sources: CSV reference files (R1) and Parquet datasets (R4, R4d, R4v)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import to_day
from ..session import stored

#: Columns that a checked CSV read adds while it parses.
CORRUPT, REASON = "_line", "_reason"


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header line.  With ``schema`` types are declared (stable
    across loads); without it they are inferred, which costs an extra pass.
    Quoted fields may hold commas; a doubled quote inside quotes is a quote."""
    r = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


@dataclass(frozen=True)
class CheckedCsv:
    """A CSV file parsed once: ``kept`` (the schema's columns) and ``rejected``
    (``line`` as it stands in the file, ``reason``); together every line but headers."""
    kept: DataFrame
    rejected: DataFrame


def _reason(schema: StructType, key: str | None) -> Column:
    """Why a row is rejected, else null.  Fields are looked at again as text, in lines
    that did not parse only."""
    names = schema.fieldNames()
    text = F.from_csv(F.col(CORRUPT), ", ".join(f"`{n}` string" for n in names), {"quote": '"', "escape": '"'})
    bad = F.array_compact(F.array(*[F.when(text[n].isNotNull() & F.col(f"`{n}`").isNull(), F.lit(f"{n}: not {t}"))
                                    for n, t in ((f.name, f.dataType.simpleString()) for f in schema)]))
    malformed = F.when(F.size(bad) > 0, F.concat_ws(", ", bad)).otherwise("wrong number of fields")
    reason = F.when(F.col(CORRUPT).isNotNull(), malformed)
    return reason if key is None else reason.when(F.col(f"`{key}`").isNull(), f"no {key}")


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, key: str | None = None) -> CheckedCsv:
    """R1 with bad lines told apart: lines whose fields are too many, too few or not of
    the declared type, and with ``key`` rows without one, are rejected with a reason.

    The file is parsed once, permissively, into the scratch folder; both tables read
    that.  A quoted field may hold commas, not line ends.  Rejected rows of a missing key
    show their fields as JSON, for the parser keeps the text of malformed lines only.  Of
    an empty file both tables are empty."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = (spark.read.schema(wide).option("header", True).option("quote", '"').option("escape", '"')
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    names = [F.col(f"`{n}`") for n in schema.fieldNames()]
    rows = stored(parsed.withColumn(REASON, _reason(schema, key)), "checked-csv")
    line = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*names)))
    return CheckedCsv(rows.where(F.col(REASON).isNull()).select(*names),
                      rows.where(F.col(REASON).isNotNull()).select(line.alias("line"), F.col(REASON).alias("reason")))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_partition(spark: SparkSession, path: str, value, column: str = "date") -> DataFrame:
    """One partition of a partitioned dataset (R4d), keeping the partition
    column.  Only that folder is listed.  A missing partition gives an empty
    frame with the dataset's schema."""
    v = to_day(value) if column == "date" else value
    try:
        return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{column}={v}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.read.parquet(path).where(F.col(column) == F.lit(v))


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Reference snapshot stored under ``root/version=V`` (R4v).

    With ``version`` that exact snapshot is read; without it the latest
    snapshot is chosen lazily by a scalar subquery over the (small) folder."""
    if version is not None:
        return spark.read.parquet(f"{root.rstrip('/')}/version={version}")
    all_versions = spark.read.parquet(root)
    v = F.col("version").cast("string")
    latest = all_versions.select(F.max(v)).scalar()
    return all_versions.where(v == latest).drop("version")


def read_version_as_of(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """Latest snapshot whose version is <= ``as_of`` (versions compare as text,
    so use one format, e.g. yyyy-MM)."""
    all_versions = spark.read.parquet(root)
    v = F.col("version").cast("string")
    eligible = all_versions.where(v <= F.lit(as_of))
    latest = eligible.select(F.max(v)).scalar()
    return eligible.where(v == latest).drop("version")
