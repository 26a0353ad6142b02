"""Writing layers: stamping, store assignment, create-once, replace, append."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake import schemas
from studylake.session import remove_folder


def ingest_bronze(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All raw columns plus the load's timestamp and date."""
    moment = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    return raw.withColumn("ingestion_timestamp", moment).withColumn(
        "ingestion_date", moment.cast("date")
    )


def _assign(field: T.StructField) -> Column:
    value, kind = F.col(field.name), field.dataType
    if not isinstance(kind, (T.VarcharType, T.CharType)):
        return value.cast(kind).alias(field.name)
    text = value.cast("string")
    fits = F.length(F.rtrim(text)) <= kind.length
    error = F.raise_error(
        F.concat(F.lit(f"{field.name} exceeds {kind.length} characters: "), text)
    ).cast("string")
    kept = F.when(F.length(text) <= kind.length, text).otherwise(
        F.substring(text, 1, kind.length)
    )
    if isinstance(kind, T.CharType):
        kept = F.rpad(kept, kind.length, " ")
    return F.when(text.isNull() | fits, kept).otherwise(error).alias(field.name)


def to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns by name, coerced to the declared types.

    Numbers out of range and texts longer than CHAR/VARCHAR allows fail the job;
    trailing spaces beyond the length are cut, and CHAR is padded.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select(*[_assign(f) for f in schema.fields])


def create_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write only when nothing is there yet: a second run does not reload."""
    df.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Full rebuild."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_table(df: DataFrame, schema: T.StructType | str, path: str) -> None:
    """Replace the content of a table with a declared schema."""
    replace_table(to_schema(df, schema), path)


def append_results(results: DataFrame, path: str) -> None:
    """Add check results to the quality log.

    Results of the same table and moment replace what a former try left of them.
    """
    to_schema(results, schemas.CHECK_RESULT).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*schemas.CHECK_RESULT_KEYS).parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The quality log."""
    return spark.read.schema(schemas.CHECK_RESULT).parquet(path)


class Lake:
    """Tables under one folder, each rewrite in a new version directory.

    A version counts once its success marker is there, so readers never meet a
    half-written table and an upsert can read the version it replaces. A version
    is never written over: of two writers that take the same number, the second
    fails. Old versions stay until ``retire`` removes them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _listed(self, layer: str, table: str) -> dict[int, bool]:
        """Every version directory by number, and whether it is complete."""
        files, folder = fs.FileSystem.from_uri(f"{self.root}/{layer}/{table}")
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        numbers = {int(f.base_name[1:]): f.path for f in found
                   if f.base_name[:1] == "v" and f.base_name[1:].isdigit()}
        markers = files.get_file_info([f"{path}/_SUCCESS" for path in numbers.values()])
        return {n: m.type == fs.FileType.File for n, m in zip(numbers, markers, strict=True)}

    def _versions(self, layer: str, table: str) -> list[int]:
        return sorted(n for n, complete in self._listed(layer, table).items() if complete)

    def path(self, layer: str, table: str, version: int) -> str:
        return f"{self.root}/{layer}/{table}/v{version:06d}"

    def exists(self, layer: str, table: str) -> bool:
        return bool(self._versions(layer, table))

    def read(self, layer: str, table: str) -> DataFrame | None:
        versions = self._versions(layer, table)
        return self.spark.read.parquet(self.path(layer, table, versions[-1])) if versions else None

    def write(self, layer: str, table: str, df: DataFrame, *partition_by: str) -> DataFrame:
        version = max(self._listed(layer, table), default=0) + 1
        df.write.mode("error").partitionBy(*partition_by).parquet(self.path(layer, table, version))
        return self.read(layer, table)

    def retire(self, layer: str, table: str, keep: int = 1) -> list[int]:
        """Remove all but the latest ``keep`` complete versions, and unfinished older ones."""
        if keep < 1:
            raise ValueError("at least one version stays")
        kept = self._versions(layer, table)[-keep:]
        gone = [n for n in self._listed(layer, table) if kept and n < kept[0]]
        for number in gone:
            remove_folder(self.path(layer, table, number))
        return sorted(gone)

    def create(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Create once; an existing table is returned as it is."""
        return self.read(layer, table) if self.exists(layer, table) else self.write(layer, table, df)
