"""Raw trip files as a batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tripflow.schema import TRIP_SCHEMA

# (type in the file, declared type) pairs the parquet reader converts while
# decoding. A cast in the plan would keep filters on the column from the scan.
_CONVERTED_BY_READER = {
    ("int", "bigint"),
    ("int", "double"),
    ("float", "double"),
    ("timestamp_ntz", "timestamp"),
}


def read_raw_trips(
    spark: SparkSession, *paths: str, declared: StructType = TRIP_SCHEMA
) -> DataFrame:
    """All raw files as one frame.

    Columns of all files are united without regard to case. Declared columns get their
    declared type and spelling, others the narrowest type that holds the values of all
    files. Files whose types cannot be merged are read in groups and united after casting.
    A value that its type cannot hold as it is fails the job that reads it;
    :func:`split_raw_trips` sets such rows apart instead.
    """
    groups = _groups(spark, paths, declared)
    return _united([group.strict() for group in groups])


def split_raw_trips(
    spark: SparkSession, *paths: str, declared: StructType = TRIP_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """The raw rows whose values all fit their columns, and the values of the others that do not.

    A refused value has its file, the row's number in it, column, type in the file, and
    the value as text. No value becomes null or loses digits: 2.5 or 3000000000 in a
    declared int, or a word in a number, are refused, 2.0 is not.
    """
    groups = _groups(spark, paths, declared)
    refused = [group.refused() for group in groups]
    return _united([group.accepted() for group in groups]), reduce(DataFrame.unionAll, refused)


def _united(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class _Group:
    """Files of one schema; ``casts``: column, type found, type wanted, where these differ."""

    rows: DataFrame
    casts: tuple[tuple[str, DataType, DataType], ...]

    def _columns(self, replaced: Mapping[str, Column]) -> list[Column]:
        return [replaced.get(name, F.col(f"`{name}`")) for name in self.rows.columns]

    def strict(self) -> DataFrame:
        replaced = {}
        for name, found, wanted in self.casts:
            message = F.concat(
                F.lit(f"{name}: "), F.col(f"`{name}`").cast("string"), F.lit(f" is no {wanted.simpleString()}")
            )
            value = F.when(_fits(name, found, wanted), F.col(f"`{name}`").try_cast(wanted))
            replaced[name] = value.otherwise(F.raise_error(message).cast(wanted)).alias(name)
        return self.rows.select(self._columns(replaced))

    def accepted(self) -> DataFrame:
        rows = self.rows
        for cast in self.casts:
            rows = rows.where(_fits(*cast))
        replaced = {name: F.col(f"`{name}`").try_cast(wanted).alias(name) for name, _, wanted in self.casts}
        return rows.select(self._columns(replaced))

    def refused(self) -> DataFrame:
        values = [
            F.when(
                ~_fits(name, found, wanted),
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(found.simpleString()).alias("found_type"),
                    F.col(f"`{name}`").cast("string").alias("value"),
                ),
            )
            for name, found, wanted in self.casts
        ]
        if not values:
            return self.rows.sparkSession.createDataFrame([], _REFUSED)
        refused = self.rows.select(
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.row_index").alias("row"),
            F.explode(F.array_compact(F.array(*values))).alias("v"),
        )
        return refused.select("source_file", "row", "v.*")


_REFUSED = "source_file string, row bigint, column_name string, found_type string, value string"


def _fits(name: str, found: DataType, wanted: DataType) -> Column:
    """Whether the wanted type holds the value as it is; null always fits."""
    value = F.col(f"`{name}`")
    cast = value.try_cast(wanted)
    held = cast.isNotNull()
    if isinstance(found, NumericType) and isinstance(wanted, NumericType):
        # Back in its own type it must be the same number: no digit is lost.
        held = held & F.coalesce(cast.try_cast(found) == value, F.lit(False))
    return value.isNull() | held


_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
_REAL = (FloatType(), DoubleType())
_DAYS = (DateType(), TimestampNTZType(), TimestampType())


def widened(types: Iterable[DataType]) -> DataType:
    """The narrowest type that holds all values of all the types; text holds any."""
    kinds = list(dict.fromkeys(types))
    if len(kinds) == 1:
        return kinds[0]
    if all(kind in _WHOLE for kind in kinds):
        return max(kinds, key=_WHOLE.index)
    if all(kind in _REAL or kind in _WHOLE[:3] for kind in kinds):
        return DoubleType()
    if all(kind in _DAYS for kind in kinds):
        return max(kinds, key=_DAYS.index)
    return StringType()


def _groups(
    spark: SparkSession, paths: Sequence[str], declared: StructType
) -> list[_Group]:
    """The files by schema, each to be read as the declared and widened types."""
    merged = _merged_schema(spark, paths)
    if merged is not None:
        parts = [(list(paths), merged)]
    else:
        listed = spark.read.schema(declared).parquet(*paths).inputFiles()
        parts = _mergeable_groups(spark, sorted(unquote(name) for name in listed))
    known = {field.name.lower() for field in declared}
    others: dict[str, list[StructField]] = {}
    for _, schema in parts:
        for field in schema:
            if field.name.lower() not in known:
                others.setdefault(field.name.lower(), []).append(field)
    wide = [StructField(same[0].name, widened(f.dataType for f in same)) for same in others.values()]
    wanted = StructType([*declared, *wide])
    return [_read_group(spark, files, schema, wanted) for files, schema in parts]


def read_trip_file(spark: SparkSession, path: str) -> DataFrame:
    """One raw file under its own schema."""
    return spark.read.parquet(path)


def stream_trips(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = 1,
    schema: StructType = TRIP_SCHEMA,
    file_pattern: str | None = None,
) -> DataFrame:
    """The folder as a stream, files in order of modification time.

    Files must arrive roughly in order of pickup time, or the watermark drops
    their rows. ``files_per_batch=None`` takes all waiting files at once.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_pattern is not None:
        reader = reader.option("pathGlobFilter", file_pattern)
    return reader.parquet(folder)


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> StructType | None:
    """Union of the footers' schemas, or None where their types conflict."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _mergeable_groups(
    spark: SparkSession, files: list[str]
) -> list[tuple[list[str], StructType]]:
    """Split the files into groups whose footers merge.

    File names follow time and a type changes at a few points in time, so
    halving the sorted list finds the runs between changes in few footer jobs.
    Runs of the same types are then joined into one scan.
    """
    runs: list[tuple[list[str], StructType]] = []
    pending = [files]
    while pending:
        part = pending.pop()
        schema = _merged_schema(spark, part)
        if schema is not None:
            runs.append((part, schema))
        else:
            middle = len(part) // 2
            pending += [part[middle:], part[:middle]]
    groups: dict[frozenset[tuple[str, str]], tuple[list[str], StructType]] = {}
    for part, schema in runs:
        types = frozenset((f.name.lower(), f.dataType.simpleString()) for f in schema)
        groups.setdefault(types, ([], schema))[0].extend(part)
    return list(groups.values())


def _read_group(
    spark: SparkSession, paths: Sequence[str], found: StructType, wanted: StructType
) -> _Group:
    types = {field.name.lower(): field for field in wanted}
    to_read, casts = [], []
    for field in found:
        target = types[field.name.lower()]
        read_as = _read_type(field.dataType, target.dataType)
        to_read.append(StructField(target.name, read_as))
        if read_as != target.dataType:
            casts.append((target.name, read_as, target.dataType))
    return _Group(spark.read.schema(StructType(to_read)).parquet(*paths), tuple(casts))


def _read_type(found: DataType, target: DataType) -> DataType:
    pair = (found.simpleString(), target.simpleString())
    return target if pair in _CONVERTED_BY_READER else found
