"""SRC1-SRC12: readers with declared schemas (no schema inference on data paths)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import written

# CSV dialect of Python's csv module: comma, double quote, '""' escapes a quote.
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC1: one row per text line, column ``value``."""
    return spark.read.text(path)


def decode_csv_lines(lines: DataFrame, names: Sequence[str], line_col: str = "value") -> DataFrame:
    """SRC2: CSV decode of a text column into named text fields.

    Empty fields are ``''`` (Python's csv gives ``''`` where Spark gives NULL).
    """
    schema = ", ".join(f"`{n}` STRING" for n in names)
    parsed = lines.select(F.from_csv(F.col(line_col), schema, CSV_OPTIONS).alias("_r"))
    return parsed.select(*[F.coalesce(F.col(f"_r.`{n}`"), F.lit("")).alias(n) for n in names])


def drop_header_lines(lines: DataFrame, first_field: str, line_col: str = "value") -> DataFrame:
    """P3 on raw lines: drop lines whose first CSV field is ``first_field``.

    Tested on the text (bare or quoted first field), so the filter runs before any
    dedupe or decode and never forces the CSV decode to be evaluated twice.
    """
    lit = re.escape(first_field)
    pattern = f'^(?:{lit}|"{lit}")(?:,|$)'
    return lines.where(~F.col(line_col).rlike(pattern))


MAIL_SCHEMA = T.StructType(
    [
        T.StructField("epoch_ms", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("sender", T.StringType()),
        T.StructField("recipients", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("mode", T.StringType()),
    ]
)


def read_mail_csv(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """SRC3: headerless mail CSV; empty fields as ''; source file name kept.

    Files are split across tasks (one record per line). ``multi_line=True`` accepts quoted
    fields with embedded newlines, at the price of one task per file.
    """
    df = spark.read.schema(MAIL_SCHEMA).options(header=False, multiLine=multi_line, **CSV_OPTIONS).csv(path)
    df = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in MAIL_SCHEMA.names], F.col("_metadata.file_name").alias("source_file"))
    return df


# The 83 declared columns of the machine table and their declared
# types, in declaration order.
MACHINE_COLUMNS = (
    ("MachineIdentifier", "category"),
    ("ProductName", "category"),
    ("EngineVersion", "category"),
    ("AppVersion", "category"),
    ("AvSigVersion", "category"),
    ("IsBeta", "int8"),
    ("RtpStateBitfield", "float32"),
    ("IsSxsPassiveMode", "int8"),
    ("DefaultBrowsersIdentifier", "float32"),
    ("AVProductStatesIdentifier", "float32"),
    ("AVProductsInstalled", "float32"),
    ("AVProductsEnabled", "float32"),
    ("HasTpm", "int8"),
    ("CountryIdentifier", "int16"),
    ("CityIdentifier", "float32"),
    ("OrganizationIdentifier", "float32"),
    ("GeoNameIdentifier", "float32"),
    ("LocaleEnglishNameIdentifier", "int8"),
    ("Platform", "category"),
    ("Processor", "category"),
    ("OsVer", "category"),
    ("OsBuild", "int16"),
    ("OsSuite", "int16"),
    ("OsPlatformSubRelease", "category"),
    ("OsBuildLab", "category"),
    ("SkuEdition", "category"),
    ("IsProtected", "float32"),
    ("AutoSampleOptIn", "int8"),
    ("PuaMode", "category"),
    ("SMode", "float32"),
    ("IeVerIdentifier", "float32"),
    ("SmartScreen", "category"),
    ("Firewall", "float32"),
    ("UacLuaenable", "float32"),
    ("Census_MDC2FormFactor", "category"),
    ("Census_DeviceFamily", "category"),
    ("Census_OEMNameIdentifier", "float32"),
    ("Census_OEMModelIdentifier", "float32"),
    ("Census_ProcessorCoreCount", "float32"),
    ("Census_ProcessorManufacturerIdentifier", "float32"),
    ("Census_ProcessorModelIdentifier", "float32"),
    ("Census_ProcessorClass", "category"),
    ("Census_PrimaryDiskTotalCapacity", "float32"),
    ("Census_PrimaryDiskTypeName", "category"),
    ("Census_SystemVolumeTotalCapacity", "float32"),
    ("Census_HasOpticalDiskDrive", "int8"),
    ("Census_TotalPhysicalRAM", "float32"),
    ("Census_ChassisTypeName", "category"),
    ("Census_InternalPrimaryDiagonalDisplaySizeInInches", "float32"),
    ("Census_InternalPrimaryDisplayResolutionHorizontal", "float32"),
    ("Census_InternalPrimaryDisplayResolutionVertical", "float32"),
    ("Census_PowerPlatformRoleName", "category"),
    ("Census_InternalBatteryType", "category"),
    ("Census_InternalBatteryNumberOfCharges", "float32"),
    ("Census_OSVersion", "category"),
    ("Census_OSArchitecture", "category"),
    ("Census_OSBranch", "category"),
    ("Census_OSBuildNumber", "int16"),
    ("Census_OSBuildRevision", "int32"),
    ("Census_OSEdition", "category"),
    ("Census_OSSkuName", "category"),
    ("Census_OSInstallTypeName", "category"),
    ("Census_OSInstallLanguageIdentifier", "float32"),
    ("Census_OSUILocaleIdentifier", "int16"),
    ("Census_OSWUAutoUpdateOptionsName", "category"),
    ("Census_IsPortableOperatingSystem", "int8"),
    ("Census_GenuineStateName", "category"),
    ("Census_ActivationChannel", "category"),
    ("Census_IsFlightingInternal", "float32"),
    ("Census_IsFlightsDisabled", "float32"),
    ("Census_FlightRing", "category"),
    ("Census_ThresholdOptIn", "float32"),
    ("Census_FirmwareManufacturerIdentifier", "float32"),
    ("Census_FirmwareVersionIdentifier", "float32"),
    ("Census_IsSecureBootEnabled", "int8"),
    ("Census_IsWIMBootEnabled", "float32"),
    ("Census_IsVirtualDevice", "float32"),
    ("Census_IsTouchEnabled", "int8"),
    ("Census_IsPenCapable", "int8"),
    ("Census_IsAlwaysOnAlwaysConnectedCapable", "float32"),
    ("Wdft_IsGamer", "float32"),
    ("Wdft_RegionIdentifier", "float32"),
    ("HasDetections", "int8"),
)
# Declared type -> Spark type.
DECLARED_TYPES = {
    "category": T.StringType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "float32": T.FloatType(),
}
# Widened: int8 stops at 127 and the identifiers are not shown to fit.
MACHINE_WIDENED = {"LocaleEnglishNameIdentifier": T.ShortType()}


def machine_schema(columns: Sequence[str] | None = None) -> T.StructType:
    """Declared Spark types; ``columns`` gives the file's column order."""
    types = {name: MACHINE_WIDENED.get(name, DECLARED_TYPES[kind]) for name, kind in MACHINE_COLUMNS}
    order = list(columns) if columns else [name for name, _ in MACHINE_COLUMNS]
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in order])


def read_typed_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """SRC4: headered CSV with a declared schema (missing values are NULL)."""
    return spark.read.schema(schema).options(header=True, enforceSchema=True, **CSV_OPTIONS).csv(path)


def read_checked_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """SRC4 with reject routing: (rows that fit the schema, rejected lines). A line is
    rejected whole, and listed with its file and its text, if it has too few or too many
    fields or a value that its type cannot hold; none becomes silent NULLs. The files are
    parsed once, and both results read what was written then."""
    raw = "_raw_line"
    checked = T.StructType([*schema.fields, T.StructField(raw, T.StringType())])
    options = {"header": header, "enforceSchema": True, "columnNameOfCorruptRecord": raw, **CSV_OPTIONS}
    parsed = spark.read.schema(checked).options(**options).csv(path).withColumn("_file", F.col("_metadata.file_name"))
    once = written(parsed, "checked-csv")
    return once.where(F.col(raw).isNull()).drop(raw, "_file"), once.where(F.col(raw).isNotNull()).select(F.col("_file").alias("file"), F.col(raw).alias("line"))


def read_score_file(spark: SparkSession, path: str, id_col: str, score_col: str) -> DataFrame:
    """SRC5: ``id,score`` CSV whose header is replaced by the given names."""
    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return spark.read.schema(schema).options(header=True, enforceSchema=True, **CSV_OPTIONS).csv(path)


def read_columnar(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC6: columnar files between stages are Parquet."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: version -> timestamp dictionary stored as a two-column Parquet table."""
    return spark.read.parquet(path).select(F.col("version").cast("string"), F.col("ts").cast("timestamp"))


# Folders below the one that is read are listed by so many tasks at most (Spark's default: 10,000).
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_image_folder(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """SRC10: files of a folder (path, modificationTime, length, content) with their id.

    By default Spark starts a task for each folder below it; where the session says nothing
    else, they are dealt to four tasks a core here. The setting is taken back after listing."""
    reader = spark.read.format("binaryFile")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    unset = spark.conf.get(LISTING_TASKS, None) is None
    if unset:
        spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        df = reader.load(folder)
    finally:
        if unset:
            spark.conf.unset(LISTING_TASKS)
    return df.withColumn("id", F.substring_index(F.substring_index(F.col("path"), "/", -1), ".", 1))


def read_id_template(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: submission template; the row position is kept for ordered output."""
    df = spark.read.options(header=True, **CSV_OPTIONS).csv(path)
    return df.withColumn("pos", F.monotonically_increasing_id())
