"""Family A: flight records enriched with the hourly maximum temperature, and reports.

Shape of the job (one Catalyst plan per output):

  weather lines -> CSV decode -> (airport, date, hour) -> max temperature   [dictionary]
  flight lines  -> distinct lines -> CSV decode -> drop header -> projection
                -> left join dictionary (broadcast when measured small) -> enriched
  enriched      -> max Celsius per (airline, date); counts per (airline, flag);
                   counts per airline; counts per (airline, date)

Differences from the original that are deliberate (see SURVEY 2.14): the missing
reading is NULL inside the job and 9999 only in the legacy text output; the enriched
rows stay typed (no comma-joined text that later reports parse again); the numeric
maximum is the default, the text maximum is available with ``legacy_text_max``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions.geohash import with_geohash
from tessera.operators.joins import enrich_with_default
from tessera.sources import sinks
from tessera.sources.files import decode_csv_lines, drop_header_lines

# Positions of the used fields in the flight records, and the
# four used fields of the weather records.
FLIGHT_FIELDS = {
    "date": 0,
    "airline": 1,
    "destination": 3,
    "origin": 5,
    "dep_time": 7,
    "dep_delay": 8,
    "longitude": 15,
    "latitude": 16,
    "code": 18,
}
FLIGHT_WIDTH = 19
WEATHER_FIELDS = ["date", "airport", "time", "temperature"]
MISSING_READING = 9999
HEADER_FIRST_FIELD = "Date"
CODE_WIDTH = 10

ENRICHED_COLUMNS = ["date", "dep_time", "airline", "origin", "geohash", "route", "delay_flag", "code", "temperature"]


def flight_field_names() -> list[str]:
    names = [f"f{i}" for i in range(FLIGHT_WIDTH)]
    for name, pos in FLIGHT_FIELDS.items():
        names[pos] = name
    return names


def parse_weather(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """CSV decode of weather lines into the four named text fields ('' for empty)."""
    return decode_csv_lines(lines, WEATHER_FIELDS, line_col)


def weather_dictionary(weather: DataFrame, legacy_text_max: bool = False) -> DataFrame:
    """A1: maximum temperature per (airport, date, hour); unique on the key.

    Numeric maximum of the parsed reading by default; rows whose reading does not
    parse (a header line, for instance) do not enter the dictionary. With
    ``legacy_text_max`` the maximum is taken over the texts, as the original did
    (``'9' > '100'``), and is then parsed.
    """
    keyed = weather.select(
        F.col("airport"), F.col("date"), S.hour_of_hhmm("time").alias("hour"), F.col("temperature")
    )
    if legacy_text_max:
        agg = keyed.groupBy("airport", "date", "hour").agg(F.max("temperature").alias("temperature_text"))
        return agg.withColumn("temperature", S.parse_float("temperature_text"))
    # max() skips NULL, so unparsable readings drop out of the maximum; keys without any
    # parsable reading are removed after the aggregate (a filter there cannot be pushed
    # back into the CSV decode and evaluate it twice).
    # A reading that spells NaN counts as unparsable too, or it would win every maximum.
    parsed = keyed.withColumn("temperature", F.nanvl(S.parse_float("temperature"), F.lit(None).cast("double")))
    agg = parsed.groupBy("airport", "date", "hour").agg(F.max("temperature").alias("temperature"))
    return agg.where(F.col("temperature").isNotNull())


def parse_flights(lines: DataFrame, line_col: str = "value", dedupe_lines: bool = True) -> DataFrame:
    """SRC1/A6/SRC2/P3: distinct raw lines, CSV decode, header rows removed."""
    lines = drop_header_lines(lines, HEADER_FIRST_FIELD, line_col)
    if dedupe_lines:
        lines = lines.select(line_col).distinct()
    return decode_csv_lines(lines, flight_field_names(), line_col)


def project_flights(flights: DataFrame, lower_case_flag: bool = False) -> DataFrame:
    """The eight projected fields plus the join key columns (airport=origin, date, hour)."""
    located = with_geohash(flights, "latitude", "longitude", out="geohash")
    return located.select(
        F.col("date"),
        F.col("dep_time"),
        F.col("airline"),
        F.col("origin"),
        F.col("geohash"),
        S.route("origin", "destination").alias("route"),
        S.delay_flag("dep_delay", lower_case=lower_case_flag).alias("delay_flag"),
        S.pad_right("code", CODE_WIDTH).alias("code"),
        F.col("origin").alias("airport"),
        S.hour_of_hhmm("dep_time").alias("hour"),
    )


def enrich(projected: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One output row per flight; ``temperature`` is NULL where no reading exists.

    A dictionary built with ``legacy_text_max`` also carries the reading as text
    (``temperature_text``) for the legacy text output.
    """
    more = [c for c in ("temperature_text",) if c in dictionary.columns]
    out = enrich_with_default(projected, dictionary, keys=["airport", "date", "hour"], value_col="temperature", more=more)
    return out.select(*ENRICHED_COLUMNS, *more)


def with_legacy_temperature(enriched: DataFrame) -> DataFrame:
    """Q4: the missing reading rendered as 9999 (output form only)."""
    return enriched.withColumn("temperature", F.coalesce(F.col("temperature"), F.lit(float(MISSING_READING))))


def daily_max_celsius(enriched: DataFrame) -> DataFrame:
    """P4 + SC6 + A2: rows with a reading, maximum Celsius per (airline, date)."""
    return (
        enriched.where(F.col("temperature").isNotNull())
        .groupBy("airline", "date")
        .agg(F.max(S.fahrenheit_to_celsius("temperature")).alias("max_temp_c"))
    )


def delay_counts(enriched: DataFrame) -> DataFrame:
    """A3: flights per (airline, delay flag)."""
    return enriched.groupBy("airline", "delay_flag").agg(F.count(F.lit(1)).alias("n_flights"))


def flights_per_airline(enriched: DataFrame) -> DataFrame:
    """A4."""
    return enriched.groupBy("airline").agg(F.count(F.lit(1)).alias("n_flights"))


def flights_per_airline_day(enriched: DataFrame) -> DataFrame:
    """A5."""
    return enriched.groupBy("airline", "date").agg(F.count(F.lit(1)).alias("n_flights"))


def legacy_text(df: DataFrame, fmt: str, *cols) -> DataFrame:
    """SNK1: one formatted text line per row (``'%s, %s'`` style)."""
    return df.select(F.format_string(fmt, *cols).alias("value"))


def legacy_lines(outputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SNK1: the six outputs rendered as the original text lines.

    Formats (fixed values): dictionary ``'%s, %s'`` with the key ``airport-date-hour``;
    details comma-joined with the temperature last (9999 when missing); daily maximum
    ``'%s, %s, %1.1f'``; delay counts ``'%s, %s %s'``; flights per airline
    ``'%s, %s'``; flights per airline and day ``'%s, %s %s'``.
    """
    d = outputs["weather_dictionary"]
    key = F.concat_ws("-", "airport", "date", "hour")
    det = outputs["flights_full_details"]
    # The reading as the original wrote it: the text maximum when the dictionary kept it,
    # else the number; a missing reading is the text 9999.
    d_text = F.col("temperature_text") if "temperature_text" in d.columns else F.col("temperature").cast("string")
    t_text = F.col("temperature_text") if "temperature_text" in det.columns else F.col("temperature").cast("string")
    missing = F.col("temperature") == F.lit(float(MISSING_READING))
    return {
        "weather_dictionary": d.select(F.format_string("%s, %s", key, d_text).alias("value")),
        "flights_full_details": det.select(
            F.concat_ws(
                ",",
                *[F.col(c) for c in ENRICHED_COLUMNS[:-1]],
                F.when(missing, F.lit(str(MISSING_READING))).otherwise(t_text),
            ).alias("value")
        ),
        "airlines_day_max_temperature": outputs["airlines_day_max_temperature"].select(
            F.format_string("%s, %s, %s", "airline", "date", S.format_one_decimal("max_temp_c")).alias("value")
        ),
        "airlines_number_delay": outputs["airlines_number_delay"].select(
            F.format_string("%s, %s %s", "airline", "delay_flag", "n_flights").alias("value")
        ),
        "airlines_number_flights": outputs["airlines_number_flights"].select(
            F.format_string("%s, %s", "airline", "n_flights").alias("value")
        ),
        "airlines_number_flights_per_day": outputs["airlines_number_flights_per_day"].select(
            F.format_string("%s, %s %s", "airline", "date", "n_flights").alias("value")
        ),
    }


def run_job(
    weather_lines: DataFrame,
    flight_lines: DataFrame,
    out_dir: str,
    legacy_text_max: bool = False,
    legacy_text: bool = False,
    lower_case_flag: bool = False,
) -> dict:
    """Whole job: dictionary + enriched details + four reports, written as Parquet (typed)
    or, with ``legacy_text``, as the original's text lines.

    The enriched table feeds five writes, so it is persisted once (MEMORY_AND_DISK:
    partitions spill instead of failing, and lost blocks are recomputed).
    """
    dictionary = weather_dictionary(parse_weather(weather_lines), legacy_text_max)
    projected = project_flights(parse_flights(flight_lines), lower_case_flag)
    enriched = enrich(projected, dictionary).persist(StorageLevel.MEMORY_AND_DISK)
    outputs = {
        "weather_dictionary": dictionary,
        "flights_full_details": with_legacy_temperature(enriched),
        "airlines_day_max_temperature": daily_max_celsius(enriched),
        "airlines_number_delay": delay_counts(enriched),
        "airlines_number_flights": flights_per_airline(enriched),
        "airlines_number_flights_per_day": flights_per_airline_day(enriched),
    }
    if legacy_text:
        outputs = legacy_lines(outputs)
    try:
        for name, df in outputs.items():
            if legacy_text:
                df.write.mode("overwrite").text(f"{out_dir}/{name}")
            else:
                sinks.write_columnar(df, f"{out_dir}/{name}")
    finally:
        enriched.unpersist()
    return {k: f"{out_dir}/{k}" for k in outputs}
