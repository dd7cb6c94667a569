"""Raw inputs. CSV columns come in as text and are cast leniently; only the used ones are read."""

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import grid_bounds, week_starting
from panelcast.functions.scalars import lenient_date, lenient_double

# Column names and name fragments of the raw files, and their date formats.
FACT_COLUMNS = {"series_id": "COUNTRY_CODE", "week_start": "MMWR_WEEKSTARTDATE", "value": "ILI_CASE"}
DATE_FRAGMENTS = ("date", "תאריך")
STATION_FRAGMENTS = ("station", "תחנה")
MAX_FRAGMENTS = ("max", "עליונה", "מקסימום")
MIN_FRAGMENTS = ("min", "תחתונה", "מינימום")
FACT_DATES = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy")
WEATHER_DATES = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-MM-dd")
HOLIDAY_DATES = ("M/d/yyyy", "yyyy-MM-dd")


def _scan(spark: SparkSession, path, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.csv(path, header=True, encoding="UTF-8")
    return spark.read.format(fmt).load(path)


def read_facts(
    spark: SparkSession, path, fmt: str = "csv", columns: dict[str, str] = FACT_COLUMNS, bucket: str = "as_is"
) -> DataFrame:
    """``series_id, week_start, value`` of all series in one scan; bad dates and numbers are NULL.

    ``bucket="week"`` puts a fact of any day into the week that its Sunday starts; ``as_is`` keeps the
    dates, of which the panel uses the Sundays (``panel.off_grid`` counts the others).
    """
    if bucket not in ("as_is", "week"):
        raise ValueError(f"unknown bucket {bucket!r}")
    raw = _scan(spark, path, fmt)
    day = lenient_date(F.col(columns["week_start"]), FACT_DATES)
    return raw.select(
        F.col(columns["series_id"]).alias("series_id"),
        (week_starting(day) if bucket == "week" else day).alias("week_start"),
        lenient_double(F.col(columns["value"])).alias("value"),
    )


def between_days(raw: DataFrame, day: str, start, end, bucket: str = "as_is") -> DataFrame:
    """Raw rows whose day can belong to the Sunday grid of [start, end]; with ``bucket="week"`` days up to the Saturday
    after its last Sunday do. The bounds are literals of the column's own type, so they reach the scan."""
    first, last = grid_bounds(start, end)
    after = last + timedelta(days=7 if bucket == "week" else 1)
    kind = raw.schema[day].dataType
    return raw.filter((F.col(day) >= F.lit(first).cast(kind)) & (F.col(day) < F.lit(after).cast(kind)))


def for_series(facts: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Rows of the given series; the filter reaches the scan."""
    return facts.filter(F.col("series_id").isin(*codes))


def _first_match(columns: Sequence[str], fragments: Sequence[str]) -> str | None:
    return next((c for c in columns if any(f in c.lower() for f in fragments)), None)


def read_weather(spark: SparkSession, path, fmt: str = "csv", station: str | None = None) -> DataFrame:
    """Daily ``station, date, tmax, tmin``; the columns are found by name, in English or Hebrew.

    A file of several stations says in a station column which one a row belongs to. ``station`` overrides it, and names
    the one of a file without such a column (default ``all``)."""
    raw = _scan(spark, path, fmt)
    day = _first_match(raw.columns, DATE_FRAGMENTS)
    if day is None:
        raise ValueError(f"no date column among {raw.columns}")
    tmax, tmin = _first_match(raw.columns, MAX_FRAGMENTS), _first_match(raw.columns, MIN_FRAGMENTS)
    if tmax is None or tmin is None:
        raise ValueError(f"temperature columns: max {tmax}, min {tmin}, available {raw.columns}")
    place = _first_match([c for c in raw.columns if c not in (day, tmax, tmin)], STATION_FRAGMENTS)
    own = F.lit(station or "all") if station or place is None else F.trim(F.col(f"`{place}`"))
    return raw.select(
        own.alias("station"),
        lenient_date(F.col(f"`{day}`"), WEATHER_DATES).alias("date"),
        lenient_double(F.col(f"`{tmax}`")).alias("tmax"),
        lenient_double(F.col(f"`{tmin}`")).alias("tmin"),
    )


def read_holidays(spark: SparkSession, path) -> DataFrame:
    """``ds, name, seq`` from the first two columns, whatever they are called; ``seq`` orders the rows by
    file path, then by place in the file."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8")
    day, name = raw.columns[:2]
    rows = raw.select(
        lenient_date(F.col(f"`{day}`"), HOLIDAY_DATES).alias("ds"),
        F.col(f"`{name}`").alias("name"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # One row per file block: its rank among the blocks, and the first number of its rows.
    by_place = Window.orderBy("_file", "_start")
    blocks = rows.groupBy("_file", "_start").agg(F.min("_at").alias("_first"))
    blocks = blocks.withColumn("_rank", F.row_number().over(by_place).cast("long"))
    numbered = rows.join(F.broadcast(blocks), ["_file", "_start"])
    return numbered.select("ds", "name", (F.col("_rank") * (1 << 40) + F.col("_at") - F.col("_first")).alias("seq"))
