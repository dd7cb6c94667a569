"""Holiday table: two sources, one name per date, groups, first day per group and year."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import as_date
from panelcast.functions.scalars import clean_name

# Holiday groups and the raw names that belong to them.
HOLIDAY_GROUPS = {
    "rosh_hashana": ("rosh_hashana", "rosh_hashanah", "rosh hashana", "rosh_hashana_(day_2)", "rosh_hashana_eve"),
    "yom_kippur": ("yom_kippur", "yom_kippur_eve"),
    "sukkot": (
        "sukkot", "sukkot_eve", "sukkot_(day_1)", "sukkot_(day_2)", "sukkot_(day_3)",
        "sukkot_(day_4)", "sukkot_(day_5)", "sukkot_(day_6)",
        "sukkot_(day_7)_/_hoshanah_rabah", "shemini_atzeret_/_simchat_torah",
        "simchat_torah_/_shemini_atzeret",
    ),
    "hanukkah": (
        "hanukkah_(day_1)", "hanukkah_(day_2)", "hanukkah_(day_3)", "hanukkah_(day_4)",
        "hanukkah_(day_5)", "hanukkah_(day_6)", "hanukkah_(day_7)", "hanukkah_(day_8)",
        "hanukkah_(day_6)_/_rosh_chodesh_tevet",
    ),
    "pesach": (
        "pesach", "passover_eve", "passover_(day_1)", "passover_(day_2)", "passover_(day_3)",
        "passover_(day_4)", "passover_(day_5)", "passover_(day_6)", "passover_(day_7)",
        "seventh_day_of_pesach",
    ),
    "purim": ("purim", "fast_of_esther", "shushan_purim_(jerusalem)"),
    "shavuot": ("shavuot", "shavuot_eve"),
    "independence": ("yom_haatzmaut", "independence_day", "independence_day_(observed)"),
    "memorial_days": ("yom_hazikaron", "yom_hashoah", "holocaust_remembrance_day"),
}
LONG_HOLIDAYS = ("sukkot", "pesach", "hanukkah")
OTHER = "other"


@dataclass(frozen=True)
class HolidayRules:
    groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: HOLIDAY_GROUPS)
    long_holidays: Sequence[str] = LONG_HOLIDAYS
    short_window: int = 7
    long_window: int = 14
    # "as_is" looks names up as they come; most spell blanks where the groups have underscores.
    # "underscore" replaces blanks first.
    normalize: str = "as_is"

    def __post_init__(self):
        if self.normalize not in ("as_is", "underscore"):
            raise ValueError(f"unknown name mode {self.normalize!r}")


def stack_sources(primary: DataFrame, *others: DataFrame) -> DataFrame:
    """Sources with columns ``ds, name`` (and optionally ``seq``, the row's place in its source),
    cleaned, NULLs dropped, numbered by source."""
    parts = []
    for rank, source in enumerate((primary, *others)):
        seq = F.col("seq").cast("long") if "seq" in source.columns else F.lit(0).cast("long")
        parts.append(
            source.select(
                "ds", clean_name(F.col("name")).alias("name"), F.lit(rank).alias("source"), seq.alias("seq")
            )
        )
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.dropna(subset=["ds", "name"])


def one_per_date(stacked: DataFrame) -> DataFrame:
    """Keep one row per date: the primary source first, then the source's own order.

    Rows shrink to one per date, source and name in a hash aggregate before any sort or shuffle, so a
    date that holds a large share of the rows costs a few rows per map task.
    """
    names = stacked.groupBy("ds", "source", "name").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("n"))
    return names.groupBy("ds").agg(
        F.min(F.struct("source", "seq", "name")).alias("kept"), (F.sum("n") - 1).alias("n_dropped")
    ).select("ds", "kept.name", "n_dropped")


def to_group(name: Column, rules: HolidayRules = HolidayRules()) -> Column:
    """Group of a cleaned name, ``other`` when no group lists it."""
    if rules.normalize == "underscore":
        name = F.regexp_replace(name, r"\s+", "_")
    # A name listed twice belongs to the group listed last.
    hits = [F.when(name.isin(*names), F.lit(g)) for g, names in reversed(list(rules.groups.items()))]
    return F.coalesce(*hits, F.lit(OTHER))


def first_per_year(dated: DataFrame) -> DataFrame:
    """Earliest date per calendar year and group."""
    return dated.groupBy(F.year("ds").alias("year"), "holiday").agg(F.min("ds").alias("ds"))


def with_windows(df: DataFrame, rules: HolidayRules = HolidayRules()) -> DataFrame:
    return df.withColumns(
        {
            "lower_window": F.lit(0),
            "upper_window": F.when(
                F.col("holiday").isin(*rules.long_holidays), rules.long_window
            ).otherwise(rules.short_window),
        }
    )


def holiday_table(
    sources: Sequence[DataFrame], start, end, rules: HolidayRules = HolidayRules()
) -> DataFrame:
    """``holiday, ds, lower_window, upper_window``; the date range applies to the first days."""
    dates = one_per_date(stack_sources(*sources))
    grouped = dates.select("ds", to_group(F.col("name"), rules).alias("holiday"))
    firsts = first_per_year(grouped).select("holiday", "ds")
    return with_windows(firsts, rules).filter(
        F.col("ds").between(F.lit(as_date(start)), F.lit(as_date(end)))
    )
