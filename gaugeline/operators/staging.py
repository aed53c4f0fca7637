"""From raw readings to typed, flagged, enriched rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from gaugeline.functions import calendar as cal
from gaugeline.operators import frames
from gaugeline.schema import SeriesSpec

WEATHER = SeriesSpec(tie_break=("record_id",))


# -- staging -----------------------------------------------------------------------------------


def require_keys(df: DataFrame, spec: SeriesSpec = WEATHER) -> DataFrame:
    return df.dropna(subset=[spec.time, spec.entity])


def calendar_parts(df: DataFrame, spec: SeriesSpec = WEATHER, tz: str | None = None) -> DataFrame:
    time = cal.local_time(spec.time, tz)
    return df.withColumns(
        {
            spec.day: F.to_date(time),
            "hour": F.hour(time),
            "day": F.dayofmonth(time),
            "month": F.month(time),
            "year": F.year(time),
            "day_of_week": cal.day_of_week(time),
            "week_of_year": F.weekofyear(time),
            "quarter": F.quarter(time),
        }
    )


def missing_flags(df: DataFrame, measures=("temperature", "humidity", "precipitation")) -> DataFrame:
    return df.withColumns({f"has_missing_{m}": F.col(m).isNull().cast("int") for m in measures})


def stage(raw: DataFrame, spec: SeriesSpec = WEATHER, tz: str | None = None) -> DataFrame:
    return missing_flags(calendar_parts(require_keys(raw, spec), spec, tz))


# -- quality gate ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Gate:
    """The valid range of a measure, what an outlier becomes, and how a gap is filled
    (``None``: by the mean of neighbouring rows)."""

    measure: str
    flag: str
    low: float | None
    high: float | None
    outlier_value: float | None = None
    gap_value: float | None = None

    def is_outlier(self):
        column = F.col(self.measure)
        tests = [column < self.low] if self.low is not None else []
        tests += [column > self.high] if self.high is not None else []
        test = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        return F.coalesce(test, F.lit(False))


# Valid ranges of the five gated measures.
GATES = (
    Gate("temperature", "temp_outlier_flag", -50.0, 60.0),
    Gate("humidity", "humidity_outlier_flag", 0.0, 100.0),
    Gate("precipitation", "precip_outlier_flag", 0.0, None, outlier_value=0.0, gap_value=0.0),
    Gate("pressure", "pressure_outlier_flag", 950.0, 1050.0),
    Gate("wind_speed", "wind_speed_outlier_flag", 0.0, 150.0),
)
OUTLIER_PENALTY = 20
MINIMUM_SCORE = 60
NEIGHBOURS = 2


def outlier_flags(df: DataFrame, gates=GATES) -> DataFrame:
    return df.withColumns({g.flag: g.is_outlier().cast("int") for g in gates})


def clean_outliers(df: DataFrame, gates=GATES) -> DataFrame:
    return df.withColumns(
        {
            g.measure: F.when(F.col(g.flag) == 1, F.lit(g.outlier_value).cast("double")).otherwise(F.col(g.measure))
            for g in gates
        }
    )


def fill_gaps(
    df: DataFrame,
    spec: SeriesSpec = WEATHER,
    gates=GATES,
    reach: int = NEIGHBOURS,
    limit: int | None = None,
    block_rows: int = frames.BLOCK_ROWS,
) -> DataFrame:
    """Fill NULLs from up to ``reach`` rows on either side within the entity's day.

    A day of one entity holds as many rows as it has readings, so its window is small; pass
    ``limit`` for readings so dense that a day exceeds a task.
    """
    constant = [g for g in gates if g.gap_value is not None]
    averaged = [g for g in gates if g.gap_value is None]
    df = df.withColumns({g.measure: F.coalesce(F.col(g.measure), F.lit(g.gap_value)) for g in constant})

    def build(window: WindowSpec):
        near = window.rowsBetween(-reach, reach)
        return {g.measure: F.coalesce(F.col(g.measure), F.avg(g.measure).over(near)) for g in averaged}

    return frames.over_rows(
        df, [spec.entity, spec.day], spec.order, build, before=reach, after=reach, limit=limit, block_rows=block_rows
    )


def quality_score(df: DataFrame, gates=GATES) -> DataFrame:
    flags = sum((F.col(g.flag) for g in gates[1:]), F.col(gates[0].flag))
    return df.withColumn("data_quality_score", F.lit(100) - flags * OUTLIER_PENALTY)


def keep_reliable(df: DataFrame, minimum: int = MINIMUM_SCORE) -> DataFrame:
    return df.filter(F.col("data_quality_score") >= minimum)


def check_quality(staged: DataFrame, spec: SeriesSpec = WEATHER, gates=GATES, **fill) -> DataFrame:
    """Flags, cleaning, score and gap filling. Neighbours are taken before unreliable rows are
    dropped, so a dropped row still lends its valid measures to the rows around it; the score is
    known before, so that a consumer of the score alone moves one number instead of all flags."""
    flagged = outlier_flags(staged, gates).drop(*[c for c in staged.columns if c.startswith("has_missing_")])
    return keep_reliable(fill_gaps(quality_score(clean_outliers(flagged, gates), gates), spec, gates, **fill))


# -- enrichment --------------------------------------------------------------------------------

# Thresholds of the hourly condition flags and the intensity bands (mm).
HOT, COLD, HUMID, WINDY, CLOUDY = 32.0, 20.0, 80.0, 20.0, 70.0
INTENSITY_BANDS = ((2.5, "Light Rain"), (10.0, "Moderate Rain"), (50.0, "Heavy Rain"))


def calendar_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "season": cal.season("month"),
            "time_of_day": cal.time_of_day("hour"),
            "day_name": cal.day_name("day_of_week"),
            "month_name": cal.month_name("month"),
            "is_weekend": cal.weekend_flag("day_of_week"),
        }
    )


def condition_flags(df: DataFrame) -> DataFrame:
    conditions = {
        "is_raining": F.col("precipitation") > 0,
        "is_hot": F.col("temperature") > HOT,
        "is_cold": F.col("temperature") < COLD,
        "is_humid": F.col("humidity") > HUMID,
        "is_windy": F.col("wind_speed") > WINDY,
        "is_cloudy": F.col("cloud_cover") > CLOUDY,
    }
    return df.withColumns({name: F.coalesce(test, F.lit(False)).cast("int") for name, test in conditions.items()})


def comfort_indices(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "temp_humidity_index": F.col("temperature") + F.col("humidity") / 100.0 * 5,
            "wind_chill_index": F.col("temperature") - F.col("wind_speed") / 10.0,
        }
    )


def precipitation_intensity(df: DataFrame) -> DataFrame:
    rain = F.col("precipitation")
    band = F.when(rain == 0, "No Rain")
    for upper, label in INTENSITY_BANDS:
        band = band.when(rain < upper, label)
    return df.withColumn("precipitation_intensity", band.otherwise("Very Heavy Rain"))


def enrich(checked: DataFrame) -> DataFrame:
    return precipitation_intensity(comfort_indices(condition_flags(calendar_labels(checked))))
