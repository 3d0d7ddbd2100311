"""Column expressions of the flight data model. All are built-in, JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeropunct.schema import CAUSE_COLUMNS

# ---------------------------------------------------------------------------
# Labels and limits of the reports.
# ---------------------------------------------------------------------------
BANDS = ("LOW", "MEDIUM", "HIGH")
BAND_UNKNOWN = "UNKNOWN"
BAND_MEDIUM_FROM = 15
BAND_HIGH_ABOVE = 60

CAUSE_LABELS = ("CARRIER", "WEATHER", "NAS", "SECURITY", "LATE_AIRCRAFT")
CAUSE_NONE = "NONE"

BRACKETS = ("On Time / Early", "Slight (<15m)", "Medium (15-60m)", "Severe (>60m)")

CANCELLATION_NAMES = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National Air System",
    "D": "Security",
}
CANCELLATION_OTHER = "Unknown"

MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

CAUSE_TITLES = {
    "late_aircraft_delay": "Late Aircraft",
    "carrier_delay": "Carrier",
    "nas_delay": "National Air System (NAS)",
    "weather_delay": "Weather",
    "security_delay": "Security",
}

# Report text: label, unit. Fields are joined by " | ".
STATS_TEXT = {
    "total_flights": ("Flights Operated", ""),
    "min_arr_delay": ("Min Arr Delay", " min"),
    "max_arr_delay": ("Max Arr Delay", " min"),
    "avg_arr_delay": ("Avg Arr Delay", " min"),
    "cancelation_rate": ("Cancel Rate", "%"),
    "months_of_operation": ("Months of operation", ""),
}

DATASET_PATTERN = r"flight_(\d+)"
# ---------------------------------------------------------------------------


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_float(c: Column | str) -> Column:
    """To float; text that is no number gives null."""
    return _column(c).try_cast("float")


def as_int(c: Column | str) -> Column:
    """To int, cutting decimals; text goes through double so that ``12.0`` reads as 12."""
    return _column(c).try_cast("double").try_cast("int")


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(_column(c).try_cast("double"), F.lit(0.0))


def hour_of(hhmm: Column | str) -> Column:
    """Hour of an HHMM clock value; 2400 gives 24."""
    return (as_int(hhmm) / 100).cast("int")


def delay_band(delay: Column | str) -> Column:
    """Reporting band of a delay: under 15, 15 to 60, above 60, or unknown."""
    d = _column(delay)
    return (
        F.when(d < BAND_MEDIUM_FROM, BANDS[0])
        .when(d <= BAND_HIGH_ABOVE, BANDS[1])
        .when(d > BAND_HIGH_ABOVE, BANDS[2])
        .otherwise(BAND_UNKNOWN)
    )


def delay_bracket(delay: Column | str) -> Column:
    """Exploratory bracket of a departure delay; its edges belong to the lower side."""
    d = _column(delay)
    return (
        F.when(d <= 0, BRACKETS[0])
        .when(d <= 15, BRACKETS[1])
        .when(d <= 60, BRACKETS[2])
        .otherwise(BRACKETS[3])
    )


def primary_cause() -> Column:
    """Cancellation cause, else the cause with most minutes (first wins a tie), else NONE."""
    peak = F.greatest(*CAUSE_COLUMNS)
    # The first position that holds the peak: a tie goes to the earlier cause.
    place = F.call_function("array_position", F.array(*CAUSE_COLUMNS), peak)
    strongest = F.element_at(F.array(*[F.lit(label) for label in CAUSE_LABELS]), place.cast("int"))
    cancelled = F.concat(
        F.lit("CANCELLED_"), F.coalesce("cancellation_code", F.lit(CANCELLATION_OTHER.upper()))
    )
    return (
        F.when(F.col("cancelled") == 1, cancelled)
        .when(peak > 0, strongest)
        .otherwise(CAUSE_NONE)
    )


def has_cause() -> Column:
    """True where :func:`primary_cause` is not NONE."""
    return F.coalesce(
        (F.col("cancelled") == 1) | (F.greatest(*CAUSE_COLUMNS) > 0), F.lit(False)
    )


def decode_code(code: Column | str) -> Column:
    """Readable cancellation reason."""
    c = _column(code)
    known = reduce(
        lambda chain, item: chain.when(c == item[0], item[1]),
        CANCELLATION_NAMES.items(),
        F,
    )
    return known.otherwise(CANCELLATION_OTHER)


def month_name(month: Column | str) -> Column:
    """Short English month name; null outside 1 to 12."""
    return F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), _column(month) - 1)


def scale_pct(dataset: Column | str) -> Column:
    """Size in percent from a data set name; names of samples give 0, as do others."""
    c = _column(dataset)
    digits = F.regexp_extract(c, DATASET_PATTERN, 1).try_cast("int")
    return F.when(c.contains("sample"), 0).otherwise(F.coalesce(digits, F.lit(0)))


def file_name(path: Column | str) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(_column(path), "/"), -1)


def is_missing(c: Column | str, text: bool = True) -> Column:
    """Null or, in a text column, empty."""
    col = _column(c)
    return col.isNull() | (col == "") if text else col.isNull()


def months_text(months: Column | str) -> Column:
    """``[1, 2, 3]``."""
    listed = F.array_join(_column(months).cast("array<string>"), ", ")
    return F.concat(F.lit("["), listed, F.lit("]"))


def stats_text() -> Column:
    """One line of report text from the statistics columns."""
    parts = []
    for name, (label, unit) in STATS_TEXT.items():
        if name == "months_of_operation":
            value = months_text(name)
        elif name == "total_flights":
            value = F.col(name).cast("string")
        else:
            value = F.format_string("%.2f", F.col(name).cast("double"))
        parts.append(F.concat(F.lit(f"{label}: "), value, F.lit(unit)))
    return F.concat_ws(" | ", *parts)


def stats_field(value: Column | str, name: str) -> Column:
    """One field of the report text, as text; empty when it is absent."""
    label, _ = STATS_TEXT[name]
    content = r"\[([^\]]*)\]" if name == "months_of_operation" else r"(-?[0-9.]+)"
    return F.regexp_extract(_column(value), f"{label}: *{content}", 1)
