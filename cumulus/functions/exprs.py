"""Column expressions shared by the pipelines.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen
(no Python UDFs anywhere in this package).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Wind classes (km/h, upper bounds exclusive): <5 Calm, <15 Light,
# <25 Moderate, <35 Strong, otherwise (NULL too) Very Strong.
# Climate zones on |latitude| (lower bounds exclusive): >60 Polar,
# >40 Temperate, >23.5 Subtropical, otherwise (NULL too) Tropical.
# Variance classes: >5 High Variability, >2 Moderate Variability,
# NULL No Data, otherwise Low Variability.
# Secret mask: first 4 characters, then "*****", then the last 4 characters
# when longer than 8, else "****". Missing values print as "Not found".
# Metric timestamp format: yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z' (no zone shift).
# ---------------------------------------------------------------------------
WIND_CLASSES = [(5, "Calm"), (15, "Light"), (25, "Moderate"), (35, "Strong")]
WIND_TOP_CLASS = "Very Strong"
CLIMATE_ZONES = [(60, "Polar"), (40, "Temperate"), (23.5, "Subtropical")]
CLIMATE_DEFAULT = "Tropical"
VARIANCE_HIGH, VARIANCE_MODERATE = 5, 2
MASK_KEEP, MASK_FILL, MASK_SHORT_TAIL, MASK_MIN_LEN = 4, "*****", "****", 8
NOT_FOUND = "Not found"
RFC3339_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A date parameter (ISO string, date or Column) as a DATE column."""
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def as_timestamp(t) -> Column:
    """A timestamp parameter as TIMESTAMP_NTZ; ``None`` means the current time."""
    if t is None:
        return F.localtimestamp()
    return t if isinstance(t, Column) else F.lit(str(t)).cast("timestamp_ntz")


def c_to_f(c: Column | str) -> Column:
    """Celsius to Fahrenheit, evaluated left to right as ``t*9/5+32``."""
    return _col(c) * 9 / 5 + 32


def c_to_k(c: Column | str) -> Column:
    return _col(c) + 273.15


def wind_category(speed: Column | str) -> Column:
    s = _col(speed)
    out = None
    for bound, label in WIND_CLASSES:
        out = F.when(s < bound, label) if out is None else out.when(s < bound, label)
    return out.otherwise(WIND_TOP_CLASS)


def climate_zone(latitude: Column | str) -> Column:
    a = F.abs(_col(latitude))
    out = None
    for bound, label in CLIMATE_ZONES:
        out = F.when(a > bound, label) if out is None else out.when(a > bound, label)
    return out.otherwise(CLIMATE_DEFAULT)


def comfort_index(temperature: Column | str, windspeed: Column | str,
                  latitude: Column | str, std_calc: Column | str | float = 0.0) -> Column:
    """``100 - |t-22|*2 - wind*0.5 + sin(lat°)*10 + std_calc*1e-5``."""
    std = F.lit(std_calc) if isinstance(std_calc, (int, float)) else _col(std_calc)
    return (F.lit(100) - F.abs(_col(temperature) - 22) * 2 - _col(windspeed) * 0.5
            + F.sin(_col(latitude) * F.pi() / 180) * 10 + std * 0.00001)


def variance_category(variance: Column | str) -> Column:
    v = _col(variance)
    return (F.when(v > VARIANCE_HIGH, "High Variability")
            .when(v > VARIANCE_MODERATE, "Moderate Variability")
            .when(v.isNull(), "No Data")
            .otherwise("Low Variability"))


def round_half_up(x: Column | str, digits: int) -> Column:
    """ROUND half away from zero, of the value itself (2.2499997 gives 2.2)."""
    return F.round(_col(x).cast("double"), digits)


def fix_scale(x: Column | str, digits: int) -> Column:
    """Fix a double to ``digits`` decimals (presentation / comparison)."""
    return _col(x).cast(f"decimal(38,{digits})").cast("double")


def mask_secret(c: Column | str) -> Column:
    s = _col(c)
    tail = F.when(F.length(s) > MASK_MIN_LEN, F.right(s, F.lit(MASK_KEEP))).otherwise(MASK_SHORT_TAIL)
    return F.concat(F.substring(s, 1, MASK_KEEP), F.lit(MASK_FILL), tail)


def default_missing(c: Column | str, default: str = NOT_FOUND) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def rfc3339(ts: Column | str) -> Column:
    return F.date_format(_col(ts), RFC3339_MICROS)


def concat_name(first: Column | str, last: Column | str) -> Column:
    """``first || ' ' || last`` — NULL when either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))
