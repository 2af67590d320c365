"""Derived weather measures as Column formulas with plausibility domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import all_present, as_column, in_range

# Coefficients of the published formulas.
MAGNUS_A, MAGNUS_B = 17.625, 243.04
STULL_RH_SCALE, STULL_RH_SHIFT = 0.151977, 8.313659
STULL_RH_CUT = 1.676331
STULL_POWER, STULL_POWER_RATE = 0.00391838, 0.023101
STULL_OFFSET = 4.686035
CHILL_CONST, CHILL_T, CHILL_V, CHILL_TV, CHILL_EXPONENT = 13.12, 0.6215, 11.37, 0.3965, 0.16
HUMIDEX_GAIN, HUMIDEX_BASE_VAPOUR = 0.5555, 10.0
VAPOUR_BASE, VAPOUR_RATE, VAPOUR_REF_K, KELVIN = 6.11, 5417.7530, 273.16, 273.15
KPH_PER_MPS = 3.6

# Plausibility domains (both ends included unless a comment says otherwise).
RH_AIR, RH_DEW = (-90.0, 70.0), (-100.0, 70.0)
WB_AIR, WB_RH, WB_RESULT, WB_ABOVE_AIR = (-80.0, 60.0), (1.0, 100.0), (-100.0, 70.0), 2.0
CHILL_MAX_AIR, CHILL_WIND_KPH = 10.0, (4.8, 200.0)  # lower wind end excluded
HUMIDEX_MIN_AIR, HUMIDEX_DEW = 20.0, (-40.0, 50.0)
APPARENT_RESULT = (-100.0, 70.0)
WIND_SPEED, WIND_DIRECTION = (0.0, 150.0), (0.0, 360.0)
TREND_EPS = 0.5
PRESSURE_GUARDS = {1: 20.0, 3: 30.0, 6: 40.0}  # lag in hours to largest plausible change


def _saturation(t: Column) -> Column:
    return F.exp(F.lit(MAGNUS_A) * t / (F.lit(MAGNUS_B) + t))


def humidity(t: Column | str, td: Column | str) -> Column:
    """Relative humidity in percent from air and dew-point temperature, clamped to 0..100."""
    t, td = as_column(t), as_column(td)
    raw = F.lit(100.0) * _saturation(td) / _saturation(t)
    usable = in_range(t, *RH_AIR) & in_range(td, *RH_DEW)
    return F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)))


def wet_bulb(t: Column | str, rh: Column | str) -> Column:
    """Wet-bulb temperature approximated from air temperature and relative humidity."""
    t, rh = as_column(t), as_column(rh)
    power_term = F.lit(STULL_POWER) * F.pow(rh, F.lit(1.5)) * F.atan(F.lit(STULL_POWER_RATE) * rh)
    raw = (
        t * F.atan(F.lit(STULL_RH_SCALE) * F.sqrt(rh + F.lit(STULL_RH_SHIFT)))
        + F.atan(t + rh)
        - F.atan(rh - F.lit(STULL_RH_CUT))
        + power_term
        - F.lit(STULL_OFFSET)
    )
    usable = (
        in_range(t, *WB_AIR)
        & in_range(rh, *WB_RH)
        & in_range(raw, *WB_RESULT)
        & (raw <= t + F.lit(WB_ABOVE_AIR))
    )
    return F.when(usable, raw)


def wind_chill(t: Column, speed_kph: Column) -> Column:
    v = F.pow(speed_kph, F.lit(CHILL_EXPONENT))
    return F.lit(CHILL_CONST) + F.lit(CHILL_T) * t - F.lit(CHILL_V) * v + F.lit(CHILL_TV) * t * v


def humidex(t: Column, td: Column) -> Column:
    exponent = F.lit(VAPOUR_RATE) * (
        F.lit(1.0) / F.lit(VAPOUR_REF_K) - F.lit(1.0) / (td + F.lit(KELVIN))
    )
    vapour = F.lit(VAPOUR_BASE) * F.exp(exponent)
    return t + F.lit(HUMIDEX_GAIN) * (vapour - F.lit(HUMIDEX_BASE_VAPOUR))


def apparent_temp(t: Column | str, td: Column | str, speed_mps: Column | str) -> Column:
    """Wind chill when cold and windy, humidex when warm and humid, else air temperature."""
    t, td = as_column(t), as_column(td)
    kph = as_column(speed_mps) * F.lit(KPH_PER_MPS)
    low, high = CHILL_WIND_KPH
    cold = (t <= F.lit(CHILL_MAX_AIR)) & (kph > F.lit(low)) & (kph <= F.lit(high))
    warm = (t >= F.lit(HUMIDEX_MIN_AIR)) & in_range(td, *HUMIDEX_DEW)
    felt = F.when(cold, wind_chill(t, kph)).when(warm, humidex(t, td)).otherwise(t)
    return F.when(in_range(felt, *APPARENT_RESULT), felt)


def vector_uv(speed: Column | str, direction: Column | str) -> tuple[Column, Column]:
    """Eastward and northward wind from speed and the direction it blows from."""
    speed, direction = as_column(speed), as_column(direction)
    angle = F.when(direction == F.lit(360.0), F.lit(0.0)).otherwise(direction)
    usable = in_range(speed, *WIND_SPEED) & in_range(angle, *WIND_DIRECTION)
    theta = F.radians(angle)
    return F.when(usable, -speed * F.sin(theta)), F.when(usable, -speed * F.cos(theta))


def trend(delta: Column | str, eps: float = TREND_EPS) -> Column:
    """-1, 0 or 1 by the sign of a change larger than ``eps``; null stays null."""
    d = as_column(delta)
    return F.when(d > F.lit(eps), 1).when(d < F.lit(-eps), -1).when(d.isNotNull(), 0)


def valid_flag(*cols: Column | str) -> Column:
    """1 where every given measure is filled."""
    return F.when(all_present(*cols), 1).otherwise(0)
