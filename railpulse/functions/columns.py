"""Column expressions shared by the operators. All of them are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railpulse.schemas import COMPUTED, TIME_FORMAT


def sensor_key(sensor_id) -> Column:
    """``5`` to ``S5``, the form used by the dimension tables."""
    return F.concat(F.lit("S"), F.col(sensor_id).cast("string"))


def train_key(train_id) -> Column:
    return F.concat(F.lit("T"), F.col(train_id).cast("string"))


def bare_sensor(sensor_key_col) -> Column:
    """``S5`` to ``5``; only a leading ``S`` goes."""
    return F.regexp_replace(F.col(sensor_key_col).cast("string"), "^S", "")


def line_label(line_id, colour) -> Column:
    return F.concat(F.col(line_id), F.lit(" - "), F.col(colour))


def below(distance, threshold) -> Column:
    """1 where the measured distance is under the threshold, else 0."""
    return F.when(F.col(distance) < threshold, 1).otherwise(0)


def block_of(coordinate, size: int) -> Column:
    """Block number of a grid coordinate, rounding towards minus infinity."""
    return F.floor(F.col(coordinate) / size).cast("int")


def seconds_between(start, end) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def km_per_hour(metres, seconds) -> Column:
    """Null where no time passed."""
    return F.try_divide(metres, seconds) * 3.6


def rendered(time) -> Column:
    """A timestamp in the text form of the trusted and client zones."""
    return F.date_format(time, TIME_FORMAT)


# What a decimal may differ from its double: less than any place but the last of ``COMPUTED``.
ROUNDED_OFF = 1e-20


def as_decimal(number, kind: str = COMPUTED) -> Column:
    """The sink form of a double, digit for digit as it prints; null stays null.

    A number that ``kind`` does not hold fails the write; only digits beyond the 24th place are rounded off.
    """
    value, digits = F.col(number), F.col(number).try_cast(kind)
    lost = value.isNotNull() & (digits.isNull() | (F.abs(digits.cast("double") - value) > ROUNDED_OFF))
    failed = F.raise_error(F.concat(F.lit(f"{number} does not fit {kind}: "), value.cast("string")))
    return F.when(lost, failed.cast(kind)).otherwise(digits)
