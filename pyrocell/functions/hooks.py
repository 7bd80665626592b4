"""Functions by data set and by sensor, to which a user adds their own.

``data_set("name")`` registers how a reference product becomes burned months (DataFrame and source name to pixel_id,
year, month, source); ``clear_test("sensor")`` how a sensor's quality band is tested; ``correction("sensor")`` how its
reflectances are corrected. What isn't registered has the default that the caller gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DATA_SETS: dict[str, Callable] = {}
CLEAR_TESTS: dict[str, Callable[[Column], Column]] = {}
CORRECTIONS: dict[str, Callable[[Column], Column]] = {}


def _adds_to(table: dict[str, Callable], names: tuple[str, ...]):
    def register(f):
        table.update(dict.fromkeys(names, f))
        return f

    return register


def data_set(*names: str):
    return _adds_to(DATA_SETS, names)


def clear_test(*sensors: str):
    return _adds_to(CLEAR_TESTS, sensors)


def correction(*sensors: str):
    return _adds_to(CORRECTIONS, sensors)


def by_sensor(table: dict[str, Callable[[Column], Column]], sensor: Column, value: Column, default: Callable[[Column], Column]) -> Column:
    """The function of each row's sensor applied to ``value``; one expression over all registered sensors."""
    out = None
    for name, f in sorted(table.items()):
        out = F.when(sensor == name, f(value)) if out is None else out.when(sensor == name, f(value))
    return default(value) if out is None else out.otherwise(default(value))
