"""Declarative description of a table: column roles, rules and features.

Every operator in the package is driven by one of these specifications, so the
same cleaning, profiling and feature code runs on any table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

STRING, INTEGER, LONG, DOUBLE = "string", "int", "bigint", "double"

# The names of the quality flags that every table can have.
MISSING_FLAG = "missing_required_value"
NEGATIVE_FLAG = "negative_numeric_value"
BINARY_FLAG = "invalid_binary_value"
CATEGORY_FLAG = "invalid_category_value"
TARGET_FLAG = "invalid_target_value"


@dataclass(frozen=True)
class ColumnSpec:
    """One input column.

    ``domain`` closes the set of legal values of a category, ``baseline`` is the
    level that gets no one-hot indicator, ``binary`` restricts a number to 0/1.
    """

    name: str
    kind: str = STRING
    domain: tuple[str, ...] = ()
    baseline: str | None = None
    binary: bool = False

    @property
    def numeric(self) -> bool:
        return self.kind in (INTEGER, LONG, DOUBLE)

    @property
    def levels(self) -> tuple[str, ...]:
        """Domain values that get a one-hot indicator."""
        return tuple(v for v in self.domain if v != self.baseline) if self.baseline else ()


@dataclass(frozen=True)
class DateRule:
    """A date assembled from three numeric columns; flagged when it does not exist."""

    flag: str
    year: str
    month: str
    day: str
    output: str


@dataclass(frozen=True)
class SumRule:
    """The sum of ``columns`` has to be positive; ``output`` holds the sum."""

    flag: str
    columns: tuple[str, ...]
    output: str


@dataclass(frozen=True)
class QualityOptions:
    """Switches for cases the default rules let pass."""

    strict_date_parts: bool = False  # month outside 1-12 or day outside 1-31 is no date
    reject_nan: bool = False  # NaN in a numeric column counts as missing
    blank_is_null: bool = False  # text that is empty after trimming counts as missing


@dataclass(frozen=True)
class FeatureSpec:
    """Features of a clean table.

    ``derived`` maps new column names to expressions over clean columns or over
    derived columns of an earlier stage; each element of the tuple is one stage.
    """

    scaled: tuple[str, ...]
    binary: tuple[str, ...] = ()
    one_hot: tuple[str, ...] = ()
    derived: tuple[dict[str, Callable[[], Column]], ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    key: str | None = None
    date: DateRule | None = None
    sums: tuple[SumRule, ...] = ()
    target: str | None = None
    positive_value: str | None = None
    label: str = "label"
    features: FeatureSpec | None = field(default=None, compare=False)
    # Conditions that are counted in reports but reject nothing.
    observed: dict[str, Callable[[], Column]] = field(default_factory=dict, compare=False)

    def __getitem__(self, name: str) -> ColumnSpec:
        for column in self.columns:
            if column.name == name:
                return column
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def numeric(self) -> list[str]:
        return [c.name for c in self.columns if c.numeric]

    @property
    def categorical(self) -> list[str]:
        return [c.name for c in self.columns if c.domain]

    @property
    def binaries(self) -> list[str]:
        return [c.name for c in self.columns if c.binary]

    @property
    def flags(self) -> list[str]:
        """Names of the quality flags this spec produces, in report order."""
        flags = [MISSING_FLAG]
        if self.date:
            flags.append(self.date.flag)
        flags += [rule.flag for rule in self.sums]
        flags.append(NEGATIVE_FLAG)
        if self.binaries:
            flags.append(BINARY_FLAG)
        if self.categorical:
            flags.append(CATEGORY_FLAG)
        if self.target:
            flags.append(TARGET_FLAG)
        return flags

    @property
    def clean_names(self) -> list[str]:
        """Input columns with the assembled date right after its day part."""
        if not self.date:
            return self.names
        at = self.names.index(self.date.day) + 1
        return [*self.names[:at], self.date.output, *self.names[at:]]

    @property
    def raw_schema(self) -> T.StructType:
        """Every column as a nullable string, the way a raw file is read."""
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.names])

    @property
    def one_hot_names(self) -> list[str]:
        return [
            indicator_name(source, level)
            for source in self.feature_spec.one_hot
            for level in self[source].levels
        ]

    @property
    def feature_names(self) -> list[str]:
        f = self.feature_spec
        return [*f.scaled, *f.binary, *self.one_hot_names]

    @property
    def feature_spec(self) -> FeatureSpec:
        if self.features is None:
            raise ValueError(f"table spec {self.name!r} declares no features")
        return self.features


def indicator_name(column: str, level: str) -> str:
    """``column`` and ``level`` joined by an underscore, with only letters and digits
    of the level kept and every run of other characters turned into one underscore."""
    words = re.findall(r"[A-Za-z0-9]+", level)
    return "_".join([column, *words]) if words else f"{column}_"
