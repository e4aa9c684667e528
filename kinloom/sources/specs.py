"""A source described as data: its tables, how they join, where fields go."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """One vendor table.

    ``reader`` is ``csv``, ``tsv`` or ``fixed``.  ``layout`` holds (name, start,
    end) slices for fixed width.  Tab files carry no header, so their column
    list is handed to the runner by table name.  ``multi_line`` reads quoted line
    breaks as part of a value, at one task per file; only a table known to hold none
    may turn it off, which lets its files be split.
    """

    name: str
    keep: Sequence[str]
    reader: str = "csv"
    column_count: int | None = None
    lower_header: bool = False
    multi_line: bool = True
    layout: Sequence[tuple[str, int, int]] = ()
    length: int = 0
    add_file_name: bool = False
    transform: Transform | None = None
    date_columns: Sequence[str] = ()
    dedupe_on: str | None = None
    dedupe_formats: Sequence[str] = ()
    before_dedupe: Transform | None = None
    after_dedupe: Transform | None = None


@dataclass(frozen=True)
class SourceSpec:
    """A source system: tables, join, mapping, clock.

    ``mapping`` is a function because column expressions need a live session.
    """

    code: str
    tables: Sequence[TableSpec]
    join: Callable[[Mapping[str, DataFrame]], DataFrame]
    mapping: Callable[[str], Mapping[str, str | Column]]
    clock: str
    timestamps: Sequence[str] = ("record_created_timestamp", "record_last_updated_timestamp")
    exact_names: bool = False
    zone_overrides: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> TableSpec:
        return next(t for t in self.tables if t.name == name)


class Registry:
    """Source code -> spec; the extension point for further sources."""

    def __init__(self) -> None:
        self._specs: dict[str, SourceSpec] = {}

    def add(self, spec: SourceSpec) -> SourceSpec:
        if spec.code in self._specs:
            raise ValueError(f"source {spec.code} already registered")
        self._specs[spec.code] = spec
        return spec

    def get(self, code: str) -> SourceSpec:
        try:
            return self._specs[code.upper()]
        except KeyError:
            raise ValueError(f"unknown source {code}; known: {sorted(self._specs)}") from None

    def codes(self) -> list[str]:
        return sorted(self._specs)


SOURCES = Registry()
