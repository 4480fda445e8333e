"""Which files belong to a table, their business date, attributes and logical identity, as Column expressions.

The path is ``<subset>/<path below the subset's root>``; members of archives are matched next to their archive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal, Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import paths


class Source(Protocol):
    """``classify`` gives a struct (business_date, attributes, identity) or null for a path; see ``from_function`` for Python code."""

    on_collision: Literal["latest", "first"]

    @property
    def attribute_names(self) -> tuple[str, ...]: ...

    def expands(self, path: Column) -> Column: ...

    def classify(self, path: Column) -> Column: ...


CLASSIFIED = "struct<business_date:date,attributes:map<string,string>,identity:string>"
#: An identity rule: (path, date, attributes by name) to a Column.
Identity = Callable[[Column, Column, dict[str, Column]], Column]


def pairs(attributes: dict[str, Column]) -> list[Column]:
    return [F.concat(F.lit(f"{k}="), F.coalesce(v, F.lit("None"))) for k, v in sorted(attributes.items())]


def default_identity(path: Column, day: Column, attributes: dict[str, Column]) -> Column:
    """Subset, file name, date and attributes: moves within a subset keep it."""
    return F.concat_ws("|", paths.first_part(path), paths.basename(path), day.cast("string"), *pairs(attributes))


def across_subsets(path: Column, day: Column, attributes: dict[str, Column]) -> Column:
    """File name and attributes: moves between subsets keep it."""
    return F.concat_ws("|", paths.basename(path), *pairs(attributes))


@dataclass(frozen=True)
class Patterns:
    """Python regexes; the first of ``select`` that is found decides.

    The date is the group ``date``, or else the only group, if it has no name. Other named groups are attributes; one that took no
    part, or matched nothing, is null.
    """

    select: tuple[str, ...]
    ignore: tuple[str, ...] = ()
    archives: tuple[str, ...] = ()
    date_format: str = "%Y-%m-%d"
    identity: Identity | None = None
    on_collision: Literal["latest", "first"] = "latest"

    def __post_init__(self) -> None:
        for p in self.select:
            self.date_group(p)

    @staticmethod
    def date_group(pattern: str) -> int:
        import re

        names, n = paths.group_names(pattern), re.compile(pattern).groups
        if "date" in names:
            return names["date"]
        if n and 1 not in names.values():
            return 1
        raise ValueError(f"pattern {pattern!r} needs a group named date, or an unnamed first group")

    @property
    def attribute_names(self) -> tuple[str, ...]:
        return tuple(sorted({g for p in self.select for g in paths.group_names(p)} - {"date"}))

    def expands(self, path: Column) -> Column:
        out = F.lit(False)
        for p in self.archives:
            out = out | paths.matches(path, p)
        return out

    def classify(self, path: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast(CLASSIFIED))
        for p in self.ignore:
            out = out.when(paths.matches(path, p), F.lit(None).cast(CLASSIFIED))
        for p in self.select:
            java = paths.java_regex(p)
            group = lambda i: F.nullif(F.regexp_extract(path, java, i), F.lit(""))  # noqa: B023, E731
            attributes = {k: group(i) for k, i in paths.group_names(p).items() if k != "date"}
            day = paths.parse_date(group(self.date_group(p)), self.date_format)
            held = F.create_map(*[x for k, v in attributes.items() for x in (F.lit(k), v)]) if attributes else F.create_map().cast("map<string,string>")
            identity = (self.identity or default_identity)(path, day, attributes)
            out = out.when(paths.matches(path, p), F.struct(day.alias("business_date"), held.alias("attributes"), identity.alias("identity")))
        return out


@dataclass(frozen=True)
class FunctionSource:
    """Any Python function of a path that returns (date, attributes, identity) or None, for names that patterns can't express."""

    fn: Callable
    attribute_names: tuple[str, ...] = ()
    archives: tuple[str, ...] = ()
    on_collision: Literal["latest", "first"] = "latest"

    def expands(self, path: Column) -> Column:
        return Patterns((), archives=self.archives).expands(path)

    def classify(self, path: Column) -> Column:
        return F.udf(self.fn, CLASSIFIED)(path)
