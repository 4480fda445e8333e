"""Column expressions on paths, Python regexes and strptime formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    """What stands before the last slash; empty if there is none."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def first_part(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def match_path(path: Column) -> Column:
    """The path that patterns see: a member of an archive stands next to the archive."""
    archive, member = F.substring_index(path, "!", 1), F.regexp_extract(path, "!(.*)$", 1)
    folder = dirname(archive)
    return F.when(F.instr(path, "!") > 0, F.when(folder == "", member).otherwise(F.concat(folder, F.lit("/"), member))).otherwise(path)


def group_names(pattern: str) -> dict[str, int]:
    """Named groups of a Python regex and their numbers."""
    return dict(re.compile(pattern).groupindex)


def java_regex(pattern: str) -> str:
    """A Python regex as Java takes it. Groups keep their numbers and lose their names, which Java restricts."""
    names = group_names(pattern)
    out = re.sub(r"\(\?P<\w+>", "(", pattern)
    out = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\{names[m[1]]}", out)
    return out.replace("\\Z", "\\z")


def matches(column: Column, pattern: str) -> Column:
    return column.rlike(java_regex(pattern))


#: strptime directives and Spark's letters (fixed values).
DIRECTIVES = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "f": "SSSSSS", "j": "DDD", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "p": "a", "I": "hh", "z": "xx", "%": "%"}


def spark_format(strptime: str) -> str:
    """``%Y%m%d`` as ``yyyyMMdd``; letters that stand for themselves are quoted."""
    out, literal, i = [], "", 0
    while i <= len(strptime):
        c = strptime[i : i + 1]
        if c and c != "%" and c.isalpha():
            literal += c
            i += 1
            continue
        if literal:
            out.append(f"'{literal}'")
            literal = ""
        if c == "%":
            directive = strptime[i + 1 : i + 2]
            if directive not in DIRECTIVES:
                raise ValueError(f"%{directive} in {strptime!r} has no counterpart")
            out.append(DIRECTIVES[directive])
            i += 2
        else:
            out.append("''" if c == "'" else c)
            i += 1
    return "".join(out)


def parse_date(text: Column, strptime: str) -> Column:
    """The date, or the start of the period where the format has no day; an error if it doesn't parse."""
    return F.to_date(text, spark_format(strptime))
