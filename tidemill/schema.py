"""Committed schemas: one YAML file a dataset, with the tables' columns."""

from __future__ import annotations

from pathlib import Path
from typing import TYPE_CHECKING

from pyspark.sql import types as T

from .operators.profile.propose import Column

if TYPE_CHECKING:
    from .config import Dataset


def schema_path(dataset: Dataset) -> Path:
    return Path(dataset.schema_dir) / "import" / f"{dataset.schema_name}.schema.yaml"


def committed_schema(dataset: Dataset) -> dict[str, dict]:
    """Tables by name, each with ``columns`` and, for child tables, ``parent``; empty if nothing is committed."""
    import yaml

    path = schema_path(dataset)
    return (yaml.safe_load(path.read_text()) or {}).get("tables", {}) if path.exists() else {}


def committed_columns(dataset: Dataset, table: str) -> list[Column]:
    columns = committed_schema(dataset).get(table, {}).get("columns", {})
    return [Column(name, **spec) for name, spec in columns.items()]


def committed_types(dataset: Dataset, table: str) -> T.StructType | None:
    """What readers and writers are to use; metadata columns (leading underscore) are left out."""
    fields = [c.field() for c in committed_columns(dataset, table) if not c.name.startswith("_")]
    return T.StructType(fields) if fields else None


def write_schema(dataset: Dataset, tables: dict[str, dict]) -> Path:
    """Put tables into the dataset's file; others there stay."""
    import yaml

    held = committed_schema(dataset) | tables
    path = schema_path(dataset)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(yaml.safe_dump({"version": 1, "name": dataset.schema_name, "tables": held}, sort_keys=False, allow_unicode=True))
    return path
