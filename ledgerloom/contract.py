"""Declarative table contracts and input specifications."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


def _as_list(value):
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


@dataclass(frozen=True)
class TableContract:
    """Name, place, key, columns and layout of a table.

    ``columns`` are dicts in Spark's JSON schema form, with optional ``tests``.
    """

    name: str
    location: str
    unique_key: list = field(default_factory=list)
    columns: tuple = ()
    partition_by: list = field(default_factory=list)
    format: str = "parquet"
    options: dict = field(default_factory=dict)
    load_date: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "unique_key", _as_list(self.unique_key))
        object.__setattr__(self, "partition_by", _as_list(self.partition_by))

    @property
    def struct_type(self):
        """D3: the declared schema; null checks belong to the quality suite."""
        if not self.columns:
            return None
        return StructType.fromJson(
            {
                "fields": [
                    {
                        "name": column["name"],
                        "type": column["type"],
                        "nullable": True,
                        "metadata": column.get("metadata") or {},
                    }
                    for column in self.columns
                ]
            }
        )

    @property
    def required(self):
        """Columns declared as never null."""
        return [c["name"] for c in self.columns if c.get("nullable") is False]


@dataclass(frozen=True)
class SourceSpec:
    """One input: where it lies, how to read it, which rows to take."""

    name: str
    location: str | list
    record_source: str = ""
    format: str = "parquet"
    filter: str | None = None
    options: dict = field(default_factory=dict)
    schema: StructType | None = None
    load_date: str | None = None
    source_version: str | None = None


def fill_placeholders(value, values):
    """``{{name}}`` in the texts of a nested contract replaced by given values."""
    if isinstance(value, str):
        def replace(match):
            return str(values[match.group(1)])

        return re.sub(r"\{\{\s*(\w+)\s*\}\}", replace, value)
    if isinstance(value, dict):
        return {key: fill_placeholders(item, values) for key, item in value.items()}
    if isinstance(value, list):
        return [fill_placeholders(item, values) for item in value]
    return value


def merge_contracts(*parts):
    """Several contract dicts as one: lists add up, other values replace."""
    merged = {}
    for part in parts:
        for key, value in part.items():
            both = isinstance(value, list) and isinstance(merged.get(key), list)
            merged[key] = merged[key] + value if both else value
    return merged


def load_contract(text_or_dict, **values):
    """A (TableContract, [SourceSpec], reconciles) triple from JSON text or a dict."""
    raw = json.loads(text_or_dict) if isinstance(text_or_dict, str) else text_or_dict
    raw = fill_placeholders(raw, values)
    contract = TableContract(**{**raw["model"], "columns": tuple(raw["model"].get("columns", ()))})
    sources = [SourceSpec(**item) for item in raw.get("input_resources", [])]
    return contract, sources, raw.get("reconciles", [])
