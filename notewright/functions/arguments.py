"""Checks and splits of request arguments; plain driver-side Python."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

TEXT_PREFIX = "text."


class InvalidFields(ValueError):
    """Requested text fields that the dataset does not have."""

    def __init__(self, invalid: list[str], available: list[str]):
        super().__init__(f"Invalid text fields: {invalid}. Available fields: {available}")
        self.invalid = invalid
        self.available = available


def within(name: str, value: int, low: int, high: int | None = None) -> int:
    """Reject a value outside its bounds."""
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be {f'at least {low}' if high is None else f'from {low} to {high}'}, got {value}")
    return value


def clamp(value: int, low: int, high: int) -> int:
    """Pull a value into its bounds."""
    return max(low, min(high, value))


def split_filters(
    parameters: Mapping[str, Any], text_fields: Iterable[str], metadata_fields: Iterable[str]
) -> tuple[dict[str, str], dict[str, str]]:
    """Split flat parameters into text-field and metadata filters; unknown names are dropped."""
    text_fields, metadata_fields = set(text_fields), set(metadata_fields)
    text: dict[str, str] = {}
    metadata: dict[str, str] = {}
    for name, value in parameters.items():
        if name.startswith(TEXT_PREFIX):
            field = name[len(TEXT_PREFIX) :]
            if field in text_fields:
                text[field] = str(value)
        elif name in metadata_fields:
            metadata[name] = str(value)
    return text, metadata


def requested_fields(fields: str | Iterable[str] | None, available: Iterable[str]) -> list[str] | None:
    """Validate requested fields. A string is cut at commas, without trimming; empty means all."""
    if not fields:
        return None
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    available = list(available)
    invalid = [name for name in names if name not in available]
    if invalid:
        raise InvalidFields(invalid, available)
    return names


def preferred_fields(preferred: Iterable[str], available: Iterable[str]) -> list[str]:
    """Preferred fields that exist, in preferred order."""
    available = set(available)
    return [name for name in preferred if name in available]
