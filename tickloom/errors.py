"""Error codes, rejection reasons and segment states, with their texts."""

from __future__ import annotations

from enum import Enum


class Error(Enum):
    CONFIG_NOT_FOUND = "no such config file"
    CONFIG_PARSE = "the config file isn't TOML"
    CONFIG_INVALID = "a setting is missing or wrong"
    FILE_OPEN = "an input can't be opened"
    OUTPUT_OPEN = "an output can't be opened"
    CSV_PARSE = "a row isn't CSV"
    CSV_SCHEMA = "the header lacks a column"
    BOOK_DEPTH_UNSUPPORTED = "books have 1, 5, 10, 15, 20 or 25 levels"
    SEGMENT_OPEN = "a segment can't be opened"
    SEGMENT_MISMATCH = "an existing segment is of another make"
    SCALE_OVERFLOW = "a number doesn't fit 32 bits at any scale"
    SYMBOL_UNKNOWN = "unknown symbol"


class ReplayError(Exception):
    def __init__(self, code: Error, detail: str = ""):
        super().__init__(f"{code.value}: {detail}" if detail else code.value)
        self.code = code


#: Why a row is rejected, in the order in which summaries list them (fixed values).
MALFORMED, BAD_TS, BAD_FIELD, UNKNOWN_SYMBOL, BAD_NUMBER, SCALE_OVERFLOW = REASONS = (
    "malformed",
    "bad_ts",
    "bad_field",
    "unknown_symbol",
    "bad_number",
    "scale_overflow",
)


class SegmentState(Enum):
    OK = "ok"
    BAD_MAGIC = "not a segment"
    BAD_VERSION = "another layout version"
    BAD_KIND = "another kind of table"
    SIZE_MISMATCH = "entries of another size or number"
    SCHEMA_DRIFT = "fields described otherwise"
