"""Coded errors: one class per range, the code on the exception."""

from __future__ import annotations

import re


class FreshetError(Exception):
    """Base class. ``code`` is the numeric error code."""

    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code
        self.message = message


class ConnectionFault(FreshetError):
    """100s: opening, configuration, use after close."""


class SchemaFault(FreshetError):
    """200s: unknown names, catalog."""


class IngestionFault(FreshetError):
    """300s: bad values, closed writers, schema mismatch."""


class QueryFault(FreshetError):
    """400s: invalid SQL, statements of the wrong kind."""


class SubscriptionFault(FreshetError):
    """500s: the stream stopped, or the reader fell behind (502)."""


class InternalFault(FreshetError):
    """900s: unsupported types and everything unrecognised."""


# Error codes.
BAD_CONFIG = 100
CLOSED = 101
UNKNOWN_NAME = 200
BAD_VALUE = 300
WRITER_CLOSED = 301
SCHEMA_MISMATCH = 302
WRONG_STATEMENT = 400
INVALID_SQL = 401
STREAM_FAILED = 500
FELL_BEHIND = 502
UNSUPPORTED = 900

_RANGES = {
    1: ConnectionFault,
    2: SchemaFault,
    3: IngestionFault,
    4: QueryFault,
    5: SubscriptionFault,
}

# Errors raised inside a Spark task carry their code in the text, so that the
# driver can give back the same typed error the task meant.
_MARK = re.compile(r"freshet\[(\d+)\] (.*?)(?:\n|$| SQLSTATE)", re.S)


def fault(code: int, message: str) -> FreshetError:
    """The error object of the class that owns ``code``."""
    return _RANGES.get(code // 100, InternalFault)(code, message)


def marked(code: int, message: str) -> str:
    """Text for an error raised in a task; ``from_task`` turns it back."""
    return f"freshet[{code}] {message}"


def from_task(error: BaseException) -> FreshetError | None:
    """The typed error a failed job carries, or None if it carries none."""
    found = _MARK.search(str(error))
    return fault(int(found.group(1)), found.group(2).strip()) if found else None
