"""Errors a source or the lake can raise."""

from __future__ import annotations

from pyspark.errors import AnalysisException

_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


class SourceError(ValueError):
    """The source does not meet the contract, or the choice is ambiguous."""


class SourceNotFound(FileNotFoundError):
    """No source file matches."""


class LakeNotReady(RuntimeError):
    """A layer that a job reads is still empty."""


def is_absent(error: AnalysisException) -> bool:
    """True when Spark reports that a path has no data files at all."""
    return error.getCondition() in _ABSENT
