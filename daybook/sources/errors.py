"""Classify read failures into a few stable labels."""

from __future__ import annotations

NOT_FOUND = "not_found"
ACCESS_DENIED = "access_denied"
NO_BUCKET = "no_bucket"
ANALYSIS_ERROR = "analysis_error"
UNEXPECTED = "unexpected"
OK = "ok"


def classify_error(exc: BaseException) -> str:
    """Label a read failure.

    Spark's error condition is used where present (``PATH_NOT_FOUND``);
    object-store failures arrive as wrapped Hadoop exceptions, so their
    text is matched.
    """
    from pyspark.errors import AnalysisException

    condition = None
    get = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    if get is not None:
        try:
            condition = get()
        except Exception:  # noqa: BLE001 - older error objects
            condition = None
    text = str(exc)
    told = text.split(":", 1)[0]
    if told in (NOT_FOUND, ACCESS_DENIED, ANALYSIS_ERROR, UNEXPECTED):  # a task's report
        return told
    if condition == "PATH_NOT_FOUND" or "Path does not exist" in text:
        return NOT_FOUND
    if "NoSuchBucket" in text:
        return NO_BUCKET
    if "Access Denied" in text or "AccessDenied" in text or "403 Forbidden" in text:
        return ACCESS_DENIED
    if isinstance(exc, AnalysisException):
        return ANALYSIS_ERROR
    return UNEXPECTED


def label_of(report: str | None) -> str:
    """The label of a failure that a task reported as ``Type: message``."""
    kind = (report or "").split(":", 1)[0]
    if kind == "FileNotFoundError":
        return NOT_FOUND
    if "is a directory" in (report or "").lower() or "Not a regular file" in (report or ""):
        return ANALYSIS_ERROR  # a directory without a data file
    if kind == "PermissionError" or "ACCESS_DENIED" in (report or ""):
        return ACCESS_DENIED
    return UNEXPECTED
