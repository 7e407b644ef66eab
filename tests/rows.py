"""Small helpers for result rows."""

from __future__ import annotations


def rows(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def column(frame, name: str) -> list:
    return [row[name] for row in frame.collect()]


def final_plan(frame) -> str:
    """Physical plan text; run the frame first to see what adaptive execution chose."""
    return frame._jdf.queryExecution().executedPlan().toString()
