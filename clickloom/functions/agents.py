"""Device and browser from a user agent."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _mentions(agent: Column, *words: str) -> Column:
    return F.lower(agent).rlike("|".join(words))


def device_type(agent: Column) -> Column:
    return (
        F.when(agent.isNull(), "Unknown")
        .when(_mentions(agent, "ipad", "tablet"), "Tablet")
        .when(_mentions(agent, "mobile", "iphone", "android"), "Mobile")
        .otherwise("Desktop")
    )


def browser(agent: Column) -> Column:
    chrome, edge = _mentions(agent, "chrome"), _mentions(agent, "edg")
    return (
        F.when(agent.isNull(), "Unknown")
        .when(chrome & ~edge, "Chrome")
        .when(_mentions(agent, "safari") & ~chrome, "Safari")
        .when(_mentions(agent, "firefox"), "Firefox")
        .when(edge, "Edge")
        .otherwise("Other")
    )
