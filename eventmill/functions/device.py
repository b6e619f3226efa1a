"""Device context from a user-agent column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns in checking order, the first that is found names the system.
OS_PATTERNS = (
    ("Windows", "windows"),
    ("macOS", "macintosh|mac os x"),  # also found in iPhone agents, which thus read macOS
    ("Android", "android"),
    ("iOS", "iphone|ipad|ipod"),
    ("Linux", "linux"),
)
DEVICE_PATTERNS = (("mobile", "mobile"), ("tablet", "tablet"))
DEFAULT_DEVICE = "desktop"


def _found(agent: Column, pattern: str) -> Column:
    return agent.rlike(f"(?i){pattern}")


def _first_named(agent: Column, patterns: tuple[tuple[str, str], ...], default: str | None) -> Column:
    found = [F.when(_found(agent, pattern), F.lit(name)) for name, pattern in patterns]
    return F.coalesce(*found, F.lit(default).cast("string"))


def os_name(user_agent: Column) -> Column:
    return _first_named(F.coalesce(user_agent, F.lit("")), OS_PATTERNS, None)


def device_type(user_agent: Column) -> Column:
    return _first_named(F.coalesce(user_agent, F.lit("")), DEVICE_PATTERNS, DEFAULT_DEVICE)


def browser_name(user_agent: Column) -> Column:
    agent = F.coalesce(user_agent, F.lit(""))
    chrome, edge = _found(agent, "chrome/"), _found(agent, "edge?/")
    safari, firefox = _found(agent, "safari"), _found(agent, "firefox")
    return (
        F.when(chrome & ~edge, "Chrome")
        .when(safari & ~chrome, "Safari")
        .when(firefox, "Firefox")
        .when(edge, "Edge")
    )
