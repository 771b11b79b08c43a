"""Small rules of the control side: schedules, scopes, acknowledgements, configuration."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schedule_seconds(text: str) -> int:
    """`30s`, `5m`, `1h`, `1d` or plain seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([smhd]?)\s*", text)
    if not m or not int(m[1]):
        raise ValueError(f"no schedule: {text!r}")
    return int(m[1]) * {"": 1, "s": 1, "m": 60, "h": 3600, "d": 86400}[m[2]]


def schedule_column(text: Column) -> Column:
    """The same of a column; a text that is no schedule is an error."""
    number, unit = F.regexp_extract(text, r"^\s*(\d+)\s*([smhd]?)\s*$", 1).try_cast("long"), F.regexp_extract(text, r"^\s*(\d+)\s*([smhd]?)\s*$", 2)
    seconds = number * F.when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400).otherwise(1)
    return F.when(F.assert_true(text.isNull() | F.coalesce(seconds > 0, F.lit(False)), "no schedule").isNull(), seconds)


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def selected_connections(connections: list[dict], wanted: str | None = None) -> list[dict]:
    """The wanted one (an error if missing or disabled), or all that are enabled."""
    on = [c for c in connections if c.get("enabled", True)]
    if wanted is None:
        return on
    found = [c for c in on if c["id"] == wanted]
    if not found:
        raise ValueError(f"no enabled connection {wanted}")
    return found


def enabled(connections: DataFrame, wanted: str | None = None) -> DataFrame:
    """The same of rows (id, enabled)."""
    on = connections.where(F.coalesce("enabled", F.lit(True)))
    if wanted is None:
        return on
    found = on.where(F.col("id") == wanted)
    if not found.head(1):
        raise ValueError(f"no enabled connection {wanted}")
    return found


def snapshot_scope(included: set[str], in_progress: set[str], resync: set[str], new: set[str], full: bool, has_position: bool, keep_backlog: bool) -> set[str]:
    """Tables to read whole: all at a full sync or without a position, else those that need it."""
    if full or (not has_position and not keep_backlog):
        return set(included)
    return (in_progress | resync | new) & included


def write_plan(resync: bool, resumed: bool) -> tuple[str, bool]:
    """(mode, truncate first): a resumed or repeated snapshot upserts, a first one truncates and appends."""
    return ("upsert", False) if resync or resumed else ("append", True)


def feedback_lsn(received: int, flushed: int, idle: dict[str, bool]) -> int:
    """What a keepalive may acknowledge: all received only if nothing at all is under way."""
    return received if all(idle.values()) else flushed


def stops_when_idle(follow: bool, idle_s: float, limit_s: float = 10.0) -> bool:
    return not follow and idle_s >= limit_s


def next_sequence(feedback: int | None, enqueue: int | None, legacy: int | None) -> int:
    return next((x for x in (feedback, enqueue, legacy) if x is not None), 0)


def merged_payload(payloads: list[dict]) -> dict:
    """One payload of a window's jobs: same target and key, a truncate alone, reducer only with staged schemas."""
    first = payloads[0]
    if any((p["target_table"], p["primary_key"]) != (first["target_table"], first["primary_key"]) for p in payloads):
        raise ValueError("jobs of different targets in one window")
    if len(payloads) > 1 and any(p.get("truncate") for p in payloads):
        raise ValueError("a truncate shares no window")
    staged = all(p.get("staging_schema") for p in payloads)
    return {**first, "steps": [s for p in payloads for s in p["steps"]], "reducer": staged}


def merged_payloads(payloads: DataFrame, window: str) -> DataFrame:
    """The same of rows, per window: steps in order of first_sequence; a window that may not be is an error."""
    fine = F.assert_true((F.count_distinct("target_table", "primary_key") == 1) & ((F.count("*") == 1) | ~F.bool_or("truncate")), "jobs that share no window")
    steps = F.array_sort(F.collect_list(F.struct("first_sequence", "steps")))
    out = payloads.groupBy(window).agg(
        F.min("target_table").alias("target_table"), F.min("primary_key").alias("primary_key"), F.bool_or("truncate").alias("truncate"), steps.alias("_steps"),
        F.bool_and(F.col("staging_schema").isNotNull()).alias("reducer"), fine.isNull().alias("_fine"),
    )
    return out.where("_fine").select(window, "target_table", "primary_key", "truncate", F.flatten(F.transform("_steps", lambda x: x["steps"])).alias("steps"), "reducer")


def request_id(prefix: str, key: str) -> str:
    return f"{prefix}{hashlib.sha256(key.encode()).hexdigest()}"[:36]
