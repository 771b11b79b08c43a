"""Column expressions for values: coercions, intervals, arrays, names, ids, retry rules."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of an interval and their seconds (a year is 365.25 days, a month 30 days).
UNIT_SECONDS = {
    "year": 31_557_600.0, "years": 31_557_600.0, "mon": 2_592_000.0, "mons": 2_592_000.0, "month": 2_592_000.0, "months": 2_592_000.0, "day": 86_400.0, "days": 86_400.0, "hour": 3_600.0, "hours": 3_600.0,
    "minute": 60.0, "minutes": 60.0, "min": 60.0, "mins": 60.0, "second": 1.0, "seconds": 1.0, "sec": 1.0, "secs": 1.0,
}
_DECIMAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a zoneless timestamp, read as UTC whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def try_interval_seconds(text: Column) -> Column:
    """`3 days 04:05:06.5` -> 273906.5; the sign belongs to each component. NULL if a number lacks its unit, or anything is no number, unit or clock of three parts."""
    units = F.create_map(*[F.lit(x) for kv in UNIT_SECONDS.items() for x in kv])

    def clock(token):
        parts = F.transform(F.split(F.regexp_replace(token, "^[+-]", ""), ":"), _decimal)
        total = F.get(parts, F.lit(0)) * 3600.0 + F.get(parts, F.lit(1)) * 60.0 + F.get(parts, F.lit(2))
        return F.when(F.size(parts) == 3, F.when(token.startswith("-"), -total).otherwise(total))

    def read(state, token):
        """A token adds a clock, completes a number by its unit, or is the number; a NULL total is a failure and stays one."""
        waits = state["number"].isNotNull()
        total = F.when(waits, state["total"] + state["number"] * F.element_at(units, F.lower(token))).when(F.contains(token, F.lit(":")), state["total"] + clock(token))
        number = F.when(~waits & ~F.contains(token, F.lit(":")), _decimal(token))
        return F.struct(F.when(number.isNotNull(), state["total"]).otherwise(total).alias("total"), number.alias("number"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(None).cast("double").alias("number"))
    tokens = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+")
    return F.aggregate(tokens, start, read, lambda s: F.when(s["number"].isNull(), s["total"]))


def interval_seconds(text: Column) -> Column:
    """The same, but a text that is no interval is an error."""
    seconds = try_interval_seconds(text)
    return F.when(text.isNotNull() & seconds.isNull(), F.raise_error(F.concat(F.lit("no interval: "), text)).cast("double")).otherwise(seconds)


def epoch_micros(text: Column) -> Column:
    """Seconds with a fraction, as text -> microseconds, rounded down; unreadable gives NULL."""
    return F.floor(text.try_cast("decimal(30,9)") * 1_000_000).cast("long")


def bytea_base64(text: Column) -> Column:
    """`\\x` and hexadecimal digits, or else raw characters, as base64."""
    return F.when(text.startswith("\\x"), F.base64(F.unhex(F.substr(text, F.lit(3))))).otherwise(F.base64(text.cast("binary")))


def _array_items(text: str) -> list[str | None] | None:
    """Items of an array literal; quotes and backslashes are honoured, a bare NULL is None."""
    if len(text) < 2 or text[0] != "{" or text[-1] != "}":
        return None
    items, item, quoted, bare, i, body = [], [], False, True, 0, text[1:-1]
    if not body:
        return []
    while i <= len(body):
        c = body[i] if i < len(body) else ","
        if i == len(body) and quoted:
            return None
        if quoted:
            if c == "\\" and i + 1 < len(body):
                i += 1
                item.append(body[i])
            elif c == '"':
                quoted = False
            else:
                item.append(c)
        elif c == '"':
            quoted, bare = True, False
        elif c == "\\" and i + 1 < len(body):
            i += 1
            item.append(body[i])
        elif c == ",":
            s = "".join(item)
            items.append(None if bare and s.lower() == "null" else s)
            item, bare = [], True
        else:
            item.append(c)
        i += 1
    return items


#: Readers of one array element by its type; an element that fails leaves the whole cell as text.
_READ = {
    "long": int, "string": str, "numeric": str, "bool": lambda s: {"t": True, "true": True, "f": False, "false": False}[s.lower()],
    "double": lambda s: None if s.lower() in ("nan", "infinity", "-infinity", "inf", "-inf") else float(s),
}


def array_literal_json(text: str | None, element: str) -> str | None:
    if text is None:
        return None
    items = _array_items(text)
    if items is None:
        return text
    try:
        return json.dumps([None if x is None else _READ[element](x) for x in items], separators=(",", ":"), ensure_ascii=False)
    except (ValueError, KeyError):
        return text


#: How an unquoted element of each type looks that needs no parser.
_PLAIN = {"long": r"-?(?:0|[1-9]\d{0,17})", "bool": r"(?:t|f|true|false)", "string": r"[A-Za-z0-9_.:-]+", "numeric": r"[A-Za-z0-9_.:+-]+"}


def array_to_json(text: Column, element: str = "long") -> Column:
    """`{1,NULL,3}` -> `[1,null,3]`. Literals without quotes or odd elements are read by expressions; only the others reach a parser in Python."""

    @F.pandas_udf("string")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda x: array_literal_json(x, element), na_action="ignore")

    if element not in _PLAIN:
        return parse(text)
    plain = text.rlike(rf"^\{{(?:(?:{_PLAIN[element]}|(?i:null))(?:,(?:{_PLAIN[element]}|(?i:null)))*)?\}}$")
    return F.when(plain, _plain_array(text, element)).otherwise(parse(F.when(~plain, text)))


def _plain_array(text: Column, element: str) -> Column:
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    shown = {"long": lambda x: x, "bool": lambda x: F.when(F.substr(x, F.lit(1), F.lit(1)) == "t", "true").otherwise("false"), "string": quoted, "numeric": quoted}[element]
    items = F.split(F.substr(text, F.lit(2), F.length(text) - 2), ",")
    each = F.transform(items, lambda x: F.when(F.lower(x) == "null", "null").otherwise(shown(x)))
    return F.when(text == "{}", "[]").otherwise(F.concat(F.lit("["), F.array_join(each, ","), F.lit("]")))


def rfc3339(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def time_text(micros_of_day: Column) -> Column:
    """Time of day with as many groups of three digits after the second as it needs."""
    seconds, rest = F.floor(micros_of_day / 1_000_000), micros_of_day % 1_000_000
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    part = F.when(rest == 0, "").when(rest % 1000 == 0, F.concat(F.lit("."), F.lpad((rest / 1000).cast("int").cast("string"), 3, "0"))).otherwise(F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0")))
    return F.concat_ws(":", two(seconds / 3600), two(seconds / 60 % 60), F.concat(two(seconds % 60), part))


#: Spellings that the strict forms take for a truth value.
TRUE, FALSE = ("t", "true", "1"), ("f", "false", "0")


def strict(text: Column, kind: str) -> Column:
    """The value of a text; an error where it is none of the type."""
    value = F.when(F.lower(text).isin(*TRUE), True).when(F.lower(text).isin(*FALSE), False) if kind == "boolean" else epoch_micros(text) if kind == "epoch" else text.try_cast(kind)
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)))


def lenient(text: Column, kind: str) -> Column:
    """NULL where the text is no value of the type."""
    if kind == "boolean":
        low = F.lower(F.trim(text))
        return F.when(low.isin("true", "t", "1"), True).when(low.isin("false", "f", "0"), False)
    return text.try_cast(kind)


def identity(pk: Column) -> Column:
    """A key as text; a NULL key is an error."""
    return F.when(F.assert_true(pk.isNotNull(), "primary key is null").isNull(), pk.cast("string"))


def destination_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"\.", "__"), "[^A-Za-z0-9_]", "_")


def deleted_at(marker: Column, kind: str, now: Column, keep_text: bool = False) -> Column:
    """When a soft-delete marker says so: true is now, a time or date is itself, text only if kept."""
    if kind == "boolean":
        return F.when(marker, now)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return marker.cast("timestamp_ntz")
    return marker if keep_text else F.lit(None).cast("timestamp_ntz")


def carried(before: Column, after: Column, unchanged: Column) -> Column:
    """An unchanged large value comes from the same event's old row, or is NULL."""
    return F.when(unchanged, before).otherwise(after)


def lsn_number(lsn: Column) -> Column:
    """`16/B374D848` as a number of bytes."""
    half = lambda k: F.conv(F.split(lsn, "/")[k], 16, 10).cast("decimal(20,0)")
    return (half(0) * F.lit(4294967296).cast("decimal(20,0)") + half(1)).cast("decimal(20,0)")


def lsn_behind(current: Column, saved: Column) -> Column:
    """Bytes from a saved position of the log to the current one."""
    return (lsn_number(current) - lsn_number(saved)).cast("decimal(20,0)")


def continuity_lost(slot_found: Column, saved: Column) -> Column:
    """A position is saved, but the slot that kept its log is gone."""
    return ~slot_found & saved.isNotNull()


def scrub_url(url: Column) -> Column:
    """A password between the user and the host becomes three stars."""
    return F.regexp_replace(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^:/@\s]*):[^@/\s]*@", "$1:***@")


def stable_id(*parts: Column, length: int = 24) -> Column:
    return F.substr(F.sha2(F.concat_ws("\0", *[p.cast("string") for p in parts]), 256), F.lit(1), F.lit(length))


def fragment_id(job_id: Column, sequence: Column) -> Column:
    return F.concat_ws(":", job_id, sequence.cast("string"))


def attempt_key(jobs: Column) -> Column:
    """What names an attempt on several jobs: array<struct<job_id, attempt_count>> -> `job:attempt,...`."""
    return F.array_join(F.transform(jobs, lambda j: F.concat_ws(":", j["job_id"], F.greatest(j["attempt_count"], F.lit(0)).cast("string"))), ",")


#: The retry rules' seconds and limits.
BACKOFF_FLOOR, BACKOFF_CAP, BACKOFF_DOUBLINGS, JITTER = 16, 1024, 20, 0.2


#: Fixed value: seconds beyond which a snapshot's retry does not wait.
SNAPSHOT_CAP = 900


def snapshot_backoff_seconds(attempt: Column, floor: int = BACKOFF_FLOOR) -> Column:
    """A snapshot's delay: doubled without jitter, up to a quarter of an hour."""
    return backoff_seconds(attempt, floor, SNAPSHOT_CAP)


def backoff_seconds(attempt: Column, floor: int = BACKOFF_FLOOR, cap: int = BACKOFF_CAP, jitter_key: Column | None = None) -> Column:
    doubled = F.lit(float(floor)) * F.pow(F.lit(2.0), F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(BACKOFF_DOUBLINGS)))
    base = F.least(doubled, F.lit(float(cap)))
    if jitter_key is not None:
        spread = base * (1 - JITTER + 2 * JITTER * F.pmod(F.xxhash64(jitter_key, attempt), F.lit(1000)) / 999)
        base = F.least(F.greatest(F.lit(float(floor)), spread), F.lit(float(cap)))
    return base.cast("long")


#: Reasons that a warehouse names in an error, by retry class, tried in order.
WAREHOUSE_REASONS = (
    ("backpressure", ("jobratelimitexceeded", "quotaexceeded", "ratelimitexceeded")),
    ("transient", ("backenderror", "internalerror", "jobbackenderror", "jobinternalerror", "tableunavailable")),
    ("permanent", ("accessdenied", "billingnotenabled", "billingtierlimitexceeded", "duplicate", "invalid", "invalidquery", "invaliduser", "notfound", "notimplemented", "resourcesexceeded", "responsetoolarge")),
)


def _has_all(text: Column, *words: str) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(w)) for w in words])


def retry_class(error: Column, kind: Column | None = None) -> Column:
    """Class of an error by its kind (`policy`, `lock`) or else its text; unknown ones are transient."""
    low = F.lower(error)
    out = F.when(kind.isin("policy", "lock"), "permanent") if kind is not None else F.when(F.lit(False), "")
    out = out.when(_has_all(low, "quota exceeded", "dml jobs writing to a table"), "backpressure")
    out = out.when(_has_all(low, "destination deleted/expired during operation"), "transient")
    for name, reasons in WAREHOUSE_REASONS:
        out = out.when(low.rlike(f"bigquery_reason=(?:{'|'.join(reasons)})"), name)
    return out.otherwise("transient")


#: Texts of old errors and the reason that each stands for, tried in order.
OLD_REASONS = (
    ("schema change detected", "schema_blocked"), ("publication", "publication_blocked"),
    ("snapshot blocked for table(s):", "snapshot_blocked"), ("already locked", "lock_contention"),
)
#: Texts of old job errors that a retry may cure.
OLD_TRANSIENT = ("failed to process cdc batch-load job", "merging staging bigquery table", "bigquery query returned errors")


def old_error_reason(error: Column) -> Column:
    """Reason of an error that was stored before reasons were; NULL without an error."""
    low, out = F.lower(error), F.when(error.isNull(), F.lit(None).cast("string"))
    for text, reason in OLD_REASONS:
        out = out.when(F.contains(low, F.lit(text)), reason)
    return out.otherwise("last_run_failed")


def old_retry_class(error: Column) -> Column:
    """Retry class of a job that was stored before classes were; NULL without an error."""
    low = F.lower(error)
    out = F.when(error.isNull(), F.lit(None).cast("string")).when(_has_all(low, "quota exceeded", "dml jobs writing to a table"), "backpressure")
    return out.when(reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in OLD_TRANSIENT]), "transient").otherwise("permanent")


def old_reducer_eligible(barrier: Column, payload: Column) -> Column:
    """A stored job may be reduced if it has no barrier and its payload names a staging schema."""
    return barrier.isNull() & F.get_json_object(payload, "$.staging_schema").isNotNull()


def stage_of(status: Column) -> Column:
    return F.when(status == "pending", "received").when(status == "running", "applying").when(status == "succeeded", "applied").otherwise("failed")


def normalise_filter(text: str) -> str:
    """White space and case outside quotes and wrapping parentheses do not count."""
    pieces = re.findall(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|[^'\"]+", text)
    s = "".join(p if p[0] in "'\"" else re.sub(r"\s+", "", p).lower() for p in pieces)

    def wraps(s: str) -> bool:
        depth, quote = 0, ""
        for i, c in enumerate(s):
            if quote:
                quote = "" if c == quote else quote
            elif c in "'\"":
                quote = c
            elif c in "()":
                depth += 1 if c == "(" else -1
                if not depth and i < len(s) - 1:
                    return False
        return s.startswith("(") and s.endswith(")")

    while len(s) > 1 and wraps(s):
        s = s[1:-1]
    return s
