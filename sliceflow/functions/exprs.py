"""Scalar helpers (X1-X10) as built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UUID_PATTERN


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_ts(as_of: str) -> Column:
    """The fixed "now" of a job as a timestamp without zone."""
    return F.to_timestamp_ntz(F.lit(as_of))


def older_than(ts, as_of: str, interval: str) -> Column:
    """``ts < as_of - INTERVAL interval`` (e.g. ``'24 HOURS'``)."""
    return col(ts) < as_of_ts(as_of) - F.expr(f"INTERVAL {interval}")


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a timestamp without zone, from its
    calendar fields: the session's time zone and its clock changes play no part."""
    t = col(c)
    seconds = F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def percent_complete(done, total) -> Column:
    """0 when total is 0, else round(done * 100 / total) half-up,
    computed in decimal as the reference's numeric cast does."""
    pct = F.round(col(done).cast("decimal(20,0)") * F.lit(100) / col(total).cast("decimal(20,0)"), 0)
    return F.when(col(total) == 0, F.lit(0.0)).otherwise(pct.cast("double"))


def json_map(c) -> Column:
    """JSON object text -> map<string,string>; bad JSON gives null."""
    return F.from_json(col(c), "map<string,string>")


def json_field(c, key: str) -> Column:
    """One field of a JSON object as text (null when absent or bad JSON)."""
    return F.try_element_at(json_map(c), F.lit(key))


def is_uuid(c) -> Column:
    """Canonical 8-4-4-4-12 hex form only."""
    return F.coalesce(col(c).rlike(UUID_PATTERN), F.lit(False))


def split_key_size(c) -> tuple[Column, Column]:
    """``"path:size"`` split on the first ``:`` -> (path, size); a missing
    or bad size gives 0."""
    parts = F.split(col(c), ":", 2)
    size = F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("long"), F.lit(0).cast("long"))
    return parts.getItem(0), size


def artifact_key(run_id, partition_index) -> Column:
    """Object key of one slice's output file."""
    return F.concat(F.lit("artifacts/"), col(run_id).cast("string"), F.lit("/partition-"),
                    col(partition_index).cast("string"), F.lit(".csv"))


def dataset_key(workspace_id, dataset_id, name, fmt) -> Column:
    """Object key of an uploaded dataset."""
    return F.format_string("%s/%s/%s.%s", col(workspace_id).cast("string"),
                           col(dataset_id).cast("string"), col(name), col(fmt))


def stable_id(*cols) -> Column:
    """Deterministic id from a natural key (``uuid()`` is not replayable)."""
    return F.sha2(F.concat_ws("\u0001", *[col(c).cast("string") for c in cols]), 256)


def short_id(c) -> Column:
    """First 8 characters of an id."""
    return F.substring(col(c).cast("string"), 1, 8)
