"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from strata.functions.scalar import (  # noqa: F401
    epoch_millis_to_ts,
    epoch_seconds_to_ts,
    join_path,
    md5_bucket,
    md5_int,
    name_part,
    preview,
    row_hash,
    safe_name,
    url_for,
)
