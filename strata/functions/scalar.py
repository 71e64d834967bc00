"""Scalar column expressions used across layers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(*cols) -> Column:
    """SHA-256 over the ordered columns as text.

    Each value stands behind its length, a NULL is ``-``: no two different rows
    give the same text, whatever the values contain.
    """
    def part(c):
        text = c.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[part(_c(c)) for c in cols]), 256)


def md5_int(key) -> Column:
    """First 32 bits of md5(key) as a non-negative BIGINT; repeatable everywhere."""
    return F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(key, buckets: int, seed: int | str | None = None) -> Column:
    """Deterministic bucket in [0, buckets) from md5 of key (and seed)."""
    k = _c(key).cast("string")
    if seed is not None:
        k = F.concat(k, F.lit(f"#{seed}"))
    return F.pmod(md5_int(k), F.lit(buckets))


def url_for(template: str, key) -> Column:
    """Fill ``{id}`` in a URL template from a column."""
    pre, _, post = template.partition("{id}")
    return F.concat(F.lit(pre), _c(key).cast("string"), F.lit(post))


def safe_name(path) -> Column:
    """Path to a flat name: leading '/' dropped, '/' and '.' become ':'."""
    return F.regexp_replace(F.regexp_replace(_c(path), r"^/+", ""), r"[/.]", ":")


def name_part(name, part: str) -> Column:
    """``catalog``, ``schema`` or ``table`` of ``catalog.schema.table``; a shorter name lacks the first ones, a longer one is an error."""
    parts = F.split(_c(name), r"\.")
    n = F.size(parts)
    back = {"table": 1, "schema": 2, "catalog": 3}[part]
    return (F.when(n > 3, F.raise_error(F.concat(F.lit("bad table name "), _c(name))).cast("string"))
            .when(n >= back, F.get(parts, n - back)))


def join_path(*parts) -> Column:
    """Parts of a path put together with one ``/`` between two, whatever slashes they end or begin with there."""
    cols = [_c(p) for p in parts]
    trimmed = [F.regexp_replace(c, r"/+$", "") if i == 0 else F.regexp_replace(c, r"^/+" if i == len(cols) - 1 else r"^/+|/+$", "")
               for i, c in enumerate(cols)]
    return F.concat_ws("/", *trimmed)


def preview(c, n: int = 200) -> Column:
    return F.substring(_c(c), 1, n)


def epoch_millis_to_ts(c) -> Column:
    return F.timestamp_millis(_c(c))


def epoch_seconds_to_ts(c) -> Column:
    return F.timestamp_seconds(_c(c))
