"""strata: Bronze -> Silver -> Gold pipelines as plain Spark programs.

Every operator takes and returns DataFrames; the heavy lifting runs on
executors through Catalyst/Tungsten. Python runs inside tasks only where a
remote call or a per-row protocol (HTTP fetch, retries, token bucket) needs it.
"""

from strata.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
__version__ = "0.1.0"
