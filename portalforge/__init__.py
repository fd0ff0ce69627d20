"""portalforge: Spark-native builder for cancer-study portal load packages.

Every job is a function from DataFrames to a DataFrame.  Column names and
thresholds are arguments, so the same job runs on warehouse tables, on
per-sample result files (``portalforge.sources.files``) and on the driver's
star-schema testdata (``portalforge.sources.bindings``).
"""

from portalforge.session import build_session, materialize

__all__ = ["build_session", "materialize"]
