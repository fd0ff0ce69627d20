"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from portalforge.functions.exprs import *  # noqa: F401,F403
