"""Scalar column functions (built-in Spark expressions only)."""

from streamlens.functions.columns import *  # noqa: F401,F403
from streamlens.functions.columns import __all__  # noqa: F401
