"""vaultspark: a layered (staging -> hub/link/satellite) warehouse load built
from plain Spark DataFrame operators.

Every public operator is a function from DataFrames to DataFrames.  Nothing is
executed until the caller runs an action (``save_table``, ``count``, ...), so a
whole daily load is one Catalyst plan per written table.
"""

from vaultspark.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
