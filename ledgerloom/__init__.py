"""ledgerloom: batch banking analytics expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame; nothing runs before a sink.
"""

from ledgerloom.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
