"""marquee: Spark-native movie recommendation statistics, offline and realtime
recommendation, and log ingest, written as DataFrame / Spark ML / Structured
Streaming operators.

Every operator is a plain function from DataFrames to DataFrames; see
``README.md`` for the module map.
"""

from marquee.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
