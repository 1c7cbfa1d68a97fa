"""stridelake: race-results analytics on Spark.

Raw endurance-race result files go in; a cleaned one-big-table (silver), a star
schema with two marts (gold), profiling reports and mart questions come out.
Every step is a DataFrame -> DataFrame function over Spark builtins, so the
same code runs in batch and in Structured Streaming.
"""

from stridelake.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
