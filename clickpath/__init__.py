"""clickpath: session analytics over user-visit logs, written as Spark DataFrame jobs.

Every public function maps DataFrames to DataFrames and runs no action: Spark
plans and executes the work, nothing is collected on the driver.

Layout
------
``sources``    readers of the action / user / product tables, the adapter from
               the benchmark tables, a synthetic generator and the sinks.
``functions``  scalar ``Column`` helpers (strings, dates, numbers).
``operators``  session aggregation, filters, statistics, sampling, hot
               categories and active sessions.
``plans``      the four analyses composed end to end, and the query catalog.
"""

from clickpath.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
