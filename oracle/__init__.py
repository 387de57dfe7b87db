"""SQL that states every registered query in its plain form.

The text runs on DuckDB (the correctness check) and on Spark SQL (``bench.py`` times it as
the as-written form). It shares no logic with the library: each balance is its own derived
table over the payment rows themselves, joined one by one.
"""

from .queries import oracle_queries

__all__ = ["oracle_queries"]
