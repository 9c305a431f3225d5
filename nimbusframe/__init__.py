"""nimbusframe: operational analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (readers/writers), ``functions`` (column functions),
``operators`` (predicates, joins, aggregates, windows, table changes),
``streaming`` (Structured Streaming jobs) and ``plans`` (named queries and
the registered query suite).
"""

from nimbusframe.session import Tables, ensure_checkpoint_dir, get_session, read_table

__all__ = ["Tables", "ensure_checkpoint_dir", "get_session", "read_table"]
