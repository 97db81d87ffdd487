"""tessera: text-corpus and label jobs expressed as Spark DataFrame plans.

Every public operator takes and returns DataFrames; the heavy lifting is done by
Spark (built-in expressions, joins, aggregations, windows).  See README.md.
"""

from tessera.session import build_session, ensure_checkpoint_dir, load_table

__all__ = ["build_session", "ensure_checkpoint_dir", "load_table"]
