"""quarry: batch and streaming analytics operators on Spark DataFrames.

Every operator takes DataFrames (plus plain Python parameters) and returns a
DataFrame; the work is declared with the DataFrame / SQL API so Catalyst and
AQE choose the physical plan.

Sub-packages
------------
``functions``  column-level helpers (tokenizers, trims, parsing, formatting)
``sources``    readers and writers (text, key/value, CSV, packed files, tables)
``operators``  relational operators (counts, joins, Bloom semi join, series, tf-idf)
``plans``      multi-step plans and the skew-safe ordered scan they share
``streaming``  Structured Streaming counts and queries over their state
"""

from quarry.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
