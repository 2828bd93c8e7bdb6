"""salesboard: live sales measures and wallboard queries on PySpark.

Sale records arrive as ``^``-delimited text (a topic or files).  They are
split, typed and validated (bad rows go to a quarantine), then three running
measures are kept -- total amount, amount per shop, amount per time bucket --
and served as top-k rankings, trend points, series and roll-ups.

Everything is DataFrame code: the same functions run on a batch DataFrame and
on a streaming one.

Sub-packages
------------
``sources``    raw inputs: topic/file-stream readers, table fixtures, offsets
``operators``  parse, measures, state, ranking, serving, series, tree, panels
``functions``  Column helpers (time, text, money formatting)
``streaming``  the micro-batch job (fan-out, delta log, replay safety)
``plans``      the query catalogue used by ``__spark_entry__`` and its SQL twins
"""

from salesboard.session import get_session, scratch_root

__all__ = ["get_session", "scratch_root"]
