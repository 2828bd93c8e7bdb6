"""Training-data operators.

Ten operators over the ``documents`` table and their registered queries
(:mod:`salesboard.llm.queries`).  Nothing outside this package imports it, so
the folder can be removed without touching the rest of the library.
"""
