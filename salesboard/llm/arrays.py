"""Array and text functions whose cost grows with the length, not with its square.

``aggregate`` copies what it has gathered at every step when it appends, and ``substr``
counts the characters before its place.  Both are cut into blocks here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesboard.llm.rules import let

_STEPS = 7  # 128 values a block
_FINE, _COARSE = 8, 16  # blocks of 256 characters, out of blocks of 65,536


def running(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each value, ``op`` over all values before it; ``op`` is associative and ``zero`` changes nothing."""
    def append(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(op(F.element_at(acc, -1), x)))

    def by_block(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: op(acc, x)))
        before = F.slice(F.aggregate(totals, F.array(zero), append), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, before, lambda b, first: F.slice(F.aggregate(b, F.array(first), append), F.lit(1), F.size(b))))

    def cut(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(v), _STEPS)), lambda i: F.slice(v, F.shiftleft(i, _STEPS) + 1, F.lit(1 << _STEPS)))
    return let(let(values, cut), by_block)


def _chunks(text: Column, bits: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.greatest(F.length(text) - 1, F.lit(0)), bits)), lambda i: F.substr(text, F.shiftleft(i, bits) + 1, F.lit(1 << bits)))


def text_blocks(text: Column) -> Column:
    """The text in blocks, for ``stretch``."""
    return F.flatten(F.transform(_chunks(text, _COARSE), lambda c: _chunks(c, _FINE)))


def stretch(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` characters of a text from ``start`` (from 0) on, out of its ``text_blocks``."""
    first = F.shiftright(start, _FINE)
    near = F.array_join(F.slice(blocks, first + 1, F.shiftright(start + length, _FINE) - first + 1), "")
    return F.substr(near, start.bitwiseAND((1 << _FINE) - 1) + 1, length)
