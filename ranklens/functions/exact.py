"""Sums of doubles that don't depend on the order of their rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(term: Column, bits: int = 26, finite: bool = True) -> Column:
    """The sum in fixed point, with ``2 * bits`` binary places, as a double.

    Each term is cut into its floor and two parts of ``bits`` bits, which are
    summed as longs; so partial sums may be merged in any order, and equal
    terms in another order give the same sum.  A group may have 2^(63 - bits)
    terms.  ``finite=False`` lets NaN and infinite terms make the sum so.
    """
    scale = float(1 << bits)
    odd = F.isnan(term) | (F.abs(term) == float("inf"))
    t = term if finite else F.when(~odd, term)
    whole = F.floor(t)
    rest = (t - whole) * scale
    first = F.floor(rest)
    second = F.round((rest - first) * scale).cast("long")
    total = F.sum(whole) + (F.sum(first) + F.sum(second) / scale) / scale
    if finite:
        return total
    return F.when(F.count(term) > 0, F.coalesce(total, F.lit(0.0)) + F.coalesce(F.sum(F.when(odd, term)), F.lit(0.0)))


def exact_total(terms: Column) -> Column:
    """The sum of an array of doubles, the same in any order of its elements: fixed point with 52 binary places.

    Rows whose terms are permutations of each other get one number, so they
    tie.  An array may have 1,024 elements; a null element makes the sum null.
    """
    scale = float(1 << 52)
    add = lambda a, x: a + x
    whole = F.aggregate(F.transform(terms, lambda t: F.floor(t)), F.lit(0).cast("long"), add)
    part = F.aggregate(F.transform(terms, lambda t: F.round((t - F.floor(t)) * scale).cast("long")), F.lit(0).cast("long"), add)
    return (whole + F.shiftright(part, 52)) + part.bitwiseAND(F.lit((1 << 52) - 1)) / scale
