"""Running balance over an ordered array.

A balance that earns interest only above a threshold depends on the previous result, so a
window function cannot express it. ``F.aggregate`` can. Appending to one long accumulator
would copy it at every step, so the items are folded in short chunks: an array of n items
costs n * CHUNK copies instead of n * n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 32


def running_openings(
    items: Column, first: Column, step: Callable[[Column, Column], Column]
) -> Column:
    """Balance *before* each item of a non-empty ``items`` array, as ``array<double>``.

    ``first`` is the balance before the first item; ``step(balance, item)`` the one after it.
    """

    def add(balances: Column, item: Column) -> Column:
        return F.array_append(balances, step(F.element_at(balances, -1), item))

    def fold_chunk(done: Column, chunk: Column) -> Column:
        carried = F.element_at(F.element_at(done, -1), -1)
        return F.array_append(done, F.aggregate(chunk, F.array(carried), add))

    last_chunk = F.floor((F.size(items) - 1) / CHUNK).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), last_chunk),
        lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)),
    )
    folded = F.aggregate(chunks, F.array(F.array(first)), fold_chunk)
    # The first element only seeds the fold; the last value of every chunk is its carry.
    # The lengths are upper bounds: naming ``folded`` again would evaluate it again.
    return F.flatten(
        F.transform(F.slice(folded, 2, F.size(items)), lambda c: F.slice(c, 1, F.size(c) - 1))
    )
