"""Counts of the products that a product meets, on arrays in Python workers.

``met_counter`` reads rows of one purchase each, sorted by the product ``a``:
``a``, its buyers ``na`` and buyers in long lists ``ha``, the products ``p`` of the
customer's list with their ``n`` and ``h`` (no ``h``: none has any), and ``edge``.
Lists are counted as many at once as hold about ``at_once`` products, a product's
all in one go, so that a task holds little however much it reads.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers get these functions with the job; they need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT_ONCE = 250_000


def met_counter(n: int | None, at_once: int = AT_ONCE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """With ``n``, the ``n`` best of each ``a`` and their rank; else all it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(pc.list_value_length(batch["p"])).as_py() or 0
            if size < at_once:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            a = rows["a"]
            whole = pc.index(a, a[-1]).as_py()  # rows before the last product's
            held, size = [rows], 0
            if whole:
                yield from slices(rows.slice(0, whole), n, at_once)
                held = [rows.slice(whole)]
                size = pc.sum(pc.list_value_length(held[0]["p"])).as_py() or 0
            held = [b for t in held for b in t.to_batches()]
        if held:
            yield from slices(pa.Table.from_batches(held).combine_chunks(), n, at_once)

    return run


def slices(rows: pa.Table, n: int | None, at_once: int) -> Iterator[pa.RecordBatch]:
    """``rows`` of whole products, counted in slices of about ``at_once``."""
    of = rows["a"].combine_chunks().dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(of)]
    cells = np.cumsum(pc.list_value_length(rows["p"]).to_numpy())
    first = done = 0
    for end in ends.tolist():
        if cells[end - 1] - done >= at_once or end == len(of):
            out = count(rows.slice(first, end - first), n)
            if out.num_rows:
                yield out
            first, done = end, cells[end - 1]


def numbered(a: pa.Array, p: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Whole numbers from 0 for the products of ``a`` and ``p``, in the order of the
    products, and how many numbers there are. All of ``a`` are among ``p``."""
    if pa.types.is_integer(p.type):
        x, y = a.to_numpy().astype(np.int64), p.to_numpy().astype(np.int64)
        low, high = int(y.min()), int(y.max())
        if high - low < 2 ** 40:
            return x - low, y - low, high - low + 1
    known = p.dictionary_encode()
    order = pc.array_sort_indices(known.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return (place[pc.index_in(a, value_set=known.dictionary).to_numpy()],
            place[known.indices.to_numpy()], len(order))


def grouped(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys (all under ``most``), ascending, where each is once, and how
    often it occurs. Where there is room the place is sorted with the key, which is
    several times faster than to sort places."""
    bits = max(1, len(key) - 1).bit_length()
    if (most << bits) < 2 ** 63:
        place = np.sort((key << bits) | np.arange(len(key)))
        key = place >> bits
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = place[starts] & ((1 << bits) - 1)
    else:
        place = np.argsort(key)
        key = key[place]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = place[starts]
    return key[starts], place, np.diff(np.r_[starts, len(key)])


def count(rows: pa.Table, n: int | None) -> pa.RecordBatch:
    """The counts of ``rows``, which hold all purchases of their products, by product."""
    a = rows["a"].combine_chunks()
    lists = rows["p"].combine_chunks()
    p = lists.flatten()
    own, other, numbers = numbered(a, p)
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    product = np.repeat(np.arange(len(starts)) * numbers, np.diff(np.r_[starts, len(own)]))
    key = np.repeat(product, pc.list_value_length(lists).to_numpy())
    key += other
    key, once, met = grouped(key, len(starts) * numbers)
    product = key // numbers
    b = key - product * numbers
    nb = rows["n"].combine_chunks().flatten().to_numpy()[once].astype(np.int64)
    keep = b != own[starts][product]
    if n is not None:
        # Whoever met once must be among the rarest that any of the lists begins with.
        edge = np.minimum.reduceat(rows["edge"].combine_chunks().to_numpy().astype(np.int64), starts)
        keep &= (met > 1) | (nb <= edge[product])
    once, met, product, b, nb = once[keep], met[keep], product[keep], b[keep], nb[keep]
    of = starts[product]
    na = rows["na"].combine_chunks().to_numpy().astype(np.int64)[of]
    out = {"met": met, "na": na, "nb": nb}
    if n is None:
        known = "h" in rows.column_names
        out["ha"] = rows["ha"].combine_chunks().to_numpy()[of] if known else np.zeros(len(of), np.int64)
        out["hb"] = rows["h"].combine_chunks().flatten().to_numpy()[once] if known else np.zeros(len(of), np.int64)
    else:
        similarity = met.astype(float) / np.sqrt((na * nb).astype(float))
        order = np.lexsort((b, -similarity, product))
        group = product[order]
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(begin, np.diff(np.r_[begin, len(group)])) + 1
        order, rank = order[rank <= n], rank[rank <= n]
        out = {c: x[order] for c, x in out.items()} | {"similarity": similarity[order], "rank": rank}
        of, once = of[order], once[order]
    kinds = {"rank": pa.int32(), "similarity": pa.float64()}
    found = {"a": a.take(pa.array(of)), "b": p.take(pa.array(once))} | {c: pa.array(x, kinds.get(c, pa.int64())) for c, x in out.items()}
    return pa.RecordBatch.from_arrays(list(found.values()), names=list(found))
