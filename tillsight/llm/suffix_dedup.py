"""Operator 5, substring dedup by longest-previous-factor arrays.

A byte goes if it lies in a string of ``LENGTH`` (100) bytes that also starts
earlier: in a smaller id, or earlier in the same text. The longest previous
factor of a position, found from the previous and the next smaller position in
suffix order, says whether it starts such a string.

Sorting every suffix of the corpus would move many times its size, so suffixes
are first narrowed to those that can match, without losing any:

1. Every string of 100 bytes has a smallest hashed 20-gram (leftmost if tied).
   Strings in a row with the same one form a run; equal strings lie in runs
   with the same 20-gram. A run travels as four numbers: the 20-gram, a hash of
   the run's whole text, the id, and four short hashes of 80-byte cores, one of
   which two runs share if they share a string. One shuffle by 20-gram finds
   the later runs that are equal to an earlier one as a whole (all their
   strings repeat), and the unequal runs that share a core.
2. Only these send their text. Per 20-gram, the suffix order of their strings
   gives previous and next smaller positions and the longest previous factors.
3. What a document loses comes back to it as hashes of runs and strings. Its
   text is scanned again and cut.

Hot runs: equal runs collapse inside each batch before the shuffle, so copies
and shared passages cost a row a batch. A 20-gram with more than ``LOCAL``
unequal runs in one batch (the edges of a passage that many documents share) is
dealt by run instead, and such groups, or any of more than ``GROUP`` unequal
runs, take an exact way of their own: string by string, dealt by the string's
hash. Matches are decided on 64-bit hashes of runs (within one 20-gram) and of
strings (within one document), and on the bytes themselves in suffix order.

Defined cases: null text is empty and loses nothing, as do texts under 100
bytes; rows with the same id tie, none is earlier than the other; a null id
comes after all others; an empty table gives no rows. Ids must be integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, pieces, quoted, small, staged, texts_of
from .near_dedup import _mixed

LENGTH, GRAM, CORE = 100, 20, 80
LOCAL, GROUP = 64, 512
PIECE = 1 << 18
_LAST_ID = (1 << 63) - 1
_SLOTS = LENGTH - GRAM + 1
_AT = np.uint64((1 << 24) - 1)  # low bits of a sort key that hold the position
# What a document is told: a run, or a string, that goes wherever it is; or
# wherever it is but for the first time.
RUN, RUN_AGAIN, STRING, STRING_AGAIN = 1, 2, 3, 4
# Rows of the first shuffle: a run to compare, a fact that only travels along,
# a mark that a 20-gram is hot, a run of a hot 20-gram.
_COMPARE, _FACT, _HOT, _WIDE = 0, 1, 2, 3


def _hasher():
    """A function from bytes to a function that hashes any stretches of them."""
    rng = np.random.default_rng(17)
    value = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(1, 1 << 62)) * 2 + 1
    held = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

    def powers(n: int):
        if len(held["up"]) < n:
            inverse = pow(base, -1, 1 << 64)
            for name, x in (("up", base), ("down", inverse)):
                p = held[name]
                while len(p) < n:
                    p = np.concatenate([p, p * np.uint64(pow(x, len(p), 1 << 64))])
                held[name] = p
        return held["up"], held["down"]

    def over(data: np.ndarray):
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * down[:len(data)], out=sums[1:])
        return lambda start, size: _mixed((sums[start + size] - sums[start]) * up[start] + np.uint64(7) * np.asarray(size, np.uint64))

    return over


def runs_of(data: np.ndarray, ends: np.ndarray, over):
    """The runs of texts laid end to end: arrays of ``doc``, ``start`` (of the
    first string), ``count`` (of strings), ``gram``, ``run`` and ``cores``.
    Also a function that hashes stretches."""
    stretch = over(data)
    n = len(data) - LENGTH + 1
    begins = np.concatenate([[0], ends[:-1]])
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none, stretch
    where = np.arange(len(data) - GRAM + 1)
    grams = stretch(where, GRAM)
    low = (grams & ~_AT) | (where.astype(np.uint64) & _AT)
    width = 1
    while 2 * width <= _SLOTS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[_SLOTS - width:][:n])
    first = np.arange(n)
    gram_at = first + ((low - first.astype(np.uint64)) & _AT).astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    whole = doc[:n] == doc[LENGTH - 1:]
    new = np.ones(n, bool)
    new[1:] = (gram_at[1:] != gram_at[:-1]) | ~whole[:-1] | (doc[1:n] != doc[:n - 1])
    start = np.flatnonzero(new)
    count = np.diff(start, append=n)
    start, count = start[whole[start]], count[whole[start]]
    # A run ends with its text: strings beyond are no strings of a text.
    count = np.minimum(count, ends[doc[start]] - LENGTH + 1 - start)
    at, of = gram_at[start], doc[start]
    run = stretch(start, count + LENGTH - 1)
    cores = np.zeros(len(start), np.uint64)
    before = at - start  # bytes before the 20-gram in the run's first string
    after = at - (start + count - 1)
    for k, t in enumerate(range(0, CORE - GRAM + 1, GRAM)):
        c = at - t
        there = (c >= begins[of]) & (c + CORE <= ends[of]) & (before >= t) & (after <= t + GRAM)
        value = stretch(np.where(there, c, start), np.where(there, CORE, 1))
        absent = _mixed(run + np.uint64(k + 1) + np.uint64(31) * of.astype(np.uint64))
        value = np.where(there, value, absent) >> np.uint64(49)
        cores |= value << np.uint64(15 * k)
    return of, start, count, grams[at], run, cores.view(np.int64), stretch


def _laid(column: pa.Array, a: int, b: int):
    texts = list(texts_of(column.slice(a, b - a)))
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), texts


def _ids(column: pa.Array) -> np.ndarray:
    return np.array([_LAST_ID if x is None else x for x in column.to_pylist()], np.int64)


def _heads(*keys):
    """Whether a sorted row differs from the one before in any key."""
    head = np.ones(len(keys[0]), bool)
    head[1:] = False
    for k in keys:
        head[1:] |= k[1:] != k[:-1]
    return head


_ROWS = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "run", "doc", "cores")])
_KIND = 60  # the kind of a row stands above its cores


def _packed(key, run, doc, cores, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(run.view(np.int64)), pa.array(doc),
         pa.array(cores | (np.asarray(kind, np.int64) << _KIND))], names=_ROWS.names)


def _emit_runs(batches):
    over = _hasher()
    for batch in batches:
        ids, got = _ids(batch.column(0)), []
        for a, b in pieces(batch.column(1), PIECE):
            data, ends, _ = _laid(batch.column(1), a, b)
            of, _, _, gram, run, cores, _ = runs_of(data, ends, over)
            got.append((gram, run, ids[a + of], cores))
        if not got:
            continue
        gram, run, doc, cores = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((doc, run, gram))
        gram, run, doc, cores = gram[order], run[order], doc[order], cores[order]
        of_doc = _heads(gram, run, doc)
        again = np.zeros(len(doc), bool)
        again[:-1] = of_doc[:-1] & ~of_doc[1:]
        if again.any():  # a run that repeats within its text
            yield _packed(_mixed(run[again] + doc[again].view(np.uint64)), run[again], doc[again],
                          np.full(again.sum(), RUN_AGAIN), _FACT)
        gram, run, doc, cores = gram[of_doc], run[of_doc], doc[of_doc], cores[of_doc]
        first = _heads(gram, run)
        later = ~first
        if later.any():
            yield _packed(_mixed(run[later] + doc[later].view(np.uint64)), run[later], doc[later],
                          np.full(later.sum(), RUN), _FACT)
        gram, run, doc, cores = gram[first], run[first], doc[first], cores[first]
        group = np.cumsum(_heads(gram)) - 1
        size = np.bincount(group)[group] if len(group) else group
        hot = size > LOCAL
        if hot.any():
            yield _packed(_mixed(gram[hot] ^ run[hot]), run[hot], doc[hot], cores[hot], _WIDE)
            marks = np.unique(gram[hot])
            yield _packed(marks, marks, np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64), _HOT)
        yield _packed(gram[~hot], run[~hot], doc[~hot], cores[~hot], _COMPARE)


_FOUND = T.StructType([T.StructField("doc", T.LongType()), T.StructField("value", T.LongType()),
                       T.StructField("kind", T.IntegerType()), T.StructField("gram", T.LongType())])
_NARROW, _SPREAD = 11, 12  # runs whose text is wanted: in suffix order, or string by string


def _found(doc, value, kind, gram=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(value), pa.array(np.broadcast_to(np.int32(kind), len(doc))),
         pa.array(np.zeros(len(doc), np.int64) if gram is None else gram)], names=_FOUND.names)


def _compare_runs(batches):
    """One partition of the first shuffle: facts, and the runs to look into."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows]
    if not parts:
        return
    key, run, doc, cores = (np.concatenate(x) for x in zip(*parts))
    kind, cores = cores >> _KIND, cores & ((1 << _KIND) - 1)
    fact = kind == _FACT
    for what in (RUN, RUN_AGAIN):
        own = fact & (cores == what)
        yield _found(doc[own], run[own], what)
    key, run, doc, cores, kind = (x[~fact] for x in (key, run, doc, cores, kind))
    mark = kind == _HOT
    hot = np.unique(key[mark])
    key, run, doc, cores, kind = (x[~mark] for x in (key, run, doc, cores, kind))
    order = np.lexsort((doc, run, key))
    key, run, doc, cores, kind = (x[order] for x in (key, run, doc, cores, kind))
    head = _heads(key, run)
    earliest = doc[np.flatnonzero(head)][np.cumsum(head) - 1] if len(doc) else doc
    later = doc > earliest
    yield _found(doc[later], run[later], RUN)
    key, run, doc, cores, kind = (x[head] for x in (key, run, doc, cores, kind))
    group = np.cumsum(_heads(key)) - 1
    several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    marked = np.isin(key, hot)
    wanted = (kind == _WIDE) | marked
    for k in range(4):
        own = (cores >> (15 * k)) & 0x7FFF
        at = np.flatnonzero(several)
        at = at[np.lexsort((own[at], key[at]))]
        same = ~_heads(key[at], own[at])
        wanted[at[same]] = True
        wanted[at[:-1][same[1:]]] = True
    key, run, doc, kind, marked, group = (x[wanted] for x in (key, run, doc, kind, marked, group))
    wide = (kind == _WIDE) | marked | (np.bincount(group)[group] > GROUP if len(group) else np.zeros(0, bool))
    yield _found(doc[~wide], run[~wide], _NARROW, key[~wide])
    yield _found(doc[wide], run[wide], _SPREAD)


# --- longest previous factors -------------------------------------------------

def suffix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all positions by their first 8, 16, 32, ... and ``length``
    bytes, by prefix doubling; equal stretches have equal ranks. Bytes beyond
    the end count as 0."""
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    word = np.zeros(len(padded) - 8, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + len(word)]
    rank, size, levels = np.unique(word, return_inverse=True)[1], 8, []
    levels.append((size, rank))
    while size < length:
        step = min(size, length - size)
        next_ = np.concatenate([rank[step:], np.zeros(step, rank.dtype)])
        rank = np.unique(rank.astype(np.uint64) << np.uint64(32) | next_.astype(np.uint64), return_inverse=True)[1]
        size += step
        levels.append((size, rank))
    return levels


def nearest_smaller(place: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it with a smaller value; -1 if none."""
    near = np.arange(len(place)) - 1
    while True:
        open_ = np.flatnonzero(near >= 0)
        open_ = open_[place[near[open_]] >= place[open_]]
        if not len(open_):
            return near
        near[open_] = near[near[open_]]


def common_prefix(levels, i: np.ndarray, j: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, up to ``length``."""
    same = np.zeros(len(i), np.int64)
    full = levels[-1][1][i] == levels[-1][1][j]
    for size, rank in reversed(levels[:-1]):
        equal = (rank[np.minimum(i + same, len(rank) - 1)] == rank[np.minimum(j + same, len(rank) - 1)]) & (same + size <= length)
        same += size * equal
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    going = np.ones(len(i), bool)
    for _ in range(7):
        going &= padded[np.minimum(i + same, len(padded) - 1)] == padded[np.minimum(j + same, len(padded) - 1)]
        same += going
    return np.where(full, length, np.minimum(same, length - 1))


def longest_previous(data: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int = LENGTH):
    """Longest previous factor, up to ``length``, of the suffixes that begin
    at ``starts``; ``place`` ranks their positions (equal: the same position).
    Returns the factors and where each one's earliest equal lies (an index into
    ``starts``; meaningful where the factor reaches ``length``)."""
    levels = suffix_ranks(data, length)
    rank = levels[-1][1][starts]
    order = np.lexsort((place, rank))
    at, pos = starts[order], place[order]
    back = nearest_smaller(pos)
    ahead = len(pos) - 1 - nearest_smaller(pos[::-1])[::-1]
    factor = np.zeros(len(pos), np.int64)
    for near, some in ((back, back >= 0), (ahead, ahead < len(pos))):
        factor[some] = np.maximum(factor[some], common_prefix(levels, at[some], at[near[some]], data, length))
    head = _heads(rank[order])
    earliest = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    out, first = np.empty_like(factor), np.empty_like(earliest)
    out[order], first[order] = factor, earliest
    return out, first


_STRINGS = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", T.LongType()),
                         T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("text", T.BinaryType())])


def _send_text(batches):
    """The text of the runs to look into, or the hashes of their strings."""
    over = _hasher()
    for batch in batches:
        ids, wanted = _ids(batch.column(0)), batch.column(2)
        out = []
        for a, b in pieces(batch.column(1), PIECE):
            data, ends, _ = _laid(batch.column(1), a, b)
            of, start, count, _, run, _, stretch = runs_of(data, ends, over)
            begins = np.concatenate([[0], ends[:-1]])
            raw = data.tobytes()
            edges = np.searchsorted(of, np.arange(b - a + 1))
            for d in range(b - a):
                lo, hi = edges[d], edges[d + 1]
                by = {r: i for i, r in zip(range(hi - 1, lo - 1, -1), run[lo:hi][::-1].view(np.int64).tolist())}
                for want in wanted[a + d].as_py():
                    i = by.get(want["value"])
                    if i is None:
                        continue
                    s, n = int(start[i]), int(count[i])
                    if want["kind"] == _NARROW:
                        out.append((want["gram"], int(ids[a + d]), s - int(begins[d]), _NARROW, raw[s:s + n + LENGTH - 1]))
                    else:
                        hashes = stretch(np.arange(s, s + n), LENGTH).view(np.int64).tolist()
                        out += [(x, int(ids[a + d]), s - int(begins[d]) + k, _SPREAD, None) for k, x in enumerate(hashes)]
        # Equal strings of a batch collapse before they are dealt by string.
        wide, kept = {}, [x for x in out if x[3] == _NARROW]
        for key, doc, at, kind, _ in out:
            if kind == _SPREAD:
                wide.setdefault(key, {}).setdefault(doc, set()).add(at)
        for key, docs in wide.items():
            least = min(docs)
            for doc, ats in docs.items():
                if doc == least:
                    kept.append((key, doc, 0, _SPREAD, None))
                    if len(ats) > 1:
                        kept.append((key, doc, key, STRING_AGAIN, None))
                else:
                    kept.append((int(np.uint64(_mixed(np.array([key], np.int64).view(np.uint64) + np.uint64(doc & _LAST_ID)))[0].view(np.int64)),
                                 doc, key, STRING, None))
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), (
                pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=_STRINGS.names)


def _factor_strings(batches):
    """One partition of the second shuffle: which strings start earlier too."""
    over = _hasher()
    rows = [x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns))]
    facts = [(d, v, k) for _, d, v, k, _ in rows if k in (STRING, STRING_AGAIN)]
    spread = sorted({(x, d) for x, d, _, k, _ in rows if k == _SPREAD})
    facts += [(d, x, STRING) for (x, d), (y, _) in zip(spread[1:], spread) if x == y]
    if facts:
        doc, value, kind = zip(*facts)
        yield _found(np.array(doc, np.int64), np.array(value, np.int64), np.array(kind, np.int32))
    narrow = sorted({(x, d, s, t) for x, d, s, k, t in rows if k == _NARROW})
    del rows
    at = 0
    while at < len(narrow):
        # As many whole 20-grams as make a block.
        stop, size = at, 0
        while stop < len(narrow) and (size < PIECE or narrow[stop][0] == narrow[stop - 1][0]):
            size += len(narrow[stop][3])
            stop += 1
        block = narrow[at:stop]
        at = stop
        data = np.frombuffer(b"".join(x[3] for x in block), np.uint8)
        sizes = np.array([len(x[3]) for x in block])
        counts = sizes - LENGTH + 1
        base = np.cumsum(sizes) - sizes
        span = np.repeat(np.arange(len(block)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = base[span] + inside
        doc = np.array([x[1] for x in block], np.int64)[span]
        begin = np.array([x[2] for x in block], np.int64)[span] + inside
        order = np.lexsort((begin, doc))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(_heads(doc[order], begin[order])) - 1
        factor, first = longest_previous(data, starts, place)
        late = np.flatnonzero(factor >= LENGTH)
        if len(late):
            value = over(data)(starts[late], LENGTH).view(np.int64)
            other = doc[first[late]] < doc[late]
            yield _found(doc[late], value, np.where(other, STRING, STRING_AGAIN))


def removed_bytes(text: bytes, facts: dict[int, list[int]], over) -> np.ndarray:
    """Flat pairs of the maximal stretches [start, end) of ``text`` that go."""
    data = np.frombuffer(text, np.uint8)
    _, start, count, _, run, _, stretch = runs_of(data, np.array([len(data)]), over)
    run = run.view(np.int64)
    gone = np.isin(run, facts.get(RUN, []))
    if facts.get(RUN_AGAIN):
        again = np.ones(len(run), bool)
        again[np.unique(run, return_index=True)[1]] = False
        gone |= again & np.isin(run, facts[RUN_AGAIN])
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, start[gone], 1)
    np.add.at(edge, (start + count + LENGTH - 1)[gone], -1)
    if facts.get(STRING) or facts.get(STRING_AGAIN):
        every = stretch(np.arange(len(data) - LENGTH + 1), LENGTH).view(np.int64)
        late = np.isin(every, facts.get(STRING, []))
        if facts.get(STRING_AGAIN):
            at = np.flatnonzero(np.isin(every, facts[STRING_AGAIN]))
            again = np.ones(len(at), bool)
            again[np.unique(every[at], return_index=True)[1]] = False
            late[at[again]] = True
        at = np.flatnonzero(late)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LENGTH, -1)
    covered = np.cumsum(edge) > 0
    return np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one column more, the flat pairs of byte offsets of what
    goes, and its name."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc"), quoted(text_col).alias("text")) \
        .filter(F.octet_length("text") >= LENGTH)
    dealt = rows.mapInArrow(_emit_runs, _ROWS).repartition("key")
    found = staged(dealt.mapInArrow(_compare_runs, _FOUND), "suffix-runs")
    wanted = (found.filter(F.col("kind").isin(_NARROW, _SPREAD)).groupBy("doc")
              .agg(F.collect_list(F.struct("value", "kind", "gram")).alias("wanted")))
    key = F.coalesce("doc", F.lit(_LAST_ID))
    keyed = rows.withColumn("doc", key)
    sent = keyed.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(_send_text, _STRINGS)
    strings = sent.repartition("key").mapInArrow(_factor_strings, _FOUND)
    facts = (found.filter(F.col("kind").isin(RUN, RUN_AGAIN)).unionAll(strings)
             .groupBy("doc").agg(F.collect_list(F.struct("value", "kind")).alias("facts")))
    facts = staged(facts, "suffix-facts")
    name = fresh("removed", docs.columns)
    told, own = fresh("_facts", docs.columns), fresh("_doc", docs.columns)
    joined = docs.withColumn(own, F.coalesce(quoted(id_col).cast("long"), F.lit(_LAST_ID))) \
        .join(facts.select(F.col("doc").alias(own), F.col("facts").alias(told)), own, "left") \
        .select(*[quoted(c) for c in docs.columns], quoted(told))

    def work():
        over = _hasher()

        def cut(columns: list[pa.Array]) -> list[pa.Array]:
            out = []
            for text, told in zip(texts_of(columns[0]), columns[1]):
                if len(text) < LENGTH or not told.is_valid:
                    out.append(np.zeros(0, np.int64))
                    continue
                values = told.values.field("value").to_numpy(zero_copy_only=False)
                kinds = told.values.field("kind").to_numpy(zero_copy_only=False)
                out.append(removed_bytes(text, {k: values[kinds == k].tolist() for k in np.unique(kinds)}, over))
            return [pa.array(out, pa.list_(pa.int64()))]

        return cut

    return mapped(joined, [text_col, told], [T.StructField(name, T.ArrayType(T.LongType()))], work).drop(told), name


def report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, removed stretches and the digest of
    what stays."""
    cut, name = suffix_dedup(docs.select("doc_id", "text"))
    schema = T.StructType([cut.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType())])

    def summed(batches):
        for batch in small(batches, 1):
            got = []
            for text, spans in zip(texts_of(batch.column(1)), batch.column(2)):
                edges = [0, *spans.as_py(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                got.append((len(text), len(text) - len(kept), (len(edges) - 2) // 2, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([g[i] for g in got], pa.int64() if i < 3 else pa.string()) for i in range(4))],
                names=schema.names)

    return cut.select("doc_id", "text", quoted(name)).mapInArrow(summed, schema)


SQL = rf"""
WITH t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, {2 * LENGTH})) AS k
  FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS pos FROM t)
), f AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS r FROM p
), later AS (
  SELECT doc_id, pos, pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + {LENGTH} AS apart FROM f WHERE r > 1
), runs AS (
  SELECT doc_id, pos, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM later
), spans AS (
  SELECT doc_id, min(pos) AS s, max(pos) + {LENGTH} AS e FROM runs GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM spans
), kept AS (
  SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) || substr(any_value(h), 2 * max(e) + 1) AS h
  FROM cuts JOIN t USING (doc_id) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""
