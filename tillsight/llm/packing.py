"""Operator 11, packing documents into sequences of at most ``length`` tokens.

1. A document is the ids of a public tokenizer's vocabulary and an end mark. Ids
   of words met before come from a bounded table of each worker.
2. Rows are dealt to groups of about ``GROUP_BYTES`` of text by a hash of their
   row number, so equal documents spread and no group follows a key. Groups are
   packed apart from each other.
3. In a group a document gives full sequences as long as it fills them; what is
   left of each goes first-fit, largest first, into bins of ``length``: a
   tournament tree over the bins' free room finds the first bin that has enough
   in a logarithm of steps.
4. As many bins as the group's tokens can fill stay, the fullest ones. The
   others are poured into the gaps of those, cut where a gap ends, and what
   remains (less than ``length``) is cut into sequences of powers of two, which
   need no padding. So nothing is padded.

Bounds: one shuffle, of ids; a group holds about ``GROUP_BYTES`` of text and at
least one document, and a document is whole in its group's task.

Defined cases: null and empty texts are an end mark alone; texts that spell a
special token of the vocabulary are ordinary text; repeated rows are packed each;
an empty table gives no rows. Each row's position in its input files decides its
group, so equal input and settings give equal sequences.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, pieces, quoted, texts_of

LENGTH = 2048
END = 1
GROUP_BYTES = 2 << 20
SEED = 11
# Words and pieces of a worker's tables, and how long a word there may be.
KNOWN_WORDS, KNOWN_PIECES, KNOWN_BYTES = 700_000, 400_000, 64


def default_tokenizer() -> str:
    """Place of the vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Bytes as the characters that the vocabulary file spells them with: those that
# show as themselves, the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
# Words of ASCII and Latin letters (each one code point, as is its lower case), and
# the pieces that the vocabulary cuts them into once they are in lower case (fixed
# values of the vocabulary).
_LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+")
_PROBE = "Don't STOP, it's 42: caf\u00e9-\u00c9t\u00e9 'll !'s \u0179\u0142 (e.g.) x\u00d7y \u65e5\u672c"


class Encoder:
    """Texts to little-endian 32-bit ids. The vocabulary drops white space, so the
    ids of a text are those of its words one after another, and those of a word are
    the merges of its pieces; words of other scripts take the tokenizer's whole way.
    Words and pieces met before are looked up, a bounded number of them."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.long: list[bytes] = []  # words that aren't kept
        whole = self.tokenizer.encode(_PROBE, add_special_tokens=False).ids
        if self.encode([_PROBE.encode()])[0] != packed_ids(whole):
            raise ValueError("not a vocabulary of words without white space")

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_SPELLED)
            ids = self.pieces[piece] = packed_ids([t.id for t in self.merges.tokenize(spelled)])
        return ids

    def _learn(self, words: list[bytes]) -> None:
        """Ids of words that aren't known yet."""
        known, piece, other = self.words, self._piece, []
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces.clear()
        for w in words:
            text = w.decode()
            if w.isalpha():  # of ASCII alone: one piece
                known[w] = piece(text)
            elif _LATIN.fullmatch(text):
                known[w] = b"".join(map(piece, _PIECES.findall(text.lower())))
            else:
                other.append(text)
        if other:
            for text, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
                known[text.encode()] = packed_ids(e.ids)
        self.long += [w for w in words if len(w) > KNOWN_BYTES]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        out = []
        for text in texts:
            words = text.lower().split()  # A-Z only
            ids = [*map(self.words.get, words)]
            if None in ids:
                if len(self.words) > KNOWN_WORDS:
                    self.words.clear()
                self._learn([w for w in dict.fromkeys(words) if w not in self.words])
                ids = [*map(self.words.__getitem__, words)]
            out.append(b"".join(ids))
            for w in self.long:
                del self.words[w]
            self.long = []
        return out


def worker_encoder(path: str | None) -> Encoder:
    """The encoder of this worker process, which serves many tasks: words that
    one of them met need not be learned by the next."""
    import tokenizers

    held = vars(tokenizers).setdefault("_held_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def encoded(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, end: int = END) -> tuple[DataFrame, str]:
    """``docs`` with one column more, and its name: the document's ids as
    little-endian 32-bit numbers, the end mark behind them."""
    name = fresh("ids", docs.columns)
    mark = packed_ids([end])

    def work():
        encoder = worker_encoder(tokenizer)

        def ids(columns: list[pa.Array]) -> list[pa.Array]:
            out = []
            for a, b in pieces(columns[0], 1 << 20):
                out += [x + mark for x in encoder.encode(list(texts_of(columns[0].slice(a, b - a))))]
            return [pa.array(out, pa.binary())]

        return ids

    return mapped(docs, [text_col], [T.StructField(name, T.BinaryType())], work), name


def first_fit(sizes: list[int], length: int) -> list[int]:
    """Bin of each size, first-fit in the given order; a tournament tree
    (each node holds the most room below it) plays out the first that fits."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [length] * (2 * leaves)
    out = []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        out.append(at - leaves)
        room[at] -= size
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return out


def pack(sizes: list[int], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents of
    these sizes. Every sequence is full or, for less than ``length`` tokens in
    all, of a power of two. ``length`` is a power of two itself."""
    sequence, rest = 0, []
    for d, n in enumerate(sizes):
        full = n // length
        for k in range(full):
            yield d, k * length, length, sequence, 0
            sequence += 1
        if n % length:
            rest.append((n % length, d, full * length))
    rest.sort(key=lambda r: (-r[0], r[1]))
    bins: dict[int, list] = {}
    for item, b in zip(rest, first_fit([r[0] for r in rest], length)):
        bins.setdefault(b, []).append(item)
    filled = sorted(bins.values(), key=lambda items: -sum(r[0] for r in items))  # stable: earlier bins first
    total = sum(r[0] for r in rest)
    stay = filled[:total // length]
    loose = [r for items in filled[total // length:] for r in items][::-1]  # taken from the end

    def pour(room: int, offset: int):
        """Loose pieces into ``room`` tokens of the current sequence."""
        while room:
            n, d, start = loose.pop()
            part = min(n, room)
            if part < n:
                loose.append((n - part, d, start + part))
            yield d, start, part, sequence, offset
            room, offset = room - part, offset + part

    for items in stay:
        offset = 0
        for n, d, start in items:
            yield d, start, n, sequence, offset
            offset += n
        yield from pour(length - offset, offset)
        sequence += 1
    left = total % length
    for bit in range(left.bit_length() - 1, -1, -1):
        if left >> bit & 1:
            yield from pour(1 << bit, 0)
            sequence += 1


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, tokenizer: str | None = None,
           end: int = END, group_bytes: int = GROUP_BYTES, seed: int = SEED) -> DataFrame:
    """The pieces: document id, ``start`` (its document's tokens before it),
    ``ids`` (little-endian 32-bit), ``length``, ``doc_tokens`` (of the whole
    document), ``sequence_id`` and ``offset`` there."""
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)) + 16)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    ids, name = encoded(rows, "text", tokenizer, end)
    dealt = ids.select("id", "row", F.col(name).alias("ids"), F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups)).alias("group"))
    schema = T.StructType([T.StructField(id_col, dealt.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in
                           ("start", "length")), T.StructField("ids", T.BinaryType()),
                           *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset"))])

    def run(table: pa.Table) -> pa.Table:
        # By row number, so that the order of arrival doesn't matter.
        table = table.take(pc.sort_indices(table["row"]))
        blobs = table["ids"].to_pylist()
        sizes = [len(b) // 4 for b in blobs]
        made = list(pack(sizes, length))
        first = table["group"][0].as_py() << 32
        at = pa.array([p[0] for p in made], pa.int64())
        return pa.Table.from_arrays([
            table["id"].take(at), pa.array([p[1] for p in made], pa.int64()), pa.array([p[2] for p in made], pa.int64()),
            pa.array([blobs[d][4 * s:4 * (s + n)] for d, s, n, _, _ in made], pa.binary()),
            pa.array([sizes[p[0]] for p in made], pa.int64()), pa.array([first + p[3] for p in made], pa.int64()),
            pa.array([p[4] for p in made], pa.int64())], names=schema.names)

    return dealt.groupBy("group").applyInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum for their ids."""
    return packed(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
