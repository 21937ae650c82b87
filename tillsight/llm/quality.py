"""Operator 1, a compression classifier of text quality.

Two zstandard dictionaries, one trained on good text and one on bad, for the
text as it is and for its shape. A text is cut into pieces of ``piece`` bytes,
each compressed with both; the difference of the two sizes over the text's
length says which dictionary knows it better. A logistic curve over the
differences (and how far the text compresses at all), fitted on labelled texts
that the dictionaries have not seen, turns them into a probability.

Bounds: at most ``SAMPLE`` labelled rows of each class train the model, taken
in the order of a hash of their id, each with at most ``TRAIN_BYTES`` bytes
spread over the whole text. Scoring reads every whole text. The model (four
dictionaries of ``dictionary`` bytes, four numbers) goes out by broadcast.

Defined cases: null and empty texts score as texts without any difference; without
labels of both classes every score is the share of good labels (0.5 if there
are none); labels other than 0 and 1 and rows without a label train nothing;
every document row gets its own score, repeated rows the same one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, quoted, small, texts_of

SAMPLE = 3000
TRAIN_BYTES = 6000
DICTIONARY = 64 * 1024
PIECE = 1024
LEVEL = 3
FOLDS = 4
SHORT = 100  # bytes added to a length, so that short texts tend to no difference

# A text is looked at twice: as it is, and by its shape (letters, capitals,
# digits and bytes beyond ASCII each as one character).
_SHAPE = bytes(48 if 48 <= c <= 57 else 65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else c
               for c in range(256))
VIEWS = (None, _SHAPE)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int,
                    train_bytes: int, piece: int = PIECE) -> list[tuple[bytes, int]]:
    """Texts of at most ``sample`` label rows of each class for training, in
    a repeatable order, at most ``train_bytes`` bytes of each. ``learn``
    selects the label rows that may be learned from.

    The label rows are chosen first, so only a table of 2 * ``sample`` ids is
    broadcast. Of an id on several rows the text with the smallest hash counts, so
    at most that many shortened texts are shuffled to the driver.
    """
    rows = labels.filter(learn & quoted(label).isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.min(quoted(label)).cast("int").alias("label"))
    key = F.xxhash64("doc_id")
    chosen = None
    for y in (0, 1):
        own = rows.filter(F.col("label") == y).orderBy(key, "doc_id").limit(sample)
        chosen = own if chosen is None else chosen.unionAll(own)
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0).join(F.broadcast(chosen), "doc_id") \
        .select("text", "label", key.alias("key"), F.xxhash64("text").alias("hash"))

    def shorten(batches):
        for batch in small(batches, 0):
            parts = [spread(t, train_bytes, piece) for t in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), *batch.columns[1:]],
                                             names=["text", "label", "key", "hash"])

    got = (texts.mapInArrow(shorten, "text binary, label int, key long, hash long").groupBy("key", "label")
           .agg(F.min(F.struct("hash", "text"))["text"].alias("text")).toLocalIterator())
    return [(text, y) for _, text, y in sorted((r["key"], bytes(r["text"]), r["label"]) for r in got)]


def cut(text: bytes, size: int) -> list[bytes]:
    return [text[i:i + size] for i in range(0, len(text), size)]


def spread(text: bytes, limit: int, piece: int) -> bytes:
    """At most ``limit`` bytes in pieces spread evenly over the text."""
    if len(text) <= limit:
        return text
    parts = cut(text, piece)
    at = np.unique(np.linspace(0, len(parts) - 1, max(1, limit // piece)).astype(int))
    return b"".join(parts[i] for i in at)


class Model:
    """Dictionaries and calibration; plain data, so that it can be pickled."""

    def __init__(self, texts: list[tuple[bytes, int]], dictionary: int = DICTIONARY, piece: int = PIECE,
                 level: int = LEVEL):
        self.piece, self.level, self.dicts = piece, level, None
        ys = np.array([y for _, y in texts])
        self.prior = float(ys.mean()) if len(ys) else 0.5
        self.slopes, self.offset = np.zeros(3), _logit(self.prior)
        by = {y: [t for t, z in texts if z == y] for y in (0, 1)}
        if min(len(by[0]), len(by[1])) < 2:
            return
        # Each fold's texts get their differences from the dictionaries of
        # the other folds, for the calibration; the final ones use them all.
        diffs, marks = [], []
        folds = min(FOLDS, len(by[0]), len(by[1]))
        for fold in range(folds):
            self.dicts = _dictionaries({y: [t for i, t in enumerate(by[y]) if i % folds != fold] for y in (0, 1)},
                                       dictionary, piece)
            measure = self.measure()
            for y in (0, 1):
                for t in by[y][fold::folds]:
                    diffs.append(measure(t))
                    marks.append(y)
        self.dicts = _dictionaries(by, dictionary, piece)
        self.slopes, self.offset = _logistic(np.array(diffs), np.array(marks, float), self.prior)

    def measure(self):
        """A function from a text to its size differences, one for each view,
        and the logarithm of how far it compresses at all."""
        if not self.dicts:
            return lambda text: (0.0, 0.0, 0.0)
        pairs = []
        for view in self.dicts:
            made = [zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT) for d in view]
            for d in made:
                d.precompute_compress(level=self.level)
            pairs.append([zstd.ZstdCompressor(dict_data=d, level=self.level, write_checksum=False,
                                              write_content_size=False, write_dict_id=False) for d in made])

        def measure(text: bytes) -> tuple[float, ...]:
            out, total = [], 0
            for view, (bad, good) in zip(VIEWS, pairs):
                parts = cut(text.translate(view) if view else text, self.piece)
                sizes = [len(c.compress(p)) for c in (bad, good) for p in parts]
                half = len(parts)
                total = total or sum(sizes)
                out.append((sum(sizes[:half]) - sum(sizes[half:])) / (len(text) + SHORT))
            return (*out, float(np.log((total + SHORT) / (2 * len(text) + SHORT))))

        return measure

    def score(self, diffs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(diffs @ self.slopes + self.offset, -500, 500)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _dictionaries(by: dict[int, list[bytes]], size: int, piece: int) -> list[list[bytes]]:
    return [[_dictionary([t.translate(view) if view else t for t in by[y]], size, piece) for y in (0, 1)]
            for view in VIEWS]


def _dictionary(texts: list[bytes], size: int, piece: int) -> bytes:
    """A dictionary of ``size`` bytes: zstandard's own training picks the
    segments that recur; pieces of the texts fill what it leaves."""
    parts = [p for t in texts for p in cut(t, piece)]
    try:
        trained = zstd.train_dictionary(size, parts).as_bytes()[8:]
    except zstd.ZstdError:  # too little text for the trainer
        trained = b""
    fill, want = [], size - len(trained)
    for i in range(max(map(len, texts)) // piece + 1):
        for t in texts:
            if want > 0 and (p := t[i * piece:(i + 1) * piece]):
                fill.append(p[:want])
                want -= len(p)
    return b"".join(fill) + trained


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Slopes and offset of the calibration, by Newton steps with a weak
    penalty; the classes weigh as they occur."""
    scale = x.std(0)
    scale[scale == 0] = 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    keep = np.diag([0.1] * x.shape[1] + [1e-9])
    w = np.array([0.0] * x.shape[1] + [_logit(prior)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (p - y) + keep @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / scale, float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    return Model(labelled_sample(docs, labels, "quality", learn, sample, TRAIN_BYTES))


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one column more, the score, and its name."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh("quality_score", docs.columns)

    def work():
        model = held.value
        measure = model.measure()

        def score(columns: list[pa.Array]) -> list[pa.Array]:
            diffs = np.array([measure(t) for t in texts_of(columns[0])]).reshape(-1, 3)
            return [pa.array(model.score(diffs), pa.float64())]

        return score

    return mapped(docs, [text_col], [T.StructField(name, T.DoubleType())], work), name


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document; labels of remainder 1 modulo 3 are held out."""
    model = train(docs, labels, remainder("doc_id", 3) != 1)
    scored, name = quality_scores(docs.select("doc_id", "text"), model)
    score = quoted(name)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), score.alias("score"),
                         (score >= 0.5).cast("int").alias("predicted"))
