"""Operators 1 and 8 against direct computations."""

import itertools

import numpy as np
import zstandard as zstd
from pyspark.sql import functions as F

from tillsight.llm import chat, quality


def test_measure_is_the_difference_of_compressed_sizes():
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in range(300)]
    texts = [(b" ".join(words[i] for i in rng.integers(150 * y, 150 * y + 150, 200)), y) for y in (0, 1) for _ in range(40)]
    model = quality.Model(texts, dictionary=4096)
    for text, y in [*texts[::9], (b"", 0), (b"Zz 9", 0), (bytes(range(256)) * 20, 0)]:
        got = model.measure()(text)
        want, total = [], 0
        for view, pair in zip(quality.VIEWS, model.dicts):
            seen, sizes = text.translate(view) if view else text, []
            for d in pair:
                c = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT), level=model.level,
                                        write_checksum=False, write_content_size=False, write_dict_id=False)
                sizes.append(sum(len(c.compress(seen[i:i + model.piece])) for i in range(0, len(seen), model.piece)))
            total = total or sum(sizes)
            want.append((sizes[0] - sizes[1]) / (len(text) + quality.SHORT))
        assert np.allclose(got, (*want, np.log((total + quality.SHORT) / (2 * len(text) + quality.SHORT))))
    right = [(model.score(np.array([model.measure()(t)]))[0] >= 0.5) == y for t, y in texts]
    assert np.mean(right) > 0.9


def test_one_text_an_id_is_learned_from(spark):
    docs = spark.createDataFrame([(1, "a b")] + [(2, f"copy {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    got = quality.labelled_sample(docs, labels, "quality", F.lit(True), 10, 100)
    assert len(got) == 2 and sorted(y for _, y in got) == [0, 1]
    assert got == quality.labelled_sample(docs.repartition(3), labels, "quality", F.lit(True), 10, 100)


def test_viterbi_against_all_paths(spark):
    made = chat.transcripts(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    model = chat.train(made)
    texts = ["User: hi\nAssistant: yes?\nfine", "hello\n\nwhat?\nA: no", "System: x\n\n\nQ: y\nz", "one"]
    for text in texts:
        lines = chat.lines_of(text)
        path = model.states(lines)
        best = max(itertools.product(range(len(chat.STATES)), repeat=len(lines)), key=lambda p: score(model, lines, p))
        assert abs(score(model, lines, path) - score(model, lines, best)) < 1e-9


def score(model, lines, path):
    total, before = 0.0, None
    for line, state in zip(lines, path):
        total += model.emission(line[1], line[3])[state]
        total += model.start[state] if before is None else model.step[before][state]
        before = state
    return total
