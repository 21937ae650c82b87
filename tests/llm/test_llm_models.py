"""Operators 1, 7 and 8: accuracy on labels not learned from, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import docs, empty, rows
from tillsight.llm import chat, quality, toxicity

SF = "/root/testdata/sf0.01"


def tables(spark, *names):
    return [spark.read.parquet(f"{SF}/{n}.parquet") for n in names]


@pytest.fixture(scope="module")
def quality_model(spark):
    return quality.train(*tables(spark, "documents", "labels"), quality.remainder("doc_id", 3) != 1)


@pytest.fixture(scope="module")
def toxicity_model(spark):
    return toxicity.train(*tables(spark, "documents", "labels"), toxicity.learnable(), sample=300)


def test_quality_on_held_out_labels(spark, quality_model):
    scored, name = quality.quality_scores(tables(spark, "documents")[0], quality_model)
    got = scored.join(tables(spark, "labels")[0], "doc_id").filter(quality.remainder("doc_id", 3) == 1).toPandas()
    assert ((got[name] >= 0.5) == got.quality).mean() > max(0.93, got.quality.mean())


def test_toxicity_on_held_out_labels(spark, toxicity_model):
    scored, name = toxicity.toxicity_scores(tables(spark, "documents")[0], toxicity_model)
    english = scored.filter("lang = 'en'").join(tables(spark, "labels")[0], "doc_id").filter(~toxicity.learnable()).toPandas()
    rank = english[name].rank()
    pos = english.toxic == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.9
    assert english[name].between(0, 1).all()


@pytest.mark.parametrize("which", ["quality", "toxicity"])
def test_scores_of_awkward_rows(spark, which, request):
    module = {"quality": quality, "toxicity": toxicity}[which]
    score = getattr(module, f"{which}_scores")
    model = request.getfixturevalue(f"{which}_model")
    scored, name = score(docs(spark), model)
    assert name != f"{which}_score" and scored.columns == [*docs(spark).columns, name]
    got = scored.collect()
    assert len(got) == len(rows())
    by = {}
    for r in got:
        assert 0 <= r[name] <= 1
        by.setdefault(r.text or "", set()).add(r[name])
    assert all(len(v) == 1 for v in by.values())  # repeated rows score alike
    assert score(empty(spark), model)[0].count() == 0


def test_models_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 7, 3), (None, 1, 1)], "doc_id long, quality int, toxic int")
    data = docs(spark)
    for labels, want in ((none, 0.5), (one, 1.0)):
        model = quality.train(data, labels, F.lit(True))
        assert np.allclose(quality.quality_scores(data, model)[0].select("_quality_score").toPandas(), want, atol=1e-5)
        model = toxicity.train(data, labels, F.lit(True))
        assert np.allclose(toxicity.toxicity_scores(data, model)[0].select("_toxicity_score").toPandas(), 0)


def test_quality_and_toxicity_learn_only_from_their_folds(spark):
    labels = spark.range(60).select(F.col("id").alias("doc_id"))
    import zlib
    got = {r.doc_id: (r.a, r.b) for r in labels.select(
        "doc_id", quality.remainder("doc_id", 3).alias("a"), toxicity.learnable().alias("b")).collect()}
    for i, (a, b) in got.items():
        assert a == zlib.crc32(str(i).encode()) % 3 and b == (zlib.crc32(str(i).encode()) % 5 != 0)


def test_windows_cover_every_token_and_overlap():
    for n in (1, 5, 24, 25, 36, 37, 100):
        s = toxicity.window_starts(n)
        seen = np.zeros(n, int)
        for x in s:
            seen[x:x + toxicity.WINDOW] += 1
        assert (seen > 0).all() and (np.diff(s) <= toxicity.STRIDE).all() and s[-1] == max(n - toxicity.WINDOW, 0)


def test_toxicity_score_does_not_depend_on_the_batch(toxicity_model):
    rng = np.random.default_rng(5)
    known = sorted(toxicity_model.ids)
    texts = [b" ".join(known[i] if rng.random() < 0.8 else b"w%d" % i + b"x" * (i % 30)
                       for i in rng.integers(0, len(known), rng.integers(1, 90))) for _ in range(3000)]
    among = toxicity.Scorer(toxicity_model).texts(texts)
    backwards = toxicity.Scorer(toxicity_model).texts(texts[::-1])[::-1]
    assert (among == backwards).all()
    for i in (*range(60), 1499, 2998, 2999):
        scorer = toxicity.Scorer(toxicity_model)
        other = texts[(i + 1) % 3000:][:5]
        assert scorer.texts([texts[i]])[0] == toxicity.Scorer(toxicity_model).texts([*other, texts[i]])[-1] \
            == toxicity.Scorer(toxicity_model).texts([texts[i], *other])[0] == among[i]


def test_toxicity_scorer_agrees_with_the_training_code(toxicity_model):
    """The highest window of whole texts, each window by ``encode``."""
    w, model = toxicity_model.weights, toxicity_model
    rng = np.random.default_rng(6)
    known = sorted(model.ids)
    for n in (1, 7, 23, 24, 25, 60, 151):
        words = [known[i] if i % 5 else b"unseen%d" % i for i in rng.integers(0, len(known), n)]
        values = []
        for s in toxicity.window_starts(n):
            part = words[s:s + toxicity.WINDOW]
            ids = [model.ids.get(x, 0) for x in part]
            chars, real = toxicity.letters(part)
            spelled = toxicity.encode(w, "char", w["chars"][chars], real)
            x = np.concatenate([w["words"][ids], spelled, 0.3 * model.odds[ids][:, None]], 1)[:, None]
            pooled = toxicity.encode(w, "word", x, np.ones((len(part), 1), bool))
            values.append(float((pooled @ w["out"] + w["out_bias"])[0]))
        got = toxicity.Scorer(model).texts([b" ".join(words)])[0]
        assert abs(got - 1 / (1 + np.exp(-max(values)))) < 1e-4


def test_gradient_of_the_network():
    """The written gradients against differences of the loss."""
    words = [f"w{i}".encode() for i in range(9)]
    texts = [(b" ".join(words[(i * k) % 9] for k in range(1, 14)), i % 2) for i in range(8)]
    toxicity_epochs, toxicity.EPOCHS, steps, toxicity.STEPS = toxicity.EPOCHS, 1, toxicity.STEPS, 1
    try:
        model = toxicity.Model(texts, (4, 4))
    finally:
        toxicity.EPOCHS, toxicity.STEPS = toxicity_epochs, steps
    rng = np.random.default_rng(0)
    model.weights = {k: rng.standard_normal(v.shape) * 0.3 for k, v in model.weights.items()}
    parts = [toxicity.tokens(t) for t, _ in texts][:4]
    ys, weigh = np.array([0, 1, 0, 1]), np.array([1.0, 0.5, 2.0, 1.0])
    without = [model.odds.astype(float), model.odds.astype(float)]

    class Never:
        def random(self, n):
            return np.ones(n)

    def loss():
        scorer_x = []
        for p, y in zip(parts, ys):
            ids = [model.ids.get(x, 0) for x in p]
            chars, real = toxicity.letters(p)
            spelled = toxicity.encode(model.weights, "char", model.weights["chars"][chars], real)
            x = np.concatenate([model.weights["words"][ids], spelled, 0.3 * model.odds[ids][:, None]], 1)[:, None]
            pooled = toxicity.encode(model.weights, "word", x, np.ones((len(p), 1), bool))
            scorer_x.append((pooled @ model.weights["out"] + model.weights["out_bias"])[0])
        z = np.array(scorer_x)
        return float((weigh * (np.log1p(np.exp(z)) - ys * z)).sum() / len(parts))

    grads = model._gradient(parts, ys, weigh, without, Never())
    for name, w in model.weights.items():
        flat, g = w.reshape(-1), grads[name].reshape(-1).astype(float)
        if name in ("out", "words"):
            g = g - 1e-4 * flat  # the penalty
        for i in np.argsort(-np.abs(g))[:2]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - g[i]) < 2e-3 + 0.08 * abs(g[i]), name


def test_chat_on_held_out_conversations(spark):
    got = chat.report(tables(spark, "conversations")[0]).filter("held_out").agg(
        (F.sum("n_right") / F.sum("n_lines")).alias("right"), F.count("*").alias("n")).first()
    assert got.n > 10 and got.right > 0.93


def chat_model(spark):
    made = chat.transcripts(tables(spark, "conversations")[0])
    return chat.train(made)


def test_chat_formats_a_foreign_transcript(spark):
    model = chat_model(spark)
    text = "System: Be kind.\n\nUser: How are you?\nAnd the dog?\n\nAssistant: Well.\n\n  * fine\n\nUser: Good\n"
    data = spark.createDataFrame([(1, text, "r"), (2, None, "r"), (3, " \n\t\n", "r"), (4, "no marker at all", "r")],
                                 "id long, text string, rendered string")
    out, names = chat.format_chats(data, model)
    got = {r.id: r for r in out.collect()}
    assert names["rendered"] != "rendered" and got[1].rendered == "r"
    assert got[1][names["rendered"]] == (
        "<|system|>\nBe kind.\n<|end|>\n<|user|>\nHow are you?\nAnd the dog?\n<|end|>\n"
        "<|assistant|>\nWell.\n\n  * fine\n<|end|>\n<|user|>\nGood\n<|end|>\n")
    assert got[2][names["rendered"]] == got[3][names["rendered"]] == ""
    assert len(got[4][names["turn_roles"]]) == 1
    assert chat.format_chats(data.limit(0), model)[0].count() == 0


def test_chat_awkward_tables(spark):
    schema = "conv_id long, turn long, role string, text string, part string"
    data = [(1, 0, "user", "hi there", "x"), (1, 0, "user", "hi there", "x"), (1, 1, "assistant", None, "x"),
            (1, None, "user", "late", "x"), (2, 0, None, "who", "x"), (None, 0, "tool", "", "x"),
            *((3, i, ("user", "assistant")[i % 2], f"line {i}\nmore", "x") for i in range(450))]
    got = chat.report(spark.createDataFrame(data, schema)).collect()
    parts = {}
    for r in got:
        parts.setdefault(r.conv_id, []).append(r)
    assert len(parts[3]) == 3  # at most 200 turns in a transcript
    # A marker may stand on a line of its own; what was said is all there, in order.
    assert 900 <= sum(r.n_lines for r in parts[3]) <= 900 + 450
    said = [x for r in sorted(parts[3], key=lambda r: r.part) for x in r.rendered.split("\n") if x.startswith("line ")]
    assert said == [f"line {i}" for i in range(450)]
    assert len(parts[1]) == 2 and len(parts[2]) == len(parts[None]) == 1
    assert chat.report(spark.createDataFrame([], schema)).count() == 0


def test_chat_deals_crowded_turns(spark):
    """A third of all rows have no turn number, another third share one."""
    data = [*((1, None, "user", f"late {i}") for i in range(900)), *((1, 7, "user", f"same {i}") for i in range(900)),
            *((1 + i // 4, i % 4, "user", f"told {i}") for i in range(900))]
    made = chat.transcripts(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    said = [x for r in made for x in r.text.split("\n") if x]
    assert sum("late" in x for x in said) == 900 and sum("same" in x for x in said) == 900 and sum("told" in x for x in said) == 900
    assert max(r.text.count("late") + r.text.count("same") for r in made) < 3 * chat.TURNS
