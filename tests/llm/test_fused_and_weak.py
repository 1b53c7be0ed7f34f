"""Language evidence and weak-label scores against direct computations, and the pipeline over no documents."""

import math
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import langid, quality, tokens


def test_fusion_equals_a_direct_computation(spark):
    dice = random.Random(5)
    names = ["aa", "bb", "cc"]
    table = np.log(np.random.default_rng(2).dirichlet(np.ones(3), 1 << langid.BITS)).astype(np.float32)
    model = langid.TextModel(names, np.array([0.5, 0.3, 0.2]), table)
    rows = [(i, dice.choice(["", None, "some text", "other words here", "x y z " * 9]), dice.choice([*names, None, "zz"]),
             dice.choice(["com", "fr", None]), dice.choice(["h1", "h2", None])) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string").repartition(3)
    found = {row.id: row for row in langid.identify(frame, model).collect()}

    def normal(values):
        return [x / sum(values) for x in values]

    logs, own = {}, {}
    for key, text, *_ in rows:
        grams, _ = langid.grams(pa.array([text], pa.string()))
        total = [sum(float(table[g, i]) for g in grams.tolist()) * langid.EVIDENCE / (len(grams) + langid.EVIDENCE) for i in range(3)]
        logs[key] = [x - max(total) for x in total]
        own[key] = normal([math.exp(x) * float(p) for x, p in zip(logs[key], model.prior)])

    def sums(keys):
        return [sum(own[key][i] for key in keys) for i in range(3)]

    def drawn(totals, towards):
        return [(x + langid.STRENGTH * y) / (sum(totals) + langid.STRENGTH) for x, y in zip(totals, towards)]

    share = normal([x + float(p) for x, p in zip(sums(own), model.prior)])
    said = [[0.5 + langid.STRENGTH * (i == j) for j in range(3)] for i in range(3)]
    for i, name in enumerate(names):
        said[i] = [a + b for a, b in zip(said[i], sums([r[0] for r in rows if r[2] == name]))]
    columns = [sum(line[j] for line in said) for j in range(3)]
    for key, _, declared, suffix, host in rows:
        prior = share
        if host is not None:
            of_suffix = drawn(sums([r[0] for r in rows if r[3] == suffix]), share) if suffix else share
            others = [max(a - b, 0.0) for a, b in zip(sums([r[0] for r in rows if r[3:] == (suffix, host)]), own[key])]
            prior = drawn(others, of_suffix)
        fused = [a + math.log(p) for a, p in zip(logs[key], prior)]
        if declared in names:
            fused = [a + math.log(said[names.index(declared)][j] / columns[j]) for j, a in enumerate(fused)]
        want = normal([math.exp(x - max(fused)) for x in fused])
        assert found[key].lang == names[want.index(max(want))]
        assert found[key].probability == pytest.approx(max(want), abs=1e-6)


def features_of(text):
    """Place -> value, word by word."""
    words, out = (text or "").encode().split(), {}
    hashes = tokens.words(pa.array([text])).hashes
    for at, (word, hashed) in enumerate(zip(words, hashes, strict=True)):
        same = at > 0 and word.lower() == words[at - 1].lower()
        shape = ((int(quality._KIND[word[0]]) * 6 + int(quality._KIND[word[-1]])) * 8 + min(len(word) // 2, 7)) * 2 + same
        ending = int.from_bytes(word[-3:][::-1].ljust(3, b"\0"), "big")
        keys = tokens.mix(np.array([shape + (1 << 40), ending + (1 << 41)], np.uint64))
        for key in (*keys.tolist(), int(hashed)):
            place = key >> (64 - quality.BITS)
            out[place] = out.get(place, 0) + 1
    return {place: math.sqrt(n / max(len(words), quality.FEW)) for place, n in out.items()}


def test_weak_label_scorer_equals_gradient_steps_word_by_word(spark):
    texts = ["The cat sat on the mat. " * 4, "!!! $$$ 12 " * 9, "a A a a", "", None, "word " * 30, "Many different words make one good sentence here."]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    cast = quality.votes(batch.column("text"), tokens.words(batch.column("text")))
    patterns = quality.pattern_of(cast).tolist()
    known = {pattern: 0.1 + 0.8 * n / len(patterns) for n, pattern in enumerate(dict.fromkeys(patterns))}
    weights, squares = {}, {}

    def margin(found):
        return sum(weights.get(place, 0.0) * value for place, value in found.items())

    every = [{**features_of(text), quality.INTERCEPT: 1.0} for text in texts]
    for _ in range(quality.STEPS):
        step = {}
        for found, pattern in zip(every, patterns, strict=True):
            error = (1 / (1 + math.exp(-margin(found))) - known[pattern]) / len(texts)
            for place, value in found.items():
                step[place] = step.get(place, 0.0) + error * value
        for place, value in step.items():
            squares[place] = squares.get(place, 1e-3) + value * value
            weights[place] = weights.get(place, 0.0) - quality.RATE * value / math.sqrt(squares[place])

    class Sent:
        value = (np.zeros(quality.INTERCEPT + 1), known)

    out = next(quality._trainer(Sent)(iter([batch])))
    got = dict(zip(out.column("place").to_pylist(), out.column("change").to_pylist(), strict=True))
    assert got.keys() == {place for place, value in weights.items() if value}
    assert max(abs(got[place] - weights[place]) for place in got) < 1e-9

    trained = Sent.value[0].copy()
    trained[list(got)] = list(got.values())
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, text string")
    for row in quality.score(docs, "text", trained).collect():
        assert row.quality_score == pytest.approx(1 / (1 + math.exp(-margin(every[row.id]))), abs=1e-5)


def test_pipeline_over_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test-empty")
        assert docs.count() == 0
