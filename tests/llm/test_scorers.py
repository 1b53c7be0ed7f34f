"""Trained scorers: language model, toxicity, quality and language, by brute-force counts and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, lm, quality, tokens, toxicity

SMALL, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def split(text):
    return (text or "").encode().lower().split()


def test_words_are_those_of_the_definition():
    texts = ["", None, " A b\tC\x0b\x0cd\r\n", "x\x1cy É é z", "a", "aa", "a" * 100]
    found = tokens.words(pa.array(texts, pa.string()))
    assert [bytes(found.data[a:b]) for a, b in zip(found.begin, found.end)] == [w for t in texts for w in split(t)]
    assert found.lengths.tolist() == [len(split(t)) for t in texts]
    assert len(set(found.hashes.tolist())) == len({w for t in texts for w in split(t)})
    again = tokens.words(pa.array(["a", *texts], pa.string()).slice(1))
    assert again.hashes.tolist() == found.hashes.tolist()


def test_pieces_follow_bytes():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 40, None, "b" * 70, "c", ""], pa.string())})
    assert [x.num_rows for x in tokens.pieces(iter([batch]), limit=50)] == [3, 2]
    assert list(tokens.pieces(iter([batch.slice(0, 0)]))) == []


TEXTS = [(1, "the cat sat on the mat", False), (2, "The dog sat", False), (3, "the unseen cat", True), (4, "", True), (5, None, False),
         (5, "the cat sat on the mat", False), (None, "mat mat", True)]


@pytest.mark.parametrize("parts", [1, 3])
def test_base_scores(spark, parts):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, score boolean").repartition(parts)
    rows = lm.score(docs, "doc_id", "text", F.col("score")).collect()
    counts = Counter(w for _, t, held in TEXTS if not held for w in [*split(t), None])
    total = sum(counts.values())
    want = Counter()
    for key, text, held in TEXTS:
        own = [*split(text), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own)
        want[key, held, len(own), sum(counts[w] > 0 for w in own), total, round(base, 9)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in rows) == want
    assert all(r.score < 0 for r in rows)


def test_model_is_a_distribution_and_beats_the_base(spark, documents):
    rows = lm.score(documents, "doc_id", "text", F.col("doc_id") % 5 == 1).where("held_out").agg(
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert rows[0] > rows[1] + 0.05 * rows[2]


def model_of(spark, docs):
    """The trained parts of the model, for direct computations."""
    rows = lm.in_blocks(docs)
    counted = rows.select("text", "held_out", "block").mapInArrow(lm._count, "block long, hash long, ending int, count long")
    known = counted.groupBy("hash", "ending").agg(F.sum("count").alias("count")).where("count > 0")
    vocabulary = lm._vocabulary(known)
    weights = lm._train(rows.where("NOT held_out").select("text"), vocabulary)
    return {row.hash: (row.ending, row["count"]) for row in known.collect()}, vocabulary, weights


def probabilities(vocabulary, weights, rows):
    """Of all classes in a context, weight by weight."""
    totals = vocabulary.totals
    out = np.zeros(lm.CLASSES)

    def softmax(margins):
        shares = [math.exp(x) for x in margins]
        return [x / sum(shares) for x in shares]

    groups = softmax([math.log(totals[g * lm.SIDE:(g + 1) * lm.SIDE].sum()) + sum(float(weights[row * (lm.SIDE + 1), g]) for row in rows)
                      for g in range(lm.SIDE)])
    for g in range(lm.SIDE):
        inside = softmax([math.log(totals[g * lm.SIDE + i]) + sum(float(weights[row * (lm.SIDE + 1) + 1 + g, i]) for row in rows)
                          for i in range(lm.SIDE)])
        out[g * lm.SIDE:(g + 1) * lm.SIDE] = [groups[g] * x for x in inside]
    return out


def test_scores_equal_a_direct_computation(spark):
    """Word by word from the weights; and over all words, an unknown one of each open class included, they sum to one."""
    dice = random.Random(2)
    texts = [" ".join(dice.choice(["the", "a", "of"] + [f"w{i}ing" for i in range(30)] + [f"v{i}" for i in range(150)]) for _ in range(dice.randint(0, 40)))
             for _ in range(200)]
    docs = spark.createDataFrame([(i, text, i % 5 == 1) for i, text in enumerate(texts)], "doc_id long, text string, held_out boolean").coalesce(1)
    known, vocabulary, weights = model_of(spark, docs)
    assert np.abs(weights).max() > 0.1
    assert {row.doc_id: round(row.score, 2) for row in lm.score(docs, "doc_id", "text", F.col("held_out")).collect()} == {
        i: round(scored(known, vocabulary, weights, text), 2) for i, text in enumerate(texts)}
    hashes, endings = np.array([*known], np.int64).view(np.uint64), np.array([x for x, _ in known.values()], np.int64)
    classes, counts = vocabulary.classes(hashes, endings), np.array([x for _, x in known.values()])
    mass = np.zeros((lm.CLASSES, lm.SIDE))
    np.add.at(mass, (classes, vocabulary.drawers(hashes, classes)), counts + 0.5)
    mass[lm.ALONE + 1:] += 0.5  # an unknown word in every drawer
    for rows in np.random.default_rng(1).integers(0, lm.BUCKETS, (20, len(lm.TEMPLATES))) + np.arange(len(lm.TEMPLATES)) * lm.BUCKETS:
        of_class = probabilities(vocabulary, weights, rows)
        total = 0.0
        for one in range(lm.CLASSES):
            for drawer, of_drawer in enumerate(drawer_probabilities(vocabulary, weights, rows, one)):
                total += of_class[one] * of_drawer * (mass[one, drawer] / vocabulary.shares[one, drawer] if mass[one, drawer] else 1)
        assert abs(total - 1) < 1e-9
    assert np.abs(weights[lm.DRAWERS:]).max() > 0.1


def drawer_probabilities(vocabulary, weights, rows, one):
    """Of the drawers of a class in a context; a word alone and the end have a single one."""
    if one <= lm.ALONE:
        return [1.0]
    shares = [vocabulary.shares[one, d] * math.exp(sum(float(weights[lm.DRAWERS + row * lm.SIDE + one // lm.SIDE, d]) for row in rows[:lm.DRAWN]))
              for d in range(lm.SIDE)]
    return [x / sum(shares) for x in shares]


def scored(known, vocabulary, weights, text):
    hashes, endings, starts = lm.tokens_of(pa.array([text]))
    contexts = lm.rows_of(vocabulary.contexts(hashes, endings), starts)
    total = 0.0
    for at, (hashed, one) in enumerate(zip(hashes.tolist(), vocabulary.classes(hashes, endings).tolist(), strict=True)):
        count = known.get(int(np.uint64(hashed).view(np.int64)), (0, 0))[1]
        drawer = hashed % lm.SIDE if one > lm.ALONE else 0
        context = contexts[:, at]
        total += math.log10(probabilities(vocabulary, weights, context)[one])
        total += math.log10(drawer_probabilities(vocabulary, weights, context, one)[drawer])
        total += math.log10((count + 0.5) / vocabulary.shares[one, drawer])
    return total


def test_language_model_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.score(docs, "doc_id", "text", F.lit(True)).first()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0)
    assert lm.score(docs.where("false"), "doc_id", "text", F.lit(True)).count() == 0


def test_toxicity_on_held_out_labels(spark):
    documents, labels = (spark.read.parquet(f"{LARGER}/{name}.parquet") for name in ("documents", "labels"))  # 97 toxic ones held out
    rows = documents.select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id").withColumn("fold", F.crc32(F.col("doc_id").cast("string")) % 5)
    weights = toxicity.train(rows.where("fold <> 0"), "text", "toxic")
    scored = toxicity.score(rows.drop("score"), "doc_id", "text", weights).join(rows, "doc_id").where("fold = 0").collect()
    toxic = [r.score for r in scored if r.toxic == 1]
    clean = [r.score for r in scored if r.toxic == 0]
    better = np.mean([a > b for a in toxic for b in clean])
    assert better > 0.97
    assert np.mean([b < 0.5 for b in clean]) > 0.95


def test_toxicity_equals_ftrl_word_by_word(spark):
    """One shard, one round of dictionaries instead of arrays; and copies are one example of a greater weight."""
    dice = random.Random(4)
    rows = [(" ".join(dice.choice(["vile", "mean", "fine", "kind", "day", "tree"]) for _ in range(dice.randint(1, 6))), float(i % 2)) for i in range(40)]
    rows += [("a vile day", 1.0)] * 30
    chosen = toxicity.sampled(
        spark.createDataFrame(rows, "text string, label double").repartition(3).withColumn("key", toxicity.text_key("text")), 1 << 20).collect()
    assert {(r.text, r.label): round(r.weight, 9) for r in chosen} == {
        key: round(1 + math.log(n), 9) for key, n in Counter(rows).items()}
    assert len(chosen) == len(set(rows))
    batch = pa.RecordBatch.from_pydict({name: [r[name] for r in chosen] for name in ("text", "label", "weight")})
    z, n = {}, {}
    keep = toxicity.INTERCEPT

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        rate = (toxicity.BETA + math.sqrt(ni)) / toxicity.ALPHA
        if i == keep:
            return -zi / rate
        return 0.0 if abs(zi) <= toxicity.L1 else -(zi - math.copysign(toxicity.L1, zi)) / (rate + toxicity.L2)

    for r in chosen * toxicity.PASSES:
        found = tokens.words(pa.array([r.text]), tokens.PUNCTUATION)
        at = {*toxicity.features.hashed(found, toxicity.TEMPLATES, toxicity.BITS, toxicity.BEGINNINGS)[0].tolist(), keep}
        error = r.weight * (1 / (1 + math.exp(-sum(weight(i) for i in at))) - r.label)
        for i, own in {i: weight(i) for i in at}.items():
            z[i] = z.get(i, 0.0) + error - (math.sqrt(n.get(i, 0.0) + error * error) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA * own
            n[i] = n.get(i, 0.0) + error * error

    class Sent:
        value = np.zeros((2, keep + 1))

    out = next(toxicity._trainer(Sent)(iter([batch])))
    got = dict(zip(out.column("place").to_pylist(), out.column("z").to_pylist(), strict=True))
    assert got.keys() == {i for i in n if n[i]} and max(abs(got[i] - z[i]) for i in got) < 1e-4


def test_toxicity_of_odd_rows(spark):
    rows = [(1, "vile words", 1), (2, None, 0), (3, "", 0), (4, "fine words", None), (1, "vile words", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    found = toxicity.score(docs, "doc_id", "text", toxicity.train(docs, "text", "toxic")).collect()
    assert len(found) == 5 and all(0 <= row.score <= 1 for row in found)
    untrained = toxicity.train(docs.where("false"), "text", "toxic")
    assert [row.score for row in toxicity.score(docs, "doc_id", "text", untrained).collect()] == [0.5] * 5


def test_quality_against_labels(spark, documents, labels):
    scored = quality.score(documents.withColumn("quality_score", F.lit("x")), "text", quality.train(documents, "text"))
    rows = scored.join(labels, "doc_id").select("quality", "quality_score").collect()
    assert np.mean([(row.quality_score >= 0.5) == (row.quality == 1) for row in rows]) > 0.97
    assert np.mean([row.quality_score >= 0.5 for row in rows if row.quality == 1]) > 0.98


def test_estimated_accuracies():
    """Votes drawn with known accuracies from known classes."""
    random = np.random.default_rng(7)
    accuracy = np.linspace(0.65, 0.95, len(quality.LABELLERS))
    good = random.random(20000) < 0.7
    right = random.random((20000, len(accuracy))) < accuracy
    cast = np.where(right == good[:, None], quality.GOOD, quality.BAD)
    cast = np.where(random.random(cast.shape) < 0.2, quality.NONE, cast)
    patterns, counts = np.unique(quality.pattern_of(cast), return_counts=True)
    posterior, found = quality.estimate(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.03
    chosen = dict(zip(patterns, posterior))
    assert np.mean([(chosen[p] > 0.5) == g for p, g in zip(quality.pattern_of(cast), good)]) > 0.95


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "!!! ### $$$ " * 40), (3, "!!! ### $$$ " * 40)], "doc_id int, text string")
    found = quality.score(docs, "text", quality.train(docs, "text")).collect()
    assert len(found) == 4 and found[2].quality_score == found[3].quality_score
    assert not quality.train(docs.where("false"), "text").any()


def test_languages_of_documents_and_pages(spark, documents):
    model = langid.train(documents, "text", "lang")
    none = F.lit(None).cast("string")
    rows = langid.evidence(documents, F.col("doc_id"), F.col("text"), none, none, F.col("source"))
    found = langid.identify(rows, model).join(documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("true")), "id").collect()
    assert np.mean([row.lang == row.true for row in found]) > 0.98
    pages = [(1, "http://a.example.fr/x", "<html lang='fr'><script>the the of and</script><p></p></html>", "x"), (2, None, None, "x"),
             (3, "no url", "<HTML LANG=xx>the thing and that", "x"), (2, None, None, "x")]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string, lang string")
    shown = langid.pages_evidence(frame, "page_id", "url", "html", model.languages)
    assert [tuple(r) for r in shown.where("id = 1").select("declared", "suffix", "host").collect()] == [("fr", "fr", "a.example.fr")]
    rows = {r.id: r for r in langid.identify(shown, model).collect()}
    assert rows[1].lang == "fr" and rows[3].lang == "en" and rows[2].declared is None
    assert langid.identify(shown.where("false"), model).count() == 0
    nothing = langid.train(documents.where("false"), "text", "lang")
    assert [r.lang for r in langid.identify(shown, nothing).collect()] == [None] * 4


def test_hosts_and_declarations_decide_without_text(spark):
    languages, size = ["en", "fr"], 1 << langid.BITS
    model = langid.TextModel(languages, np.array([0.5, 0.5]), np.zeros((size, 2), np.float32))
    model.table[langid.grams(pa.array(["le chat"]))[0], 1] = 5
    model.table[langid.grams(pa.array(["the cat"]))[0], 0] = 5
    rows = [(i, "le chat", "fr", "fr", "h1") for i in range(8)] + [(i, "the cat", "en", "com", "h2") for i in range(10, 18)]
    rows += [(20, "", None, "fr", "h1"), (21, "", "fr", None, None), (22, "", None, "fr", "new"), (23, "", None, None, None)]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string")
    found = {r.id: r for r in langid.identify(frame, model).collect()}
    assert [found[i].lang for i in (20, 21, 22)] == ["fr"] * 3
    assert found[20].probability > found[22].probability > 0.6 and abs(found[23].probability - 0.5) < 0.05
