import math
import random
import zlib

import numpy as np
import pytest

from wardlake.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    plain = ["the", "of", "and", "garden", "river", "stone", "window", "letter", "music", "winter"]
    rude = ["grumbol", "grumbast", "snarkle", "snarklot"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude) + rng.choice(["", ".", ","]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    documents, labels = labelled
    found = toxicity.score(documents, labels).collect()
    assert len(found) == 600
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) / len(held) > 0.97


def test_held_out_labels_and_other_columns_do_not_matter(spark, labelled):
    documents, labels = labelled
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(toxicity.in_training(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    more = documents.withColumn("score", F.lit(9.0)).withColumn("label", F.lit("x")).withColumn("features", F.lit(1))
    one = {r.doc_id: r.score for r in toxicity.score(documents, labels).collect()}
    assert {r.doc_id: r.score for r in toxicity.score(more, flipped).collect()} == one


def test_a_hot_repeated_id_leaves_the_model_trained(spark, labelled, monkeypatch):
    from pyspark.sql import functions as F

    documents, labels = labelled
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 500)
    hot = labels.filter("doc_id = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50_000)))).drop("copy")
    found = toxicity.score(documents.union(documents.filter("doc_id = 1")), labels.union(hot)).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) / len(held) > 0.97


def test_odd_rows(odd, labelled, spark, nothing):
    documents, rows = odd
    found = toxicity.score(documents, labelled[1]).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.held_out for r in found if r.doc_id is None} == {True}
    assert toxicity.score(nothing, labelled[1]).count() == 0
    unknown = labelled[1].withColumn("toxic", labelled[1].toxic * 0)
    assert {r.predicted for r in toxicity.score(documents, unknown).collect()} == {0}
    model = toxicity.fit(*labelled)
    assert toxicity.with_score(documents, model, "score_").columns == [*documents.columns, "score_"]


def plain_slots(text):
    """The slots of a text, gram by gram."""
    data = b" " + bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in text.lower().encode()) + b"\n"
    slots = set()
    for size in toxicity.GRAMS:
        for i in range(len(data) - size + 1):
            slots.add((int.from_bytes(data[i : i + size], "little") * (0x9E3779B97F4A7C15 + 2 * size) % 2**64) >> 44)
    return slots


def test_scores_against_plain_recomputation(labelled):
    documents, labels = labelled
    texts = {r.doc_id: plain_slots(r.text) for r in documents.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    n = [sum(v == k for v in known.values()) for k in (0, 1)]
    counts = {}
    for i, label in known.items():
        for slot in texts[i]:
            counts.setdefault(slot, [0, 0])[label] += 1
    ratio = {s: math.log((t + 1) / (n[1] + 2)) - math.log((c + 1) / (n[0] + 2)) for s, (c, t) in counts.items()}
    kept = sorted(ratio, key=lambda s: (-abs(ratio[s]) / math.sqrt(1 / (counts[s][1] + 1) + 1 / (counts[s][0] + 1)), s))[: toxicity.KEPT_SLOTS]

    def rows(ids):
        return np.array([[ratio[s] * (s in texts[i]) for s in kept] + [1.0] for i in ids])

    x, y = rows(known), np.array(list(known.values()))
    penalty, w = np.append(np.full(len(kept), toxicity.PENALTY), 0.0), np.zeros(len(kept) + 1)
    for _ in range(12):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (p - y) + penalty * w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), slope)
    expected = dict(zip(texts, 1 / (1 + np.exp(-(rows(texts) @ w)))))
    found = {r.doc_id: r.score for r in toxicity.score(documents, labels).collect()}
    assert found.keys() == expected.keys()
    assert max(abs(found[i] - expected[i]) for i in found) < 0.02
