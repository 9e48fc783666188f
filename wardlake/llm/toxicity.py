"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Grams of 3 to 6 bytes of the lower-cased text are hashed into slots; a document has a slot or not.
From labelled documents each slot gets the smoothed log ratio of its share among toxic and other
documents. The slots whose ratio is furthest from chance stay, and a regularised logistic
regression over their ratios is fitted.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.llm.common import Scratch, chunks, extend, hashed_sample, joined

SLOTS = 1 << 20
GRAMS = (3, 4, 5, 6)
#: Bounds of what the classifier is fitted on: labelled rows, slots kept, tasks that count.
TRAINING_ROWS, KEPT_SLOTS, COUNTING_TASKS = 20_000, 4_096, 8
PENALTY = 1.0
#: Bytes of text whose grams are held at once: 4 grams a byte, in several arrays of 8 bytes each.
GRAM_BYTES = 1 << 18
#: Documents whose features the driver turns into wide numbers at once.
DOCUMENTS_TOGETHER = 1_000
#: Slots a task hands on in one batch.
SLOTS_TOGETHER = 1 << 16


@dataclass
class Model:
    """``index`` maps a slot to its feature or -1; ``weights`` holds ratio times coefficient."""

    index: np.ndarray
    weights: np.ndarray
    bias: float


_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)


def _slots(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each gram size: the document of every byte, the slot from every byte, and the size.

    Texts begin with a blank and white space counts as blanks, so grams see where words begin.
    """
    data, at = joined([b" " + t.decode().lower().encode().translate(_BLANKS) for t in texts])
    wide = data.astype(np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))
    packed = wide.copy()
    for size in range(2, max(GRAMS) + 1):
        packed = packed[: max(0, len(data) - size + 1)] | wide[size - 1 :] << np.uint64(8 * (size - 1))
        if size in GRAMS:
            yield doc, (packed * np.uint64(0x9E3779B97F4A7C15 + 2 * size)) >> np.uint64(44), size


def _pairs(texts: list[bytes], index: np.ndarray | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs by document; without an index every slot is a feature."""
    found = [np.zeros(0, np.int64)]
    for doc, slots, size in _slots(texts):
        feature = slots.astype(np.int64) if index is None else index[slots]
        place = np.flatnonzero(feature >= 0)
        place = place[doc[place] == doc[place + size - 1]]
        found.append(doc[place].astype(np.int64) * n + feature[place])
    pairs = np.unique(np.concatenate(found))
    return pairs // n, pairs % n


def in_training(doc_id: Column) -> Column:
    """Rows labels are learned from: crc32 of the id as text is no multiple of 5."""
    return remainder(doc_id) != 0


def remainder(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 5


def training_sample(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids, those with the smallest hashes, with their texts.

    Only these ids and labels are broadcast; a document labelled twice counts as toxic if either
    says so, a null label counts as none.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.dropna().filter(in_training(F.col("doc_id")))
    chosen = known.join(F.broadcast(hashed_sample(known.select("doc_id"), "doc_id", rows)), "doc_id")
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # of rows that share an id one is enough
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    return found.select("label", "text")


def _counts(sample: DataFrame) -> DataFrame:
    """``slot, clean, toxic``: documents of each class that have the slot; slot -1 counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(2, np.int64), np.zeros((2, SLOTS), np.int32)
        for batch, texts in chunks(batches, size=GRAM_BYTES):
            labels = (batch.column("label").to_numpy() > 0).astype(np.int64)
            totals += np.bincount(labels, minlength=2)
            doc, slot = _pairs(texts, None, SLOTS)
            for label in (0, 1):
                counts[label] += np.bincount(slot[labels[doc] == label], minlength=SLOTS).astype(np.int32)
        slots = np.flatnonzero(counts.any(axis=0))
        columns = [np.append(slots, -1), *(np.append(counts[k, slots], totals[k]) for k in (0, 1))]
        whole = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "clean", "toxic"])
        for at in range(0, whole.num_rows, SLOTS_TOGETHER):
            yield whole.slice(at, SLOTS_TOGETHER)

    counted = sample.repartition(COUNTING_TASKS).mapInArrow(run, "slot long, clean long, toxic long")
    return counted.groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _telling(counted: DataFrame, n_clean: int, n_toxic: int) -> DataFrame:
    """``slot, ratio`` of the slots whose log-count ratio is furthest from chance; ties by slot."""
    clean, toxic = F.col("clean"), F.col("toxic")
    ratio = F.log((toxic + 1) / (n_toxic + 2)) - F.log((clean + 1) / (n_clean + 2))
    found = counted.filter("slot >= 0").select("slot", ratio.alias("ratio"), F.sqrt(1 / (toxic + 1) + 1 / (clean + 1)).alias("noise"))
    return found.orderBy((F.abs("ratio") / F.col("noise")).desc(), "slot").limit(KEPT_SLOTS).select("slot", "ratio")


@dataclass
class Part:
    """Some documents of the sample: features of each one after another, how many each has, labels."""

    features: np.ndarray
    sizes: np.ndarray
    labels: np.ndarray


def _descend(parts: list[Part], scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and bias of the penalised logistic regression, by L-BFGS with step halving."""
    k = len(scale)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, value, slope, error_sum = scale * x[:-1], PENALTY / 2 * x[:-1] @ x[:-1], np.zeros(k), 0.0
        for part in parts:
            own = np.repeat(np.arange(len(part.sizes)), part.sizes)
            z = x[-1] + np.bincount(own, weights[part.features], len(part.sizes))
            error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - part.labels
            value += np.logaddexp(0, z).sum() - z @ part.labels
            slope += np.bincount(part.features, error[own], k)
            error_sum += error.sum()
        return value, np.append(scale * slope + PENALTY * x[:-1], error_sum)

    x, steps = np.zeros(k + 1), []
    value, gradient = loss(x)
    for _ in range(60):
        direction, held = -gradient, []
        for s, y in reversed(steps):
            a = s @ direction / (s @ y)
            direction = direction - a * y
            held.append(a)
        if steps:
            s, y = steps[-1]
            direction = direction * (s @ y) / (y @ y)
        else:
            direction = direction / max(1.0, np.linalg.norm(direction))
        for (s, y), a in zip(steps, reversed(held)):
            direction = direction + (a - y @ direction / (s @ y)) * s
        step = 1.0
        while True:
            after, slope = loss(x + step * direction)
            if after <= value + 1e-4 * step * (gradient @ direction) or step < 1e-8:
                break
            step /= 2
        s, y = step * direction, slope - gradient
        done = value - after < 1e-5 * max(1.0, value)
        x, value, gradient = x + s, after, slope
        if s @ y > 1e-10:
            steps = [*steps[-9:], (s, y)]
        if done:
            break
    return x[:-1], float(x[-1])


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows.

    Slots are counted, compared and chosen in Spark. The driver gets the chosen ones, at most
    ``KEPT_SLOTS``, and which of them each document of the sample has. Without a labelled row of
    both classes the score is the smoothed share of toxic rows.
    """
    scratch = Scratch(documents.sparkSession, "labelled")
    sample = scratch.keep(training_sample(documents, labels, rows), "sample")
    counted = scratch.keep(_counts(sample), "slots")
    totals = counted.filter("slot = -1").head()
    n_clean, n_toxic = (totals.clean, totals.toxic) if totals else (0, 0)
    if not n_clean or not n_toxic:
        share = np.log((n_toxic + 1) / (n_clean + 1))
        return Model(np.full(SLOTS, -1, np.int16), np.zeros(KEPT_SLOTS), float(share))
    kept = _telling(counted, n_clean, n_toxic).collect()
    index = np.full(SLOTS, -1, np.int16)
    index[[r.slot for r in kept]] = np.arange(len(kept))
    ratio = np.array([r.ratio for r in kept])
    weights, bias = _descend(_sample_features(sample, index), ratio)
    return Model(index, ratio * weights, bias)


def _sample_features(sample: DataFrame, index: np.ndarray) -> list[Part]:
    """The features of the sample, ``DOCUMENTS_TOGETHER`` documents in a part, as Arrow delivers them."""
    shared = sample.sparkSession.sparkContext.broadcast(index)

    def compute(texts: list[bytes]) -> list[pa.Array]:
        doc, feature = _pairs(texts, shared.value, KEPT_SLOTS)
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        return [pa.array([feature[a:b].astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())]

    found = extend(sample, [T.StructField("features", T.BinaryType())], compute, size=GRAM_BYTES).select("label", "features")
    parts = []
    for batch in found.toArrow().to_batches(max_chunksize=DOCUMENTS_TOGETHER):
        ends = np.frombuffer(batch.column("features").buffers()[1], np.int32)[batch.column("features").offset :][: len(batch) + 1]
        features = np.frombuffer(batch.column("features").buffers()[2] or b"", np.uint16)[ends[0] // 2 : ends[-1] // 2]
        parts.append(Part(features, np.diff(ends) // 2, (batch.column("label").to_numpy() > 0).astype(np.float64)))
    return parts


def with_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns and the toxicity score (0 to 1) of every whole text under a free ``name``.

    A null text counts as empty, whose score follows from the bias alone.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[bytes]) -> list[pa.Array]:
        model = shared.value
        doc, feature = _pairs(texts, model.index, KEPT_SLOTS)
        z = model.bias + np.bincount(doc, model.weights[feature], len(texts))
        return [pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())]

    return extend(documents, [T.StructField(name, T.DoubleType())], compute, size=GRAM_BYTES)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, learned from rows that are not held out.

    Repeated rows are scored each, a null ``doc_id`` is held out, an empty table gives no row, and
    no column but the text enters the score.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_score(texts, fit(documents, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
