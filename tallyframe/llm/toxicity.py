"""Toxicity: a convolutional text classifier in numpy, with thresholds by language.

Words and their beginnings are hashed into a table of embeddings and summed. Filters of several widths slide
over them; the largest value of each filter over the whole text goes through a
logistic layer. Training is by Adam on a bounded sample of labelled rows. The
logit is then calibrated on all labelled rows of another third, which are scored
in tasks and counted by bins of the logit; each language gets the threshold from
which on its calibration rows are toxic.
"""

from __future__ import annotations

import io
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType, StructField, StructType

from .scratch import Scratch
from .words import BY_LETTER, mixed, sliced, slices

SLOTS = 1 << 18
DIMENSION = 8
#: Bytes of the word beginnings that have embeddings of their own.
STEMS = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
BATCH = 16
#: Evidence that a word has by chance.
CHANCE = 2.5
RATE = 0.003
RATE_WORDS = 0.02
#: The classifier is fitted on at most this many labelled rows. It is calibrated on all of the other third.
SAMPLE = 6000
#: Calibration ids are sent to all tasks up to this number, and joined by shuffle beyond.
BROADCAST_IDS = 4_000_000
_BINS = 1000  # of a logit
_FAR = 100  # logits beyond count as this
#: Score from which on a document is toxic, unless its language's calibration says otherwise.
THRESHOLD = 0.7
#: Clean calibration rows of a language that its threshold may reject.
FALSE_SHARE = 0.002


class Net(NamedTuple):
    """Embeddings, the filters of each width (width, dimension, filters), their biases, and the last layer."""

    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *self.filters, *self.biases, self.weights, self.bias]


def slots(texts: pa.Array) -> list[np.ndarray]:
    """Of each text's words, A-Z folded, the table slots of the word and of its beginnings (0 where there is none).

    So inflected forms share something with their stem. A text without words
    has one word without slots.
    """
    out: list[np.ndarray] = []
    for _, words in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), "text", BY_LETTER):
        rows = np.zeros((len(words.starts), 1 + len(STEMS)), dtype=np.int32)
        rows[:, 0] = words.hashes(fold=True) % np.uint64(SLOTS - 1) + np.uint64(1)
        for column, size in enumerate(STEMS, 1):
            stems = words._replace(ends=np.minimum(words.ends, words.starts + size)).hashes(fold=True)
            longer = words.ends - words.starts > size
            rows[longer, column] = mixed(stems[longer] + np.uint64(size)) % np.uint64(SLOTS - 1) + np.uint64(1)
        none = np.zeros((1, 1 + len(STEMS)), dtype=np.int32)
        out += [rows[a:b] if b > a else none for a, b in zip(words.first[:-1], words.first[1:])]
    return out


def _padded(ids: np.ndarray) -> np.ndarray:
    return np.concatenate((ids, np.zeros((max(WIDTHS) - 1, ids.shape[1]), dtype=ids.dtype)))


def _embedded(net: Net, ids: np.ndarray) -> np.ndarray:
    """The sum of the embeddings of each word's slots."""
    out = net.table[ids[:, 0]]
    for column in range(1, ids.shape[1]):
        out += net.table[ids[:, column]]
    return out


def _pooled(net: Net, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest value of each filter over a text, and where it stands."""
    n, ids = len(ids), _padded(ids)
    best = np.full(len(net.weights), -np.inf, dtype=np.float32)
    at = np.zeros(len(net.weights), dtype=np.int64)
    step = 8192
    for lo in range(0, n, step):
        words = _embedded(net, ids[lo : lo + step + max(WIDTHS) - 1])
        count, column = min(step, n - lo), 0
        for width, kernel, bias in zip(WIDTHS, net.filters, net.biases):
            value = words[:count] @ kernel[0]
            for j in range(1, width):
                value += words[j : j + count] @ kernel[j]
            value += bias
            own = slice(column, column + kernel.shape[2])
            where = value.argmax(axis=0)
            top = value[where, np.arange(kernel.shape[2])]
            better = top > best[own]
            best[own] = np.where(better, top, best[own])
            at[own] = np.where(better, where + lo, at[own])
            column = own.stop
    return best, at


def logits(net: Net, texts: list[np.ndarray]) -> np.ndarray:
    pooled = np.array([_pooled(net, ids)[0] for ids in texts], dtype=np.float32).reshape(len(texts), len(net.weights))
    return np.maximum(pooled, 0) @ net.weights + net.bias[0]


def _logits_of(net: Net, texts: pa.Array) -> np.ndarray:
    """The logit of each text, slice by slice."""
    return np.concatenate([np.empty(0), *(logits(net, slots(texts.slice(lo, hi - lo))).astype(np.float64) for lo, hi in slices(texts))])


def _evidence(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Signed root of the likelihood ratio between a slot's share of positive and of negative rows.

    A word of one row says little, one of many rows of a kind says much.
    """
    ones, zeros = (np.zeros(SLOTS) for _ in range(2))
    for ids, label in zip(texts, labels):
        (ones if label else zeros)[np.unique(ids)] += 1
    share = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-6), 1 - 1e-6)
    n = ones + zeros
    ratio = sum(np.where(x > 0, x * np.log(np.maximum(x, 1) / np.maximum(n * part, 1e-9)), 0) for x, part in ((ones, share), (zeros, 1 - share)))
    return np.where(ones > n * share, 1, -1) * np.sqrt(np.maximum(2 * ratio, 0))


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Net:
    """A net trained on the texts; positive rows weigh as much as negative ones together.

    The first coordinate of each embedding begins with what the rows say about
    the word alone, the others near 0, so that unknown words are quiet.
    """
    rng = np.random.Generator(np.random.PCG64(seed))

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    table = normal(SLOTS, DIMENSION, scale=0.02)
    evidence = _evidence(texts, labels)
    table[:, 0] = np.clip(np.sign(evidence) * np.maximum(np.abs(evidence) - CHANCE, 0), -8, 16) / 4
    table[0] = 0
    filters = [normal(w, DIMENSION, FILTERS, scale=0.1) for w in WIDTHS]
    for kernel in filters:
        kernel[0, 0] += 1
        kernel[1:, 0] += 0.3
    net = Net(table, filters, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], np.full(FILTERS * len(WIDTHS), 0.05, dtype=np.float32), np.full(1, -2, dtype=np.float32))
    share = min(max(float(labels.mean()) if len(labels) else 0.5, 0.01), 0.99)
    gain = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    dense = net.parameters()[1:]
    first, second = ([np.zeros_like(p) for p in dense] for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            rows, step = order[lo : lo + BATCH], step + 1
            grads, words = [np.zeros_like(p) for p in dense], []
            for row in rows:
                words.append(_gradients(net, texts[row], float(labels[row]), float(gain[row]) / len(rows), grads))
            for ids, grad in words:
                np.subtract.at(net.table, ids, RATE_WORDS * grad)
            net.table[0] = 0
            for p, g, m, v in zip(dense, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _gradients(net: Net, ids: np.ndarray, label: float, gain: float, grads: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Adds one text's gradients; those of embeddings, which reach only the words of each maximum, are returned."""
    pooled, at = _pooled(net, ids)
    shown = np.maximum(pooled, 0)
    logit = float(shown @ net.weights + net.bias[0])
    error = gain * (1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) - label)
    grads[-1][0] += error
    grads[-2] += error * shown
    back = error * net.weights * (pooled > 0)
    ids, column, touched, values = _padded(ids), 0, [], []
    for k, (width, kernel) in enumerate(zip(WIDTHS, net.filters)):
        own = slice(column, column + kernel.shape[2])
        column = own.stop
        grads[len(WIDTHS) + k] += back[own]
        for j in range(width):
            words = ids[at[own] + j]
            grads[k][j] += _embedded(net, words).T * back[own]
            touched.append(words.T.ravel())
            values.append(np.tile((kernel[j] * back[own]).T, (words.shape[1], 1)))
    return np.concatenate(touched), np.concatenate(values)


def _calibrate(values: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the labels over the logits, each met so many times, by Newton steps."""
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    x, w = np.column_stack((values, np.ones(len(values)))), np.array([0.5, 0.0])
    n1, n0 = (labels * counts).sum(), ((1 - labels) * counts).sum()
    goal = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (counts * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (counts * (p - goal)) + 1e-3 * (w - [0.5, 0.0]))
        w = w - np.clip(step, -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


class Model(NamedTuple):
    net: Net
    slope: float
    offset: float
    thresholds: dict[str, float]

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The score of each text."""
        return self.calibrated(_logits_of(self.net, texts))

    def calibrated(self, values: np.ndarray) -> np.ndarray:
        """The scores of logits."""
        return 1 / (1 + np.exp(-np.clip(self.slope * values + self.offset, -30, 30)))


def _binned(spark: SparkSession, docs: DataFrame, marked: DataFrame, net: Net) -> DataFrame:
    """lang, toxic, bin, n: how many rows of docs with a label of marked (doc_id, toxic) have a logit that rounds up to the bin."""
    shared = spark.sparkContext.broadcast(net)

    def binned(batches):
        for batch in batches:
            at = np.ceil(np.clip(_logits_of(shared.value, batch.column(0)), -_FAR, _FAR) * _BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(at)], ["lang", "toxic", "bin"])

    if marked.count() <= BROADCAST_IDS:
        marked = F.broadcast(marked)
    rows = docs.join(marked, "doc_id").select("text", "lang", F.col("toxic").cast("int").alias("toxic"))
    return rows.mapInArrow(binned, "lang string, toxic int, bin long").groupBy("lang", "toxic", "bin").agg(F.count("*").alias("n"))


def _limits(bins: DataFrame) -> dict[str, float]:
    """The logit of each language that FALSE_SHARE of its clean rows exceed at most, rounded up to a bin."""
    by_lang = Window.partitionBy("lang")
    clean = bins.where("toxic = 0 AND lang IS NOT NULL")
    ranked = clean.withColumn("from", F.sum("n").over(by_lang.orderBy(F.col("bin").desc()))).withColumn("all", F.sum("n").over(by_lang))
    found = ranked.where(F.col("from") > F.floor(FALSE_SHARE * F.col("all"))).groupBy("lang").agg(F.max("bin").alias("bin"))
    return {r.lang: r.bin / _BINS for r in found.orderBy("lang").collect()}


def _slotted(batches):
    """The rows with the slots of their words in place of the text."""
    for batch in batches:
        for lo, hi in slices(batch.column(2)):
            part = batch.slice(lo, hi - lo)
            ids = pa.array([x.astype(np.int32).tobytes() for x in slots(part.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, part.column(3).cast(pa.int32())], ["order", "doc_id", "ids", "toxic"])


def _fitted(batches):
    """The net of all rows, which are a bounded sample, as one value; no rows give an untrained net."""
    texts, labels = [], []
    for batch in batches:
        texts += [np.frombuffer(x, dtype=np.int32).reshape(-1, 1 + len(STEMS)) for x in batch.column(2).to_pylist()]
        labels += batch.column(3).to_pylist()
    file = io.BytesIO()
    np.savez(file, *fit(texts, np.array(labels, dtype=np.float64)).parameters())
    yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()], pa.binary())], ["net"])


def _unpacked(row) -> Net:
    with np.load(io.BytesIO(row.net)) as file:
        found = [file[name] for name in file.files]
    n = len(WIDTHS)
    return Net(found[0], found[1 : 1 + n], found[1 + n : 1 + 2 * n], *found[1 + 2 * n :])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels (doc_id, toxic) over docs (doc_id, text, lang), from rows whose crc32(doc_id) mod 3 is not 1.

    Remainder 0 is fitted on, on the sample ids of smallest hash at most, with one
    row each (that of the text with the smallest hash), in one task.
    All rows of remainder 2 are scored and give the calibration and the
    thresholds, through counts by bins of a thousandth of a logit. Without
    labelled rows every score is 0.5.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(fold != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    chosen = F.broadcast(marked.where(fold == 0).select("doc_id", "toxic", order.alias("order")).orderBy("order", "doc_id").limit(sample))
    # a row for each id, of the text with the least hash, so that the sample bounds the rows; the fit is a task of its own
    own = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("order", "doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("row"))
    sent = own.select("order", "doc_id", "row.text", "row.toxic").mapInArrow(_slotted, "order long, doc_id long, ids binary, toxic int")
    fitted = sent.orderBy("order", "doc_id").coalesce(1).mapInArrow(_fitted, "net binary").first()
    net = _unpacked(fitted) if fitted else fit([], np.empty(0))
    bins = Scratch(spark, "toxicity").keep(_binned(spark, docs.select("doc_id", "text", "lang"), marked.where(fold == 2), net))
    counted = bins.groupBy("toxic", "bin").agg(F.sum("n").alias("n")).orderBy("toxic", "bin").toArrow()
    truth, at, n = (counted[c].to_numpy().astype(np.float64) for c in ("toxic", "bin", "n"))
    model = Model(net, *_calibrate((at - 0.5) / _BINS, truth, n), {})
    for lang, limit in _limits(bins).items():
        model.thresholds[lang] = max(THRESHOLD, float(np.nextafter(model.calibrated(np.float64(limit)), 2)))
    return model


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """row (all columns of docs as a struct), doc_id, score (0 to 1), threshold (its language's), rejected.

    Only the text makes the score; null and empty texts get that of a text
    without words. Unknown and null languages have the common threshold. Every
    row is scored by itself, so repeated rows agree. No rows give no rows.
    """
    shared = spark.sparkContext.broadcast(model)
    listed = spark.createDataFrame([(k, float(v)) for k, v in model.thresholds.items()], "listed string, own double")

    def scored(batches):
        for batch in batches:
            found = pa.array(shared.value.scores(batch.column(0).field("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "score"])

    packed = docs.select(F.struct("*").alias("row"))
    whole = packed.mapInArrow(scored, StructType([packed.schema["row"], StructField("score", DoubleType())]))
    return (
        whole.join(F.broadcast(listed), F.col("row.lang") == F.col("listed"), "left")
        .select("row", F.col("row.doc_id").alias("doc_id"), "score", F.coalesce("own", F.lit(THRESHOLD)).alias("threshold"))
        .withColumn("rejected", F.col("score") >= F.col("threshold"))
    )
