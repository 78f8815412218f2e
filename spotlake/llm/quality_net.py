"""Text quality from random-indexing word vectors and a small calibrated network.

Every word has two units: the word itself and its shape (letter case, digits, punctuation,
length, whether it repeats the word before), each hashed to one of SLOTS slots. A slot has a
fixed sparse random index vector; its learned vector is the sum of the index vectors of the
units around it over the training texts, plus its own. A document is the mean of its words'
vectors beside the mean of its shapes' vectors. A network with one hidden layer is trained
on these with Adam, and its logit is divided by a temperature fitted on the part of the
training rows that was set aside.

Training uses at most ``max_train`` labelled rows, chosen by the hash of their id, with their
whole texts, in one task; the model is a few megabytes whatever the input. Scoring reads
every whole text.

Nulls: a null text is empty, a null label is no label, a row with a null id is scored only.
An empty text has the zero vector and its score like any other. Several labels of one id
count once, as the largest. Without training rows the score is 0.5, with rows of
one label it is the share of label 1. Repeated rows are scored one by one. Empty tables give
an empty result. No column but the text enters a score.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship

ship(__name__)

SLOTS = 1 << 15
SIZE = 48
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 60
MAX_TRAIN = 6000
ACCEPT = 0.7
#: Bytes of text whose words are handled at once: some 100 bytes of memory each.
PIECE = 1 << 18

CLASSES = np.zeros(256, dtype=np.uint8)  # 0 lower case and other letters, 1 upper, 2 digit, 3 mark
CLASSES[65:91] = 1
CLASSES[48:58] = 2
CLASSES[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
LAST = np.zeros(256, dtype=np.uint64)
LAST[[ord(c) for c in ".,!?:;"]] = [1, 2, 3, 4, 5, 6]
LAST[[ord(c) for c in "$%&*#|+=<>@^~_/\\"]] = 7


def units(piece: flat.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slot and shape slot of every word of a piece, and the first word of each text."""
    words = flat.words(piece)
    kinds = CLASSES[piece.data]
    inside = []
    for kind in (1, 2, 3):
        count = np.concatenate((np.zeros(1, np.int32), np.cumsum(kinds == kind, dtype=np.int32)))
        inside.append(count[words.end] - count[words.start])
    upper, digits, marks = inside
    length = words.end - words.start
    first_upper = kinds[words.start] == 1
    case = np.where(upper == 0, 0, np.where(upper + marks + digits >= length, 3, np.where((upper == 1) & first_upper, 1, 2)))
    same = np.zeros(len(length), dtype=np.uint64)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    same[words.at[:-1][words.at[:-1] < len(same)]] = 0
    shape = np.zeros(len(length), dtype=np.uint64)
    last = LAST[piece.data[words.end - 1]]
    for part, base in ((case, 4), (np.minimum(digits, 2), 3), (np.minimum(marks, 3), 4), (last, 8),
                       (np.searchsorted([2, 5, 9, 15, 30], length), 6), (same, 2)):
        shape = shape * np.uint64(base) + part.astype(np.uint64)
    slot = (words.hashes % np.uint64(SLOTS // 2)).astype(np.int64)
    return slot, (flat.mix(shape + flat.ODD) % np.uint64(SLOTS // 2)).astype(np.int64) + SLOTS // 2, words.at


def index_vectors() -> np.ndarray:
    """The sparse random vectors of all slots."""
    draw = np.random.default_rng(11)
    out = np.zeros((SLOTS, SIZE), dtype=np.float32)
    places = np.argsort(draw.random((SLOTS, SIZE)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, draw.choice([-1.0, 1.0], size=places.shape).astype(np.float32), axis=1)
    return out


def around(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every word the sum of the rows within REACH words before and after it, in its text."""
    total = np.zeros((len(values) + 1, values.shape[1]), dtype=np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    number = np.arange(len(values))
    text = np.searchsorted(at, number, "right") - 1
    low, high = np.maximum(number - REACH, at[text]), np.minimum(number + REACH + 1, at[text + 1])
    return (total[high] - total[low] - values).astype(np.float32)


def pooled(vectors: np.ndarray, piece: flat.Piece) -> np.ndarray:
    """The mean word vector and the mean shape vector of every text."""
    words, shapes, at = units(piece)
    out = np.zeros((piece.rows, 2 * SIZE), dtype=np.float32)
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        for part, slots in enumerate((words, shapes)):
            sums = np.add.reduceat(vectors[slots], at[:-1][full], axis=0)
            out[full, part * SIZE:(part + 1) * SIZE] = sums / (at[1:] - at[:-1])[full, None]
    return out


def word_vectors(texts: pa.Array) -> np.ndarray:
    index = index_vectors()
    learned = np.zeros_like(index)
    for piece in flat.pieces(texts, PIECE):
        words, shapes, at = units(piece)
        if not len(words):
            continue
        near = around(index[words] + index[shapes], at)
        for slots in (words, shapes):
            order = np.argsort(slots, kind="stable")
            edges = np.flatnonzero(np.diff(slots[order], prepend=-1))
            learned[slots[order][edges]] += np.add.reduceat(near[order], edges, axis=0)
    length = np.linalg.norm(learned, axis=1, keepdims=True)
    vectors = index + learned / np.maximum(length, 1.0) * np.sqrt(NONZERO)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)


class Network:
    """tanh layer and logit, trained on standardised inputs."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    def logits(self, rows: np.ndarray) -> np.ndarray:
        a = self.arrays
        hidden = np.tanh(((rows - a["mean"]) / a["scale"]) @ a["w1"] + a["b1"])
        return hidden @ a["w2"] + a["b2"]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.arrays["temperature"], -30, 30)))

    @classmethod
    def train(cls, rows: np.ndarray, labels: np.ndarray) -> Network:
        draw = np.random.default_rng(5)
        order = draw.permutation(len(rows))
        aside, used = order[:max(1, len(rows) // 5)], order[max(1, len(rows) // 5):]
        if len(set(labels[used])) < 2:
            used = order
        width = rows.shape[1]
        a = {"mean": rows.mean(axis=0), "scale": rows.std(axis=0) + 1e-3, "temperature": np.ones(1),
             "w1": draw.normal(0, width**-0.5, (width, HIDDEN)), "b1": np.zeros(HIDDEN),
             "w2": draw.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(1)}
        names = ("w1", "b1", "w2", "b2")
        speed, force = ({n: np.zeros_like(a[n]) for n in names} for _ in range(2))
        x, y = ((rows[used] - a["mean"]) / a["scale"]).astype(np.float64), labels[used].astype(np.float64)
        batch, step = 64, 0
        for _ in range(max(EPOCHS, 3000 * batch // max(len(x), 1) // 4)):
            shuffled = draw.permutation(len(x))
            for start in range(0, len(x), batch):
                part = shuffled[start:start + batch]
                hidden = np.tanh(x[part] @ a["w1"] + a["b1"])
                error = (1 / (1 + np.exp(-np.clip(hidden @ a["w2"] + a["b2"], -30, 30))) - y[part]) / len(part)
                back = np.outer(error, a["w2"]) * (1 - hidden**2)
                slopes = {"w2": hidden.T @ error + 1e-4 * a["w2"], "b2": error.sum(keepdims=True),
                          "w1": x[part].T @ back + 1e-4 * a["w1"], "b1": back.sum(axis=0)}
                step += 1
                for n in names:
                    speed[n] = 0.9 * speed[n] + 0.1 * slopes[n]
                    force[n] = 0.999 * force[n] + 0.001 * slopes[n]**2
                    a[n] -= 0.003 * (speed[n] / (1 - 0.9**step)) / (np.sqrt(force[n] / (1 - 0.999**step)) + 1e-8)
        network = cls(a)
        a["temperature"] = best_temperature(network.logits(rows[aside]), labels[aside])
        return network


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The temperature with the least log loss on rows that were set aside."""
    choices = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    sign = np.where(labels > 0, 1.0, -1.0)
    losses = [np.logaddexp(0, -sign * logits / t).mean() for t in choices]
    return np.array([choices[int(np.argmin(losses))]])


def stored(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows text, label of the sample, all in one task: the model as one row."""
    held = list(batches)
    table = pa.Table.from_batches(held) if held else None
    labels = np.array(table.column(1).to_pylist(), dtype=np.float64) if held else np.zeros(0)
    if len(set(labels.tolist())) < 2:
        model = stored(constant=np.array([labels.mean() if len(labels) else 0.5]))
    else:
        texts = table.column(0).combine_chunks()
        vectors = word_vectors(texts).astype(np.float16)
        rows = np.concatenate([pooled(vectors.astype(np.float32), piece) for piece in flat.pieces(texts, PIECE)])
        model = stored(vectors=vectors, **Network.train(rows.astype(np.float64), labels).arrays)
    yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])


class Scorer:
    """The scores of text columns under a stored model."""

    def __init__(self, model: bytes):
        self.arrays = dict(np.load(io.BytesIO(model)))
        self.vectors = self.arrays.pop("vectors").astype(np.float32) if "vectors" in self.arrays else None

    def scores(self, piece: flat.Piece) -> np.ndarray:
        if self.vectors is None:
            return np.repeat(self.arrays["constant"], piece.rows)
        return Network(self.arrays).scores(pooled(self.vectors, piece).astype(np.float64))


def scoring(model):
    """A function that scores batches of id, text with the broadcast model."""
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            for piece in flat.pieces(batch.column(1), PIECE):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(piece.first, piece.rows), pa.array(scorer.scores(piece), pa.float64()),
                ], names=["id", "score"])
    return score_batches


def accepting(model, text: int, accept: float):
    """A function that keeps the rows whose text, column number ``text``, is accepted."""
    def accept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            scores = [scorer.scores(piece) for piece in flat.pieces(batch.column(text), PIECE)]
            yield batch.filter(pa.array(np.concatenate(scores) >= accept if scores else [], pa.bool_()))
    return accept_batches


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def trained(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, max_train: int) -> bytes:
    """The model, trained on at most ``max_train`` labelled rows that are not held out."""
    marked = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(
        F.max("label").cast("double").alias("label"))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    chosen = cut(marked.join(texts.select("id").distinct(), "id").orderBy(
        F.xxhash64("id"), "id").limit(max_train), "training-rows")
    sample = chosen.join(texts, "id").dropDuplicates(["id"]).repartition(1).sortWithinPartitions("id").select("text", "label")
    rows = sample.mapInArrow(train_batches, "model binary").collect()
    return bytes(rows[0][0]) if rows else stored(constant=np.array([0.5]))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", max_train: int = MAX_TRAIN, accept: float = ACCEPT,
) -> DataFrame:
    """id, held_out, score and predicted of every row."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trained(docs, labels, id_column, text_column, label_column, max_train))
    kind = docs.schema[id_column].dataType.simpleString()
    scored = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).mapInArrow(
        scoring(model), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", max_train: int = MAX_TRAIN, accept: float = ACCEPT,
) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(
        trained(docs, labels, id_column, text_column, label_column, max_train))
    return docs.mapInArrow(accepting(model, docs.columns.index(text_column), accept), docs.schema)
