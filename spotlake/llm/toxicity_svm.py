"""Toxicity of texts from a support vector machine on a subsequence string kernel.

Units are the letter sequences of words: A-Z in lower case, digits as the letters they look
like, other marks left out, a mark at either end; words of one letter that follow each other are one unit, and units
of more than WINDOW letters enter as overlapping windows. The kernel of two units counts the
triples of letters they have in common, in order but with gaps, each weighted by DECAY to the
power of the width it spans (at most SPREAD letters), and is scaled to 1 for equal units. So a
word keeps most of its likeness to itself when a character is inserted into it.

The kernel is approximated by landmarks (Nyström): half of them suspect units, which are more
frequent in toxic texts than expected, the others clean units, drawn at first and then the hardest. A unit's features are its kernel values with
the landmarks, whitened by the inverse root of the landmarks' own kernel matrix. A linear machine
with squared hinge loss is trained on labelled sentences: sentences of a toxic
document that hold a suspect unit are toxic through their worst one, which is chosen anew in every
round; other units of clean documents are clean. Worst units with a character inserted are further
examples. As the kernel is a product of explicit triples, the machine folds
into one weight per triple, and scoring a unit is a sum over its triples.

A text's score is a logistic function of its worst unit and its number of toxic sentences, fitted
on labelled rows set aside.
Training uses at most ``max_train`` labelled rows, chosen by the hash of their id, with their
whole texts, in one task; the model is one table of 32,768 weights whatever the input. Scoring
reads every whole text.

Nulls: a null text is empty, a null label is no label, a row with a null id is scored only. A
text without units has the score of the machine's offset. Several labels of one id count once,
as the largest. Without training rows the score is 0, with rows of one label it is the share of
label 1. Repeated rows are scored one by one. Empty tables give an empty result. No column but
the text enters a score.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship
from spotlake.llm.quality_net import held_out, stored

ship(__name__)

DECAY = 0.5
SPREAD = 6
WINDOW = 24
LANDMARKS = 256
ROUNDS = 2
POOL = 20_000  # clean units that a machine is trained against, drawn and hardest ones
COST = 10.0
INSERTED = 3
SHARE = 0.3
SUSPECT = 2.8  # standard deviations by which a unit's toxic texts exceed the expected number
MAX_TRAIN = 6000
ACCEPT = 0.3
CHUNK = 4_000  # units whose triples are held at once
KNOWN = 1 << 20  # scores of units a task remembers
PIECE = 1 << 20  # bytes of text that training looks at at once
KEYS = 1 << 15
LETTERS = 5  # bits of a symbol

FIRST, LAST = 30, 31
SYMBOLS = np.zeros(256, dtype=np.uint8)  # 1 to 26 letters, 27 to 29 bytes of other letters, 0 none
SYMBOLS[97:123] = np.arange(1, 27)
SYMBOLS[65:91] = np.arange(1, 27)
SYMBOLS[128:] = 27 + np.arange(128) % 3
for digit, letter in zip("0134578@$", "oieastbas"):
    SYMBOLS[ord(digit)] = SYMBOLS[ord(letter)]


@dataclass
class Units:
    """Units of texts: symbols of all, begin and end of each among them, its text and sentence."""

    symbols: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    sentence: np.ndarray


def units(piece: flat.Piece) -> Units:
    words = flat.words(piece)
    began = np.zeros(len(piece.data), dtype=np.int32)
    began[words.start] = 1
    symbols = SYMBOLS[piece.data]
    kept = symbols > 0
    symbols, word = symbols[kept], np.cumsum(began, dtype=np.int32)[kept] - 1
    if not len(symbols):
        none = np.zeros(0, dtype=np.int64)
        return Units(symbols, none, none, none, none)
    new = np.concatenate(([True], word[1:] != word[:-1]))
    begin = np.flatnonzero(new)
    text = np.searchsorted(words.at, word[begin], "right") - 1
    single = np.diff(np.append(begin, len(symbols))) == 1
    joined = np.zeros(len(begin), dtype=bool)  # spelled out letter by letter
    joined[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    begin, text = begin[~joined], text[~joined]
    end = np.append(begin[1:], len(symbols))
    # a sentence is over behind . ! ? at the end of a word, at a line feed and at the end of its text
    over = np.isin(piece.data[words.end - 1], np.frombuffer(b".!?", np.uint8))
    lines = np.concatenate(([0], np.cumsum(piece.data == 10, dtype=np.int32)))
    over[:-1] |= lines[words.start[1:]] > lines[words.end[:-1]]
    over[words.at[1:][words.at[1:] > 0] - 1] = True
    sentence = np.concatenate(([0], np.cumsum(over)[:-1]))[word[begin]] if len(over) else word[:0]
    # a mark before and behind each unit
    size = end - begin + 2
    edge = np.cumsum(size)
    marked = np.full(int(edge[-1]), LAST, dtype=np.uint8)
    marked[edge - size] = FIRST
    marked[np.arange(len(symbols)) + 1 + 2 * np.repeat(np.arange(len(size)), size - 2)] = symbols
    begin, end = edge - size, edge
    count = np.where(size > WINDOW, -(-(size - WINDOW // 2) // (WINDOW // 2)), 1)
    own = np.repeat(np.arange(len(begin)), count)
    first = begin[own] + (np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)) * (WINDOW // 2)
    return Units(marked, first, np.minimum(first + np.where(count[own] > 1, WINDOW, size[own]), end[own]), text[own], sentence[own])


def unit_hashes(found: Units) -> np.ndarray:
    prefix = flat.prefix_hashes(found.symbols, flat.BYTES)
    return flat.mix(flat.range_hashes(prefix, found.begin, found.end) + (found.end - found.begin).astype(np.uint64) * flat.ODD)


def triples(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """unit, key, weight of the letter triples of units, one row per unit and key."""
    size = end - begin
    own = np.repeat(np.arange(len(begin)), size)
    place = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    held, left = symbols[begin[own] + place].astype(np.int64), size[own] - place
    parts = []
    for wide in range(2, SPREAD):
        at = np.flatnonzero(left > wide)
        ends = (own[at] << 3 * LETTERS) | (held[at] << 2 * LETTERS) | held[at + wide]
        parts += [((ends | (held[at + inner] << LETTERS)) << 3) | wide for inner in range(1, wide)]
    rows = np.sort(np.concatenate(parts))
    key = rows >> 3
    first = np.flatnonzero(np.diff(key, prepend=-1))
    weight = DECAY ** ((rows & 7) + 1.0)
    weight = np.add.reduceat(weight, first) if len(first) else weight
    return key[first] >> 3 * LETTERS, key[first] & (KEYS - 1), weight


def per_unit(values: np.ndarray, unit: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(unit, values, minlength=count)


def weighed(table: np.ndarray, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The normalised kernel of each unit with the triples whose weights ``table`` holds."""
    out = np.zeros(len(begin))
    for at in range(0, len(begin), CHUNK):
        part = slice(at, min(at + CHUNK, len(begin)))
        unit, key, weight = triples(symbols, begin[part], end[part])
        count = part.stop - part.start
        length = np.sqrt(per_unit(weight**2, unit, count))
        out[part] = per_unit(weight * table[key], unit, count) / np.maximum(length, 1e-12)
    return out


def kernel(landmarks: np.ndarray, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The normalised kernel of each unit with each landmark (normalised triples, a column each)."""
    out = np.zeros((len(begin), landmarks.shape[1]), dtype=np.float32)
    for at in range(0, len(begin), CHUNK // 10):
        part = slice(at, min(at + CHUNK // 10, len(begin)))
        unit, key, weight = triples(symbols, begin[part], end[part])
        if not len(unit):
            continue
        length = np.sqrt(per_unit(weight**2, unit, part.stop - part.start))
        first = np.flatnonzero(np.diff(unit, prepend=-1))
        sums = np.add.reduceat(landmarks[key] * weight[:, None].astype(np.float32), first, axis=0)
        out[at + unit[first]] = sums / length[unit[first]][:, None]
    return out


def landmark_triples(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    unit, key, weight = triples(symbols, begin, end)
    out = np.zeros((KEYS, len(begin)), dtype=np.float32)
    length = np.sqrt(per_unit(weight**2, unit, len(begin)))
    out[key, unit] = weight / length[unit]
    return out


def machine(rows: np.ndarray, sign: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights and offset with the least squared hinge loss, by Newton steps; ``cost`` per row."""
    keep = np.ones(rows.shape[1] + 1)
    keep[-1] = 1e-3  # the offset is hardly penalised
    weights = np.zeros(len(keep))
    for _ in range(20):
        curvature, slope = np.diag(keep), np.zeros(len(keep))
        for at in range(0, len(rows), CHUNK):
            part = rows[at:at + CHUNK].astype(np.float64)
            part = np.hstack([part, np.ones((len(part), 1))])
            signs = sign[at:at + CHUNK]
            inside = signs * (part @ weights) < 1
            part, scaled = part[inside], part[inside] * cost[at:at + CHUNK][inside][:, None]
            curvature += scaled.T @ part
            slope += scaled.T @ signs[inside]
        further = np.linalg.solve(curvature, slope)
        if np.abs(further - weights).max() < 1e-6:
            break
        weights = further
    return weights


def logistic(values: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slopes and offset of the score, fitted to labels drawn in a little by their counts."""
    ones = labels.sum()
    aim = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    middle, scale = values.mean(axis=0), values.std(axis=0) + 1e-6
    x = np.hstack([(values - middle) / scale, np.ones((len(values), 1))])
    loss = lambda w: (np.logaddexp(0, x @ w) - aim * (x @ w)).sum() + 1e-3 * w @ w
    found = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slopes = x.T @ (p - aim) + 2e-3 * found
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(x.shape[1]), slopes)
        size = 1.0
        while size > 1e-6 and loss(found - size * step) > loss(found) - 1e-4 * size * (slopes @ step):
            size /= 2
        found = found - size * step
        if size * np.abs(step).max() < 1e-8:
            break
    slopes = np.maximum(found[:-1] / scale, 0)  # more evidence never lowers a score
    return np.append(slopes, found[-1] - slopes @ middle)


def spread_out(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies of units with a letter inserted at some inner place."""
    parts, sizes = [], []
    for a, b in zip(begin.tolist(), end.tolist()):
        for _ in range(INSERTED):
            parts.append(np.insert(symbols[a:b], draw.integers(2, max(3, b - a - 1)), draw.integers(1, 27)))
            sizes.append(b - a + 1)
    edge = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int64)
    return np.concatenate(parts) if parts else symbols[:0], edge[:-1], edge[1:]


def suspicion(text: np.ndarray, unit: np.ndarray, toxic: np.ndarray, count: int) -> np.ndarray:
    """By how many standard deviations the toxic texts with each unit exceed the expected number."""
    texts, units_ = np.divmod(np.unique(text * count + unit), count)
    expected = np.bincount(units_, minlength=count) * toxic[np.unique(text)].mean()
    return (np.bincount(units_[toxic[texts]], minlength=count) - expected) / np.sqrt(expected + 1)


def rounds(symbols, begin, end, columns, root, unit, sentence, excess, clean, draw) -> np.ndarray:
    """The machine: toxic sentences (pairs unit, sentence of suspect units) against clean units."""
    features = lambda *units: kernel(columns, *units) @ root.astype(np.float32)
    against, value = features(symbols, begin[clean], end[clean]), excess.copy()
    for _ in range(ROUNDS):
        order = np.lexsort((value[unit], sentence))  # at first the worst unit is that of the greatest excess
        worst = unit[order][np.append(np.diff(sentence[order]) != 0, True)]
        seen, times = np.unique(worst, return_counts=True)
        more = features(*spread_out(symbols, begin[seen], end[seen], draw))
        times = np.minimum(times, 20)
        cost = np.concatenate([times, np.repeat(times * SHARE, INSERTED), np.ones(len(clean))])
        sign = np.concatenate([np.ones(len(seen) * (1 + INSERTED)), -np.ones(len(clean))])
        weights = machine(np.concatenate([features(symbols, begin[seen], end[seen]), more, against]), sign, COST * cost)
        suspects = np.unique(unit)
        value[suspects] = features(symbols, begin[suspects], end[suspects]) @ weights[:-1]
    return weights


@dataclass
class Corpus:
    """Distinct units, ordered by hash, and the places of each: text, sentence, unit, once per sentence."""

    symbols: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    unit: np.ndarray


def gathered(texts: pa.Array) -> Corpus:
    """The units of all texts, found a piece at a time."""
    hashes, letters, sizes, places = [], [], [], []
    units_before = sentences_before = 0
    for piece in flat.pieces(texts, PIECE):
        found = units(piece)
        if not len(found.begin):
            continue
        own, one, number = np.unique(unit_hashes(found), return_index=True, return_inverse=True)
        size = found.end[one] - found.begin[one]
        letters.append(found.symbols[np.repeat(found.begin[one] - np.cumsum(size) + size, size) + np.arange(size.sum())])
        owner = np.zeros(found.sentence[-1] + 1, dtype=np.int64)
        owner[found.sentence] = found.text
        sentence, unit = np.divmod(np.unique(found.sentence * len(own) + number), len(own))
        places.append(np.stack([piece.first + owner[sentence], sentences_before + sentence, units_before + unit]).astype(np.int32))
        hashes.append(own)
        sizes.append(size)
        units_before, sentences_before = units_before + len(own), sentences_before + len(owner)
    if not hashes:
        return Corpus(*np.zeros((6, 0), dtype=np.int64))
    _, one, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    edge = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    text, sentence, unit = np.concatenate(places, axis=1)
    return Corpus(np.concatenate(letters), edge[one], edge[one + 1], text.astype(np.int64), sentence, number[unit])


def fitted(texts: pa.Array, labels: np.ndarray) -> dict[str, np.ndarray]:
    """The model's arrays."""
    draw = np.random.default_rng(7)
    found = gathered(texts)
    begin, end = found.begin, found.end
    count, toxic = len(begin), labels > 0
    aside = np.zeros(len(labels), dtype=bool)
    aside[draw.permutation(len(labels))[:len(labels) // 5]] = True
    if len(set(labels[~aside].tolist())) < 2:
        aside[:] = False
    # sentences of rows that are not set aside, each with its distinct units
    used = ~aside[found.text]
    text, sentence, unit = found.text[used], found.sentence[used], found.unit[used]
    bad = toxic[text]
    if not bad.any() or bad.all():
        return {"constant": np.array([toxic.mean()])}
    excess = suspicion(text, unit, toxic, count)
    in_clean = np.bincount(unit[~bad], minlength=count) > 0
    suspect = excess > SUSPECT
    if not suspect.any():
        return {"constant": np.array([toxic.mean()])}
    clean = np.flatnonzero(in_clean & ~suspect)
    pool, hard = draw.permutation(clean)[:POOL], clean[:0]
    for _ in range(2):
        chosen = np.unique(np.concatenate([
            np.flatnonzero(suspect)[np.argsort(-excess[suspect], kind="stable")][:LANDMARKS // 2], hard[:LANDMARKS // 4], pool[:LANDMARKS // 4]]))
        columns = landmark_triples(found.symbols, begin[chosen], end[chosen])
        own = kernel(columns, found.symbols, begin[chosen], end[chosen]).astype(np.float64)
        size, axes = np.linalg.eigh((own + own.T) / 2)
        root = (axes / np.sqrt(np.maximum(size, 1e-3))) @ axes.T
        place = bad & suspect[unit]
        weights = rounds(found.symbols, begin, end, columns, root, unit[place], sentence[place], excess, np.union1d(pool, hard), draw)
        whitened = root @ weights[:-1]
        table = np.concatenate([columns[at:at + CHUNK] @ whitened for at in range(0, KEYS, CHUNK)]).astype(np.float32)
        value = weighed(table, found.symbols, begin, end) + weights[-1]
        hard = clean[np.argsort(-value[clean], kind="stable")[:POOL]]
        suspect |= (value > 0) & ~in_clean & (excess > 0)  # what only toxic texts have and looks like an insult
    seen = evidence(value[found.unit], found.text, found.sentence, float(weights[-1]), len(labels))
    checked = aside if aside.any() else ~aside
    return {"table": table, "offset": weights[-1:], "curve": logistic(seen[checked], labels[checked])}


def evidence(values: np.ndarray, text: np.ndarray, sentence: np.ndarray, least: float, count: int) -> np.ndarray:
    """Of every text its worst unit (``least`` without one), and the logarithm of 1 + its toxic sentences."""
    worst = np.full(count, least)
    np.maximum.at(worst, text, values)
    bad = np.flatnonzero(values > 0)
    owners = text[bad[np.unique(sentence[bad], return_index=True)[1]]]
    return np.stack([worst, np.log1p(np.bincount(owners, minlength=count))], axis=1)


def train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows text, label of the sample, all in one task: the model as one row."""
    held = [b for b in batches if b.num_rows]
    labels = np.array([x for b in held for x in b.column(1).to_pylist()], dtype=np.float64)
    if len(set(labels.tolist())) < 2:
        model = stored(constant=np.array([labels.mean() if len(labels) else 0.0]))
    else:
        model = stored(**fitted(pa.Table.from_batches(held).column(0).combine_chunks(), labels))
    yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])


class Scorer:
    """The scores of texts under a stored model; values of units are remembered."""

    def __init__(self, model: bytes):
        self.arrays = dict(np.load(io.BytesIO(model)))
        self.hashes, self.values = np.zeros(0, dtype=np.uint64), np.zeros(0)

    def scores(self, piece: flat.Piece) -> np.ndarray:
        if "constant" in self.arrays:
            return np.repeat(self.arrays["constant"], piece.rows)
        found = units(piece)
        hashes, one, number = np.unique(unit_hashes(found), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), dtype=bool)
        values = np.zeros(len(hashes))
        values[known] = self.values[place[known]]
        new = one[~known]
        values[~known] = weighed(self.arrays["table"], found.symbols, found.begin[new], found.end[new])
        if len(self.hashes) < KNOWN:
            every = np.concatenate([self.hashes, hashes[~known]])
            order = np.argsort(every)
            self.hashes, self.values = every[order], np.concatenate([self.values, values[~known]])[order]
        curve, offset = self.arrays["curve"], float(self.arrays["offset"][0])
        seen = evidence((values + offset)[number], found.text, found.sentence, offset, piece.rows)
        return 1 / (1 + np.exp(-np.clip(seen @ curve[:-1] + curve[-1], -30, 30)))


def scoring(model):
    """A function that scores batches of id, text with the broadcast model."""
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            for piece in flat.pieces(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(piece.first, piece.rows), pa.array(scorer.scores(piece), pa.float64())], names=["id", "score"])
    return score_batches


def trained(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, max_train: int) -> bytes:
    """The model, trained on at most ``max_train`` labelled rows that are not held out."""
    marked = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(
        F.max("label").cast("double").alias("label"))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    chosen = cut(marked.join(texts.select("id").distinct(), "id").orderBy(
        F.xxhash64("id"), "id").limit(max_train), "toxicity-rows")
    # of rows that share an id, the smallest text
    sample = chosen.join(texts, "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    rows = sample.repartition(1).sortWithinPartitions("id").select("text", "label").mapInArrow(
        train_batches, "model binary").collect()
    return bytes(rows[0][0]) if rows else stored(constant=np.array([0.0]))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", max_train: int = MAX_TRAIN, accept: float = ACCEPT,
) -> DataFrame:
    """id, held_out, score and predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, id_column, text_column, label_column, max_train))
    kind = docs.schema[id_column].dataType.simpleString()
    scored = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).mapInArrow(
        scoring(model), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= accept).cast("int").alias("predicted"))
