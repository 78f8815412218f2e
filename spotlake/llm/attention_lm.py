"""Language-model scores of whole texts from a small causal self-attention model.

Texts in lower case (A-Z) become subword ids of a public tokenizer, whose file is a
parameter. The model is one attention layer over a window of ids with a learned bias per
distance, a rectified layer, and an output in levels: the group of the next id's class and the
class within its group from the network, the id within its class from counts after the class
of the id before it, smoothed by its count at large. So only the scores of the groups and of
one group's classes are computed for an id. Everything is numpy.

Training: random projections of the ids before and after each id are summed over all ids of
all training texts; classes of ids (k-means) and embeddings (principal axes) follow from
these sums, so only ids that occur in no training text keep random vectors and hash classes.
A first network, the common starting point, is fitted in one task on at most WARM distinct texts.
Every task then trains the layers above the embeddings on every block of every training text
of its own, and the average of their weights, by ids seen, is the model. The counts behind
the second output level, like those of the baseline, cover all ids of all training texts.

Scoring: a text is dealt into blocks of BLOCK ids; each block attends to itself and the
block before it under a causal mask, in large batches, so windows overlap and each id is
scored exactly once. The end of a text is an id too.

The baseline is a word model with counts of all training texts. Counts of the HEAD most
frequent words, a bounded table, are broadcast; rarer words meet their counts in a join.

Nulls: a null text is empty and has only its end, a null id belongs to the training part.
Repeated rows are counted and scored one by one. Without training texts the model
is untrained and its scores still are probabilities. An empty table gives an empty result.
Other columns are not looked at. Memory follows the longest text.
"""

from __future__ import annotations

import base64
import io
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship, text_of

ship(__name__)

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the published split pattern of this family of tokenizers.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for stretches in which no word, number or mark follows several spaces: without the look ahead, commonest first.
STRETCH = r""" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+"""
SEVERAL = re.compile(rb"[\x20\x09-\x0D]{2,}")
ONE_SPACE = bytes(np.where(flat.SPACES, 32, np.arange(256)).astype(np.uint8))
#: Spaces of the split pattern beyond ASCII.
FAR_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LOWER_TEXT = bytes(flat.LOWER)

BLOCK = 8
SIZE = 16
HIDDEN = 64
CLASSES = 128
#: Classes stand in GROUPS groups of WIDE: the network gives the group, then the class within it.
GROUPS = 16
WIDE = CLASSES // GROUPS
WARM = 2000
WARM_RATES = (0.01, 0.01, 0.004)
#: Random projections of the ids before an id, and as many of the ids after it.
SIDE = 24
BATCH = 512  # blocks
HEAD = 1 << 20
PIECE = 1 << 19  # bytes of text whose words are hashed at once
SMOOTH = 0.1
#: Weight of the count at large against the counts after one class.
PRIOR = 20.0
#: Scores of attention and classes stay below this, so that exponentials need no shift.
LIMIT = np.float32(60)
END = np.uint64(0x5E17D0C5E17D0C5D)
LAYERS = ("q", "k", "v", "o", "bias", "w1", "b1", "w2", "b2", "w3", "b3")


class Encoder:
    """Subword ids of texts; ``end`` also stands before the first id, ``pad`` fills blocks."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.end = max(table.values()) + 1
        self.pad = self.end + 1
        self.coder, self.stretch = (
            tiktoken.Encoding("subwords", pat_str=split, mergeable_ranks=table, special_tokens={}) for split in (SPLIT, STRETCH))

    def ids(self, text: str | None) -> np.ndarray:
        small = (text or "").encode().translate(LOWER_TEXT)
        whole = small.decode()
        if not whole.isascii() and any(space in whole for space in FAR_SPACES):
            return np.array(array("I", self.coder.encode_ordinary(whole)), dtype=np.uint32)
        if b"  " not in small.translate(ONE_SPACE):
            return np.array(array("I", self.stretch.encode_ordinary(whole)), dtype=np.uint32)
        ids, at = [], 0
        for several in SEVERAL.finditer(small):  # the last of several spaces goes with what follows
            if several.end() < len(small):
                ids += self.stretch.encode_ordinary(small[at:several.end() - 1].decode())
                at = several.end() - 1
        return np.array(array("I", ids + self.stretch.encode_ordinary(small[at:].decode())), dtype=np.uint32)


def blocks_of(texts: list[np.ndarray], end: int, pad: int) -> tuple[np.ndarray, ...]:
    """Inputs, targets, number of the block before (0: none) and text of every block.

    Block 0 is all padding. The inputs of a text are ``end`` and its ids, the targets its ids
    and ``end``.
    """
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    count = -(-lengths // BLOCK)
    first = 1 + np.concatenate(([0], np.cumsum(count)))[:-1]
    total = int(count.sum()) + 1
    inputs = np.full(total * BLOCK, pad, dtype=np.int64)
    targets = np.full(total * BLOCK, pad, dtype=np.int64)
    for ids, at in zip(texts, (first * BLOCK).tolist()):
        inputs[at] = end
        inputs[at + 1:at + 1 + len(ids)] = ids
        targets[at:at + len(ids)] = ids
        targets[at + len(ids)] = end
    before = np.arange(total) - 1
    before[first] = 0
    before[0] = 0
    text = np.concatenate(([-1], np.repeat(np.arange(len(texts)), count)))
    return inputs.reshape(total, BLOCK), targets.reshape(total, BLOCK), before, text


DISTANCE = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
CAUSAL = DISTANCE >= 0
STEPS = np.maximum(DISTANCE, 0)
#: Sums over the groups, and over the classes of one group.
LEVELS = np.repeat(np.eye(2, dtype=np.float32), (GROUPS, WIDE), axis=0)


class Attention:
    """The model: arrays by name, among them ``embed`` and ``of_class`` (the class of every id)."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays

    @classmethod
    def fresh(cls, vocabulary: int) -> Attention:
        draw = np.random.default_rng(3)

        def rows(*shape: int) -> np.ndarray:
            return draw.normal(0, shape[0] ** -0.5, shape).astype(np.float32)

        return cls({
            "embed": (draw.normal(0, 0.5, (vocabulary + 1, SIZE))).astype(np.float32),
            "of_class": (flat.mix(np.arange(vocabulary, dtype=np.uint64)) % np.uint64(CLASSES)).astype(np.int64),
            "q": rows(SIZE, SIZE), "k": rows(SIZE, SIZE), "v": rows(SIZE, SIZE), "o": rows(SIZE, SIZE),
            "bias": np.zeros(2 * BLOCK, np.float32), "w1": rows(2 * SIZE, HIDDEN), "b1": np.zeros(HIDDEN, np.float32),
            "w2": rows(HIDDEN, GROUPS), "b2": np.zeros(GROUPS, np.float32),
            "w3": rows(HIDDEN, CLASSES), "b3": np.zeros(CLASSES, np.float32)})

    def tables(self) -> dict[str, np.ndarray]:
        """Products of the layers: between queries and keys, from an id and what it attends to into the hidden layer, and for
        every group from there to the groups and to its classes. The last of what enters a layer is 1: it brings the biases."""
        a = self.a
        enter = np.zeros((2 * SIZE + 1, HIDDEN + 1), a["w1"].dtype)
        enter[:SIZE, :HIDDEN], enter[SIZE:-1, :HIDDEN], enter[-1, :HIDDEN] = a["w1"][:SIZE], a["v"] @ a["o"] @ a["w1"][SIZE:], a["b1"]
        enter[-1, HIDDEN] = 1
        leave = np.empty((GROUPS, HIDDEN + 1, GROUPS + WIDE), a["w1"].dtype)
        leave[:, :HIDDEN, :GROUPS], leave[:, HIDDEN, :GROUPS] = a["w2"], a["b2"]
        leave[:, :HIDDEN, GROUPS:] = a["w3"].reshape(HIDDEN, GROUPS, WIDE).transpose(1, 0, 2)
        leave[:, HIDDEN, GROUPS:] = a["b3"].reshape(GROUPS, WIDE)
        return {"match": a["q"] @ a["k"].T * np.float32(SIZE**-0.5),
                "enter": enter, "leave": leave}

    def attended(self, own: np.ndarray, before: np.ndarray, pad: int, tables: dict) -> dict:
        """What enters the hidden layer at every id of the blocks ``own``, with what leads to it."""
        a = self.a
        seen = np.concatenate((before, own), axis=1)
        held = a["embed"].take(seen.ravel(), axis=0).reshape(*seen.shape, SIZE)
        entered = np.empty((len(own), BLOCK, 2 * SIZE + 1), dtype=held.dtype)  # the ids themselves, then what they attend to
        entered[:, :, :SIZE], entered[:, :, -1] = held[:, BLOCK:], 1
        queries = (entered.reshape(-1, 2 * SIZE + 1)[:, :SIZE] @ tables["match"]).reshape(len(own), BLOCK, SIZE)
        weights = queries @ held.transpose(0, 2, 1)
        weights += a["bias"][STEPS]
        np.exp(np.clip(weights, -LIMIT, LIMIT, out=weights), out=weights)
        weights *= CAUSAL.astype(weights.dtype)
        weights[before[:, 0] == pad, :, :BLOCK] = 0  # the padding behind a text is causally out of sight
        weights /= (weights.reshape(-1, 2 * BLOCK) @ np.ones(2 * BLOCK, weights.dtype)).reshape(len(own), BLOCK, 1)
        np.matmul(weights, held, out=entered[:, :, SIZE:-1])
        return {"seen": seen, "held": held, "queries": queries, "weights": weights, "entered": entered.reshape(-1, 2 * SIZE + 1)}

    def layer(self, entered: np.ndarray, tables: dict) -> np.ndarray:
        hidden = entered @ tables["enter"]
        return np.clip(hidden, 0, np.inf, out=hidden)

    def hidden(self, own: np.ndarray, before: np.ndarray, pad: int, tables: dict) -> dict:
        """``attended`` and the hidden layer at every id of the blocks ``own``."""
        f = self.attended(own, before, pad, tables)
        return f | {"hidden": self.layer(f["entered"], tables)}

    def parts(self, targets: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Places of all targets but ``pad`` in the order of their groups, the flat places in the output of the groups
        and of the classes within them, and the slice of each group."""
        real = np.flatnonzero(targets != pad)
        goal = self.a["of_class"].take(targets.take(real))
        group = (goal // WIDE).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        real, goal, group = real.take(order), goal.take(order), group.take(order)
        edges = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        rows = np.arange(0, len(real) * (GROUPS + WIDE), GROUPS + WIDE)
        return real, rows + group, rows + (goal % WIDE + GROUPS), [
            (g, slice(lo, hi)) for g, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi]

    def scores(self, hidden: np.ndarray, groups: list, tables: dict) -> np.ndarray:
        """Exponentials of the scores of all groups, then of the classes of the target's group."""
        scores = np.empty((len(hidden), GROUPS + WIDE), dtype=hidden.dtype)
        for g, part in groups:
            np.matmul(hidden[part], tables["leave"][g], out=scores[part])
        return np.exp(np.clip(scores, -LIMIT, LIMIT, out=scores), out=scores)

    def output(self, hidden: np.ndarray, targets: np.ndarray, pad: int) -> dict:
        """Both levels of the output at every target but ``pad``, in the order ``real`` of the targets' groups.

        ``outer`` and ``inner`` are exponentials of the scores of the groups and of the classes of the target's group.
        """
        real, _, _, groups = self.parts(targets, pad)
        scores = self.scores(hidden.take(real, axis=0), groups, self.tables())
        return {"real": real, "outer": scores[:, :GROUPS], "inner": scores[:, GROUPS:]}

    def gains(self, own: np.ndarray, before: np.ndarray, targets: np.ndarray, pad: int, tables: dict) -> np.ndarray:
        """Log probability of the class of every target, as ``forward`` gives it, from the target's group only; 0 at ``pad``."""
        entered = self.attended(own, before, pad, tables)["entered"]
        real, group, within, groups = self.parts(targets, pad)
        scores = self.scores(self.layer(entered.take(real, axis=0), tables), groups, tables)
        totals, scores = scores @ LEVELS, scores.ravel()
        gain = np.zeros(targets.size, dtype=scores.dtype)
        gain[real] = np.log(scores.take(group) / totals[:, 0] * (scores.take(within) / totals[:, 1]))
        return gain

    def forward(self, own: np.ndarray, before: np.ndarray, pad: int) -> dict:
        """Log probabilities of all classes after every id of the blocks ``own``."""
        a = self.a
        hidden = self.hidden(own, before, pad, self.tables())["hidden"]
        hidden = hidden[:, :HIDDEN]
        outer = np.clip(hidden @ a["w2"] + a["b2"], -LIMIT, LIMIT)
        inner = np.clip(hidden @ a["w3"] + a["b3"], -LIMIT, LIMIT).reshape(-1, GROUPS, WIDE)
        outer -= np.log(np.exp(outer).sum(axis=1, keepdims=True))
        inner -= np.log(np.exp(inner).sum(axis=2, keepdims=True))
        return {"logs": (outer[:, :, None] + inner).reshape(-1, CLASSES)}

    def slopes(self, own, before, targets, pad, embed: bool) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss of the classes."""
        a, t = self.a, self.tables()
        f = self.attended(own, before, pad, t)
        real, group, within, groups = self.parts(targets.ravel(), pad)
        entered = f["entered"].take(real, axis=0)
        hidden = self.layer(entered, t)
        scores = self.scores(hidden, groups, t)
        scores *= np.divide(1, scores @ LEVELS) @ LEVELS.T
        scores.ravel()[group] -= 1
        scores.ravel()[within] -= 1
        leave, down = np.zeros_like(t["leave"]), np.empty_like(hidden)
        each = np.asarray(1 / max(len(real), 1), scores.dtype)  # the mean over all targets
        for g, part in groups:
            np.matmul(hidden[part].T, scores[part], out=leave[g])
            np.matmul(scores[part], t["leave"][g].T, out=down[part])
        down *= hidden > 0
        enter = entered.T @ down * each
        leave *= each
        onward = (t["enter"] if embed else t["enter"][SIZE:])[:-1].T * each
        back = np.zeros((len(real) + 1, onward.shape[1]), down.dtype)  # the last row is that of the padding
        np.matmul(down, onward, out=back[:-1])
        brought, both = enter[SIZE:-1, :HIDDEN], leave[:, :, :GROUPS].sum(axis=0)
        out = {"w2": both[:HIDDEN], "b2": both[HIDDEN], "b1": enter[-1, :HIDDEN],
               "w3": leave[:, :HIDDEN, GROUPS:].transpose(1, 0, 2).reshape(a["w3"].shape), "b3": leave[:, HIDDEN, GROUPS:].ravel(),
               "w1": np.concatenate((enter[:SIZE, :HIDDEN], (a["v"] @ a["o"]).T @ brought)),
               "o": a["v"].T @ brought @ a["w1"][SIZE:].T, "v": brought @ (a["o"] @ a["w1"][SIZE:]).T}
        place = np.full(len(f["entered"]), len(real))
        place[real] = np.arange(len(real))
        inner = back.take(place, axis=0)
        mixed = inner[:, -SIZE:]
        along = np.einsum("ij,ij->i", mixed, f["entered"][:, SIZE:-1]).reshape(len(own), BLOCK, 1)
        mixed = mixed.reshape(len(own), BLOCK, SIZE)
        scores = mixed @ f["held"].transpose(0, 2, 1)
        scores -= along
        scores *= f["weights"]
        out["bias"] = np.bincount(STEPS.ravel(), (scores.sum(axis=0) * CAUSAL).ravel(), 2 * BLOCK)
        queries = (scores @ f["held"]).reshape(-1, SIZE)
        match = f["entered"][:, :SIZE].T @ queries * np.float32(SIZE**-0.5)
        out["q"], out["k"] = match @ a["k"], match.T @ a["q"]
        if embed:
            ids = np.concatenate((own.ravel(), f["seen"].ravel()))
            rows = np.concatenate((
                inner[:, :SIZE] + queries @ t["match"].T,
                (scores.transpose(0, 2, 1) @ f["queries"] + f["weights"].transpose(0, 2, 1) @ mixed).reshape(-1, SIZE)))
            out["embed"] = np.stack([np.bincount(ids, rows[:, i], len(a["embed"])) for i in range(SIZE)], axis=1)
            out["embed"][pad] = 0
        return out

    def train(self, texts: list[np.ndarray], end: int, pad: int, rate: float, embed: bool, seed: int) -> None:
        """One pass of Adam over every block of ``texts``."""
        own, targets, before, _ = blocks_of(texts, end, pad)
        names = LAYERS + ("embed",) * embed
        held = np.concatenate([self.a[n].ravel() for n in names])  # the arrays of the model become views of one
        ends = np.cumsum([self.a[n].size for n in names])
        self.a |= {n: part.reshape(self.a[n].shape) for n, part in zip(names, np.split(held, ends[:-1]))}
        if not hasattr(self, "speed") or len(self.speed) != len(held):
            self.speed, self.force, self.step = np.zeros_like(held), np.zeros_like(held), 0
        order = 1 + np.random.default_rng(seed).permutation(len(own) - 1)
        size = 2 * BATCH if embed else BATCH
        for at in range(0, len(order), size):
            part = order[at:at + size]
            slopes = self.slopes(
                own.take(part, axis=0), own.take(before.take(part), axis=0), targets.take(part, axis=0), pad, embed)
            slope = np.concatenate([slopes[n].ravel() for n in names]).astype(np.float32)
            self.step += 1
            self.speed += np.float32(0.1) * (slope - self.speed)
            self.force += np.float32(0.01) * (slope * slope - self.force)
            held -= np.float32(rate / (1 - 0.9**self.step)) * self.speed / (
                np.sqrt(self.force * np.float32(1 / (1 - 0.99**self.step))) + np.float32(1e-6))

    def stored(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.a)
        return out.getvalue()

    @classmethod
    def loaded(cls, stored: bytes) -> Attention:
        return cls(dict(np.load(io.BytesIO(stored))))


def neighbours(texts: list[np.ndarray], index: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each id stands in the texts (``end`` closes each), and the sums of the ``index`` rows of the ids
    before and after it."""
    edge = np.array([end])
    line = np.concatenate([edge, *(part for ids in texts for part in (ids, edge))]).astype(np.int64)
    pairs = line[:-1] * (end + 1) + line[1:]
    pairs = np.sort(pairs.astype(np.uint32) if (end + 1)**2 < 1 << 32 else pairs)
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))[:len(pairs)])
    left, right = np.divmod(pairs[first].astype(np.int64), end + 1)  # each pair of neighbours once
    times = np.diff(np.append(first, len(pairs))).astype(np.float64)
    around = np.zeros((end + 1, 2 * SIDE), dtype=np.int64)
    for column in range(SIDE):
        values = index[:, column]
        around[:, column] = np.bincount(right, values[left] * times, end + 1)
        around[:, SIDE + column] = np.bincount(left, values[right] * times, end + 1)
    return np.bincount(line[1:], minlength=end + 1), around


def projections(vocabulary: int) -> np.ndarray:
    return np.random.default_rng(9).choice([-1.0, 0.0, 0.0, 1.0], size=(vocabulary, SIDE)).astype(np.float32)


def summing(end: int):
    """Rows id, n and the sums of its neighbours for every id in the texts of a task."""
    def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = projections(end + 1)
        counts, around = np.zeros(end + 1, dtype=np.int64), np.zeros((end + 1, 2 * SIDE), dtype=np.int64)
        for _, texts in groups(batches, 0, 1 << 24):
            n, sums = neighbours(texts, index, end)
            counts += n
            around += sums
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[seen]), *(pa.array(around[seen, i]) for i in range(2 * SIDE))],
            names=["id", "n", *(f"s{i}" for i in range(2 * SIDE))])
    return sum_batches


def grouped(centres: np.ndarray) -> np.ndarray:
    """New numbers of the classes: halves along the main axis, of these the halves again, so that groups are alike."""
    parts = [np.arange(len(centres))]
    while len(parts) < GROUPS:
        halves = []
        for part in parts:
            rows = centres[part] - centres[part].mean(axis=0)
            along = rows @ np.linalg.eigh(rows.T @ rows)[1][:, -1]
            halves += np.array_split(part[np.argsort(along, kind="stable")], 2)
        parts = halves
    return np.argsort(np.concatenate(parts))


def fit_ids(model: Attention, seen: np.ndarray, counts: np.ndarray, around: np.ndarray) -> None:
    """Classes (k-means) and embeddings (principal axes) of the ids ``seen``, which follow and precede alike ids."""
    rows = around / np.sqrt(counts)[:, None]
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    weight = np.sqrt(counts).astype(np.float64)
    centred = rows - np.average(rows, axis=0, weights=weight)
    axes = np.linalg.eigh((centred * weight[:, None]).T @ centred)[1][:, ::-1][:, :SIZE]
    spread = centred @ axes
    scale = np.sqrt(np.average(spread**2, axis=0, weights=weight))
    model.a["embed"][seen] = 0.5 * spread / np.maximum(scale, 1e-6)
    if len(seen) <= CLASSES:
        return
    centres = rows[np.argsort(-counts, kind="stable")[:CLASSES]]
    for _ in range(12):
        own = np.argmax(rows @ centres.T, axis=1)
        for column in range(rows.shape[1]):
            centres[:, column] = np.bincount(own, rows[:, column] * weight, CLASSES)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    model.a["of_class"][seen] = grouped(centres)[np.argmax(rows @ centres.T, axis=1)]


def encoding(ranks):
    """id, print, train and text become id, print, train, ids (little-endian 32 bit)."""
    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [encoder.ids(text).tobytes() for text in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array(ids, pa.binary())], names=["id", "print", "train", "ids"])
    return encode_batches


def decoded(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), dtype=np.uint32).astype(np.int64) for value in column]


def groups(batches: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches with the ids of their texts, about ``limit`` bytes at a time."""
    for batch in batches:
        sizes = np.cumsum([len(v.as_buffer()) for v in batch.column(column)])
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right")))
            part = batch.slice(at, upto - at)
            yield part, decoded(part.column(column))
            at = upto


def counting(first, end: int):
    """How often each id follows an id of each class in the texts of a task: cell (class before
    times vocabulary plus id) and n."""
    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_class = Attention.loaded(first.value).a["of_class"]
        total = np.zeros(CLASSES * (end + 1), dtype=np.int64)
        edge = np.array([end])
        for _, texts in groups(batches, 0, 1 << 24):
            line = np.concatenate([edge, *(part for ids in texts for part in (ids, edge))])
            total += np.bincount(of_class[line[:-1]] * (end + 1) + line[1:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["cell", "n"])
    return count_batches


def within_class(counts: np.ndarray, of_class: np.ndarray) -> np.ndarray:
    """Log probability of every id within its class, after an id of each class."""
    after = np.stack([np.bincount(of_class, row, CLASSES) for row in counts])
    at_large = counts.sum(axis=0)
    size = np.bincount(of_class, minlength=CLASSES)
    total = np.bincount(of_class, at_large, CLASSES)
    share = (at_large + SMOOTH) / (total + SMOOTH * size)[of_class]
    return np.log((counts + PRIOR * share) / (after[:, of_class] + PRIOR)).astype(np.float32)


def warming(fitted, end: int):
    """All rows (ids) of the warm-up in one task: the first model as one row."""
    def warm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [ids for _, part in groups(batches, 0) for ids in part]
        model = Attention.loaded(fitted.value)
        if texts:
            for number, rate in enumerate(WARM_RATES):
                model.train(texts, end, end + 1, rate, False, number)
        yield pa.RecordBatch.from_arrays([pa.array([model.stored()], pa.binary())], names=["model"])
    return warm_batches


def training(first, end: int):
    """Train on all texts of a task; rows part, place, weighted value, weight."""
    def train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weight = Attention.loaded(first.value), 0
        for number, (_, texts) in enumerate(groups(batches, 0)):
            model.train(texts, end, end + 1, 0.001, False, number)
            weight += sum(len(t) + 1 for t in texts)
        if weight:
            for part, name in enumerate(LAYERS):
                values = model.a[name].ravel().astype(np.float64) * weight
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(values), part, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)),
                    pa.array(values), pa.array(np.full(len(values), float(weight)))], names=["part", "place", "value", "weight"])
    return train_batches


def scoring(model, end: int):
    """id, print, train, ids become id, print, score: log10 of the probability of the text."""
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = dict(np.load(io.BytesIO(model.value)))
        within = arrays.pop("within")
        network = Attention(arrays)
        tables, of_class = network.tables(), network.a["of_class"]
        for part, texts in groups(batches, 3):
            own, targets, before, text = blocks_of(texts, end, end + 1)
            scores = np.zeros(len(texts))
            for at in range(1, len(own), BATCH):
                chosen = slice(at, at + BATCH)
                goal = targets[chosen].ravel()
                real = np.flatnonzero(goal <= end)
                gain = network.gains(own[chosen], own[before[chosen]], goal, end + 1, tables)[real].astype(np.float64)
                gain += within[of_class[own[chosen].ravel()[real]], goal[real]]
                scores += np.bincount(np.repeat(text[chosen], BLOCK)[real], gain, len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores / math.log(10))], names=["id", "print", "score"])
    return score_batches


def count_word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word (hash) and n of the texts of a task, merged in memory up to a bound."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        words, counts = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        at = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        return words[at], np.add.reduceat(counts, at)

    def rows(pair: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1])], names=["word", "n"])

    for batch in batches:
        for piece in flat.pieces(batch.column(0), PIECE):
            words, counts = np.unique(flat.words(piece).hashes, return_counts=True)
            held.append((np.append(words, END), np.append(counts, piece.rows).astype(np.int64)))
            size += len(words) + 1
            if size > 1 << 21:
                held = [merged()]
                size = len(held[0][0])
                if size > 1 << 20:
                    yield rows(held[0])
                    held, size = [], 0
    if held:
        yield rows(merged())


class Places:
    """Places of 64-bit hashes in a sorted table, from the first place for every value of their leading bits."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.shift = np.uint64(64 - max(len(known).bit_length(), 1))
        self.first = np.searchsorted(known, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The first place whose value is not below the hash, or the last one."""
        last = max(len(self.known) - 1, 0)
        place = np.minimum(self.first.take((hashes >> self.shift).astype(np.int64)), last)
        below = np.flatnonzero(self.known.take(place) < hashes) if len(self.known) else place[:0]
        while len(below):
            place[below] += 1
            below = below[place[below] <= last]
            below = below[self.known.take(place[below]) < hashes[below]]
        return np.minimum(place, last)


def basing(head):
    """id, print, text become a row per text (word null) and a row per text and rare word, both with the number ``row``."""
    def base_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.load(io.BytesIO(head.value))
        known, logs = table["words"], table["logs"]
        places = Places(known)
        following = TaskContext.get().partitionId() << 40  # texts are numbered task by task
        for batch in batches:
            for piece in flat.pieces(batch.column(2), PIECE):
                words = flat.words(piece)
                hashes = np.append(words.hashes, np.repeat(END, piece.rows))
                text = np.append(np.searchsorted(words.at, np.arange(len(words.hashes)), "right") - 1, np.arange(piece.rows))
                place = places.of(hashes)
                found = known[place] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
                sums = np.bincount(text[found], logs[place[found]], piece.rows) if found.any() else np.zeros(piece.rows)
                part = batch.slice(piece.first, piece.rows)
                order = np.lexsort((hashes[~found], text[~found]))
                rare, owner = hashes[~found][order], text[~found][order]
                at = np.flatnonzero((np.diff(rare, prepend=rare[:1] + np.uint64(1)) != 0) | (np.diff(owner, prepend=-1) != 0))
                times = np.diff(np.append(at, len(rare)))
                number = following + np.arange(piece.rows)
                following += piece.rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(number), part.column(0), part.column(1), pa.nulls(piece.rows, pa.int64()),
                    pa.array(np.bincount(text, minlength=piece.rows).astype(np.int64)),
                    pa.array(np.bincount(text[found], minlength=piece.rows).astype(np.int64)), pa.array(sums)],
                    names=["row", "id", "print", "word", "n", "n_head", "head"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(number[owner[at]]), pa.nulls(len(at), part.column(0).type), pa.nulls(len(at), part.column(1).type),
                    pa.array(rare[at].view(np.int64)), pa.array(times.astype(np.int64)),
                    pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.float64())],
                    names=["row", "id", "print", "word", "n", "n_head", "head"])
    return base_batches


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def warm_up(learned: DataFrame, warm: int) -> DataFrame:
    """print, ids of ``warm`` distinct texts drawn by hash; copies of a text count once."""
    chosen = learned.select("print").distinct().orderBy(F.xxhash64(F.lit(5), "print"), "print").limit(warm)
    return learned.join(cut(chosen, "warm-up"), "print", "left_semi").select("print", "ids").dropDuplicates(["print"])


def model_scores(texts: DataFrame, kind: str, ranks: bytes, warm: int) -> DataFrame:
    """id, print, score of every distinct row of ``texts`` (id, print, train, text)."""
    spark = texts.sparkSession
    context = spark.sparkContext
    end = Encoder(ranks).end
    encoded = cut(texts.mapInArrow(encoding(context.broadcast(ranks)), f"id {kind}, print bigint, train boolean, ids binary"),
                  "subword-ids", compression="zstd")
    learned = encoded.where("train").select("ids")
    model, columns = Attention.fresh(end + 1), [f"s{i}" for i in range(2 * SIDE)]
    sums = learned.mapInArrow(summing(end), ", ".join(f"{name} bigint" for name in ["id", "n", *columns])).groupBy("id").agg(
        F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in columns]).orderBy("id").toArrow()  # a row per id
    if sums.num_rows:
        fit_ids(model, sums["id"].to_numpy(), sums["n"].to_numpy(), np.stack([sums[name].to_numpy() for name in columns], axis=1))
    sample = warm_up(encoded.where("train"), warm)
    first = sample.repartition(1).sortWithinPartitions("print").select("ids").mapInArrow(
        warming(context.broadcast(model.stored()), end), "model binary").collect()
    model = Attention.loaded(bytes(first[0][0])) if first else model
    warmed = context.broadcast(model.stored())
    cells = learned.mapInArrow(counting(warmed, end), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES * (end + 1))  # the table has at most one row per class and id
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    sums = learned.mapInArrow(training(warmed, end), "part int, place int, value double, weight double")
    averaged = sums.groupBy("part", "place").agg((F.sum("value") / F.sum("weight")).alias("value"))
    for part, place, value in averaged.collect():  # one row per weight of the network
        model.a[LAYERS[part]].ravel()[place] = value
    within = within_class(counts.reshape(CLASSES, end + 1), model.a["of_class"])
    size = np.bincount(model.a["of_class"], minlength=CLASSES)
    # a class without ids never comes next: its share goes to the others
    model.a["b3"] = np.where(size > 0, model.a["b3"], -1e4).astype(np.float32)
    model.a["b2"] = np.where(size.reshape(GROUPS, WIDE).any(axis=1), model.a["b2"], -1e4).astype(np.float32)
    final = context.broadcast(packed(within=within, **model.a))
    return cut(encoded.mapInArrow(scoring(final, end), f"id {kind}, print bigint, score double").dropDuplicates(
        ["id", "print"]), "model-scores")


def lm_scores(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = TOKENIZER,
    head_words: int = HEAD, warm: int = WARM,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    key = F.col(f"`{id_column}`")
    texts = docs.select(
        key.alias("id"), F.xxhash64(text_of(text_column)).alias("print"), (~held_out(key)).alias("train"),
        text_of(text_column).alias("text"))
    with open(tokenizer, "rb") as file:
        ranks = file.read()
    scores = model_scores(texts, kind, ranks, warm)

    counts = cut(texts.where("train").select("text").mapInArrow(count_word_batches, "word bigint, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n")), "word-counts")
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)), F.sum("n")).collect(), reverse=True)
    distinct, total = sum(row[1] for row in levels), sum(row[2] for row in levels)
    least, taken = 1 << 30, 0
    for number, words, _ in levels:  # at most eight levels per power of two
        taken += words
        if taken > head_words:
            break
        least = number
    frequent = counts.where(level >= least).toArrow()
    words = frequent.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    logs = np.log10(frequent.column("n").to_numpy() + SMOOTH)
    head = spark.sparkContext.broadcast(packed(words=words[order], logs=logs[order]))
    based = cut(texts.select("id", "print", "text").mapInArrow(
        basing(head), f"row bigint, id {kind}, print bigint, word bigint, n bigint, n_head bigint, head double"), "base-parts")
    rare = based.where("word is not null").select("row", "word", "n")
    few = counts.where(level < least).select("word", F.col("n").alias("c"))
    rest = rare.join(few, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("rest"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_rest"))
    rows = based.where("word is null").select("row", "id", "print", F.col("n").alias("n_tokens"), "n_head", "head")
    r, s = rows.join(cut(rest, "rare-words"), "row", "left").alias("r"), scores.alias("s")
    same = F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.print") == F.col("s.print"))
    share = math.log10(total + SMOOTH * (distinct + 1))
    return r.join(s, same).select(
        F.col("r.id").alias(id_column), held_out(F.col("r.id")).alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * share).alias("base_score"), "score")
