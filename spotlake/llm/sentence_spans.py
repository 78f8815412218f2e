"""Removal of passages that repeat, by sliding spans of sentences.

From every sentence the shortest run of at least two sentences with WORDS words is taken
forward, and up to every sentence the shortest such run backward, and every sentence of WORDS
words is a run of its own; each run is hashed. The runs of all documents meet by hash, and a sentence goes if any run that covers it stands
in a document with a smaller id too, or earlier in its own. Runs are compared by their words
in lower case, so white space does not matter. What stays is cut from the text unchanged.

A common run is reduced to its smallest id in every task before the shuffle; the join that
brings the decision back pairs two stored tables, which adaptive execution splits where a
run is in a third of all rows. Within a document only the first of equal runs takes part.

A sentence ends at a word ending in ``.``, ``!``, ``?`` or a mark of another script (MARKS), closing
quotes and brackets aside, or at a line feed. Kana and Han characters are words of their own.
A sentence of more than LONG words is split further where two neighbouring words, by their
hash, say so, thus at the same places wherever a passage stands; what repeats within a
shorter sentence without being all of it stays. Nulls: a null
text stays null and has no sentences, a null id counts as larger than all others. Repeated
rows are treated alike: both keep what the first document of its kind keeps. Texts that share
an id share the ranges found for it. An empty table gives an empty result. Other columns are not looked at. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship

ship(__name__)

WORDS = 20
#: Sentences of more words are split before every word that makes, with the word before it, a hash divisible by PART.
LONG = 60
PART = 8
ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?"]] = True
MARKS = [mark.encode() for mark in "。｡！？．؟۔।॥…։።"]
CLOSERS = [mark.encode() for mark in "\"')]}”’»›」』）"]


def ending(data: np.ndarray, start: np.ndarray, end: np.ndarray, mark: bytes) -> np.ndarray:
    """Which words (bytes ``start`` to ``end``) end in ``mark``."""
    found = end - start >= len(mark)
    for back, byte in enumerate(reversed(mark), 1):
        found &= data[np.maximum(end - back, 0)] == byte
    return found


def closing(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words end a sentence."""
    end = end.copy()
    other = bool((data >= 128).any())
    closers, marks = ([m for m in held if other or m[0] < 128] for held in (CLOSERS, MARKS))
    at = np.arange(len(end))
    while len(at):  # only words that still end in a closer are looked at again
        step = np.zeros(len(at), dtype=np.int64)
        for mark in closers:
            step[ending(data, start[at], end[at], mark)] = len(mark)
        end[at] -= step
        at = at[(step > 0) & (end[at] > start[at])]
    out = (end > start) & ENDS[data[np.maximum(end - 1, 0)]]
    for mark in marks:
        out |= ending(data, start, end, mark)
    return out


def words_of(piece: flat.Piece) -> flat.Words:
    """The words of a piece; every kana or Han character begins one, marks stay with the word before."""
    words, data = flat.words(piece), piece.data
    begins = (data >= 0xE3) & (data <= 0xE9)
    if not begins.any():
        return words
    after = np.append(data[1:], 0)
    begins &= ~((data == 0xE3) & (after == 0x80))
    places = np.flatnonzero(begins)
    own = np.searchsorted(words.start, places, "right") - 1
    inner = places[words.start[own] < places]
    start = np.sort(np.concatenate((words.start, inner)))
    end = np.sort(np.concatenate((words.end, inner)))
    hashes = flat.mix(flat.range_hashes(flat.prefix_hashes(data, flat.BYTES[flat.LOWER]), start, end)
                      + (end - start).astype(np.uint64) * flat.ODD)
    return flat.Words(hashes, start, end, np.searchsorted(start, piece.offsets))


def sentences(piece: flat.Piece) -> tuple[flat.Words, np.ndarray, np.ndarray]:
    """The words of a piece, the first word of every sentence, the first sentence of every text."""
    words = words_of(piece)
    count = len(words.hashes)
    begins = np.zeros(count + 1, dtype=bool)
    if count:
        lines = np.concatenate(([0], np.cumsum(piece.data == 10)))
        begins[1:-1] = closing(piece.data, words.start[:-1], words.end[:-1]) | (lines[words.start[1:]] > lines[words.end[:-1]])
        begins[words.at[:-1][words.at[:-1] < words.at[1:]]] = True
    begins[count] = True
    first = np.flatnonzero(begins)
    if count and (np.diff(first) > LONG).any():
        long = np.repeat(np.diff(first) > LONG, np.diff(first))
        one, two = words.hashes[:-1], words.hashes[1:]
        begins[1:-1] |= long[1:] & long[:-1] & (one != two) & (flat.mix(one * flat.ODD + two) % np.uint64(PART) == 0)
    first = np.flatnonzero(begins)
    return words, first, np.searchsorted(first, words.at)


def runs(words: flat.Words, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, first and last sentence (within the piece) and hash of every run."""
    count = len(first) - 1
    number = np.arange(count)
    text = np.searchsorted(at, number, "right") - 1
    ahead = np.maximum(np.searchsorted(first, first[:-1] + WORDS) - 1, number + 1)
    back = np.minimum(np.searchsorted(first, first[1:] - WORDS, "right") - 1, number - 1)
    fits_ahead, fits_back = ahead < at[text + 1], back >= at[text]
    alone = number[np.diff(first) >= WORDS]
    one = np.concatenate((number[fits_ahead], back[fits_back], alone))
    two = np.concatenate((ahead[fits_ahead], number[fits_back], alone))
    key = np.unique(one * (count + 1) + two)
    one, two = key // (count + 1), key % (count + 1)
    flat.POWERS.grow(len(words.hashes) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.hashes * flat.POWERS.up[:len(words.hashes)])))
    start, end = first[one], first[two + 1]
    return text[one], one, two, flat.mix((prefix[end] - prefix[start]) * flat.POWERS.down[start] + (end - start).astype(np.uint64))


def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, run, first, last, again: ``again`` marks a run that stands earlier in the same text."""
    for batch in batches:
        for piece in flat.pieces(batch.column(1)):
            words, first, at = sentences(piece)
            text, one, two, run = runs(words, first, at)
            order = np.lexsort((one, run, text))
            again = np.zeros(len(order), dtype=bool)
            again[order[1:]] = (run[order[1:]] == run[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(piece.first, piece.rows).take(pa.array(text)), pa.array(run.view(np.int64)),
                pa.array((one - at[text]).astype(np.int32)), pa.array((two - at[text]).astype(np.int32)),
                pa.array(again)], names=["id", "run", "first", "last", "again"])


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows id, text, firsts, lasts (arrays of sentences to remove): the text that is left."""
    for batch in batches:
        for piece in flat.pieces(batch.column(1)):
            words, first, at = sentences(piece)
            total = np.diff(at)
            lost = np.zeros(len(first) + 1, dtype=np.int64)
            part = batch.slice(piece.first, piece.rows)
            for column, step, shift in ((2, 1, 0), (3, -1, 1)):
                listed = part.column(column)
                own = pc.list_parent_indices(listed).to_numpy(zero_copy_only=False)
                place = at[own] + listed.flatten().to_numpy(zero_copy_only=False) + shift
                np.add.at(lost, np.minimum(place, at[own + 1]), step)  # texts may share an id
            gone = np.cumsum(lost)[:len(first) - 1] > 0
            number = np.concatenate(([0], np.cumsum(gone)))
            # a sentence reaches to the next one of its text
            starts = words.start[first[:-1]] if len(first) > 1 else np.zeros(0, dtype=np.int64)
            own = np.searchsorted(at, np.arange(len(starts)), "right") - 1
            starts = np.where(np.arange(len(starts)) == at[own], piece.offsets[own], starts)
            ends = np.append(starts[1:], len(piece.data))[:len(starts)]
            ends = np.minimum(ends, piece.offsets[own + 1])
            edge = np.zeros(len(piece.data) + 1, dtype=np.int64)
            np.add.at(edge, starts[gone], 1)
            np.add.at(edge, ends[gone], -1)
            keep = np.cumsum(edge[:-1]) == 0
            kept = np.concatenate(([0], np.cumsum(keep)))[piece.offsets].astype(np.int64)
            left = pa.LargeStringArray.from_buffers(
                piece.rows, pa.py_buffer(kept), pa.py_buffer(piece.data[keep].tobytes())).cast(pa.string())
            left = pc.if_else(part.column(1).is_null(), pa.scalar(None, pa.string()), left)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(total.astype(np.int64)),
                pa.array((number[at[1:]] - number[at[:-1]]).astype(np.int64)), left,
            ], names=["id", "n_sentences", "n_removed", "text"])


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_sentences, n_removed and the text that is left, of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    found = cut(texts.mapInArrow(run_batches, f"id {kind}, run bigint, first int, last int, again boolean"), "runs")
    shared = cut(found.where("not again").groupBy("run").agg(
        F.min("id").alias("owner"), F.count(F.lit(1)).alias("places")).where("places > 1").select("run", "owner"), "shared-runs")
    spans = found.join(shared, "run").where(~F.col("id").eqNullSafe(F.col("owner"))).select("id", "first", "last").unionAll(
        found.where("again").select("id", "first", "last")).distinct()
    lost = cut(spans.groupBy("id").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")), "lost-sentences")
    none = F.array().cast("array<int>")
    t, l = texts.alias("t"), lost.alias("l")
    return t.join(l, F.col("t.id").eqNullSafe(F.col("l.id")), "left").select(
        "t.id", "t.text", F.coalesce("firsts", none).alias("firsts"), F.coalesce("lasts", none).alias("lasts"),
    ).mapInArrow(cut_batches, f"id {kind}, n_sentences bigint, n_removed bigint, text string").withColumnRenamed("id", id_column)
