"""Removal of byte strings that stand in an earlier document, by a hash-compared suffix sort.

A byte goes if a SPAN-byte string that covers it also starts in a document with a smaller
id. All windows of SPAN bytes of all texts are decided, each exactly once:

1. Every window belongs to its anchor, the GRAM bytes in it with the smallest hash. Windows
   with the same anchor follow each other; together they are one stretch of bytes. Equal
   windows have equal anchors at equal places, so only stretches with equal anchors have to
   meet. Slim entries (hash of anchor and stretch, id, place) are dealt to buckets by anchor;
   a stretch that also stands in an earlier text of the same piece is decided there and not
   sent, so a passage of a third of all texts costs one entry per piece.
2. In a bucket, equal stretches are decided: all but those of the smallest id go. Different
   stretches of one anchor in different texts that agree for MARGIN bytes on a side where both
   reach so far may still have windows in common; of these the smallest id sends its bytes on.
3. The windows of these stretches are suffixes. Those with the same anchor at the same place
   and the same hash of their first HEAD bytes are sorted together: a merge sort whose comparisons find the common
   extension of two suffixes by binary search over prefix polynomial hashes. Neighbours with a common extension of SPAN bytes are verified byte by
   byte, and of equal windows all but those of the smallest id go. Anchors with more than
   HOT stretches send single windows, dealt by their hash.
4. The ranges of each document are cut from its text.

Ids are integers. Nulls: a null text is empty, a row with a null id neither removes nor
loses anything. Rows that share an id never remove from each other; they share the ranges
found for the id, cut to each text. An empty table gives an empty result. Other columns are
not looked at. Memory follows the longest text and a bucket of about BUCKET bytes of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship

ship(__name__)

SPAN = 50
GRAM = 12
REACH = SPAN - GRAM + 1  # anchors a window chooses from
MARGIN = (SPAN - GRAM) // 2
HEAD = SPAN // 2
HOT = 4096
BUCKET = 1 << 23
ENTRY = np.dtype([("anchor", "<u8"), ("stretch", "<u8"), ("left", "<u2"), ("right", "<u2"), ("id", "<i8"),
                  ("start", "<i4"), ("size", "<i4"), ("offset", "<i4"), ("text", "<i4")])


def smallest(keys: np.ndarray, reach: int) -> np.ndarray:
    """The minimum of each ``reach`` consecutive keys."""
    width = 1
    while 2 * width <= reach:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = reach - width
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


def stretches(piece: flat.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, first byte, end and anchor of every stretch of a piece, and the prefix hashes."""
    prefix = flat.prefix_hashes(piece.data, flat.BYTES)
    none = np.zeros(0, dtype=np.int64)
    if len(piece.data) < SPAN:
        return none, none, none, none, prefix
    count = len(piece.data) - GRAM + 1
    grams = flat.mix((prefix[GRAM:] - prefix[:-GRAM]) * flat.POWERS.down[:count])
    bits = np.uint64(max(1, int(count).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    chosen = (smallest((grams & ~low) | np.arange(count, dtype=np.uint64), REACH) & low).astype(np.int64)
    window = np.arange(len(chosen))
    text = np.searchsorted(piece.offsets, window, "right") - 1
    inside = window + SPAN <= piece.offsets[text + 1]
    window, chosen, text = window[inside], chosen[inside], text[inside]
    if not len(window):
        return none, none, none, none, prefix
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(window)) - 1
    return text[at], window[at], window[last] + SPAN, chosen[at], prefix


def entries(piece: flat.Piece, ids: np.ndarray) -> np.ndarray:
    text, start, end, anchor, prefix = stretches(piece)
    out = np.zeros(len(text), dtype=ENTRY)
    first, last = piece.offsets[text], piece.offsets[text + 1]
    out["anchor"] = flat.mix(flat.range_hashes(prefix, anchor, anchor + GRAM) + np.uint64(GRAM))
    shape = (anchor - start).astype(np.uint64) * np.uint64(1 << 20) + (end - start).astype(np.uint64)
    out["stretch"] = flat.mix(flat.range_hashes(prefix, start, end) ^ flat.mix(shape + flat.ODD))
    for name, one, two in (("left", np.maximum(anchor - MARGIN, first), anchor),
                           ("right", anchor + GRAM, np.minimum(anchor + GRAM + MARGIN, last))):
        side = flat.mix(flat.range_hashes(prefix, one, two) + (two - one).astype(np.uint64))
        out[name] = (side & np.uint64(0xFFFF)).astype(np.uint16)
    out["id"], out["start"], out["size"] = ids[text], start - first, end - start
    out["offset"], out["text"] = anchor - start, text
    return out


def ranges(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching ranges of each id become one."""
    order = np.lexsort((start, ids))
    ids, start, end = ids[order], start[order], end[order]
    if not len(ids):
        return ids, start, end
    change = np.concatenate(([True], ids[1:] != ids[:-1]))
    # ends so far within the id: shift each id beyond all ends of the one before
    shift = np.cumsum(change).astype(np.int64) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate(([True], (start + shift)[1:] > reach[:-1])) | change
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(ids)) - 1
    return ids[at], start[at], (reach - shift)[last]


ROWS = "bucket int, kind int, payload binary, id bigint, start int, end int"
NAMES = ["bucket", "kind", "payload", "id", "start", "end"]


def range_rows(ids, start, end) -> pa.RecordBatch:
    """Ranges on their way through the buckets; they are spread by id."""
    ids, start, end = ranges(ids, start.astype(np.int64), end.astype(np.int64))
    return pa.RecordBatch.from_arrays([
        pa.array((flat.mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(0x3FFFFFFF)).astype(np.int32)),
        pa.array(np.zeros(len(ids), np.int32)), pa.nulls(len(ids), pa.binary()), pa.array(ids),
        pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=NAMES)


def bytes_of(values: np.ndarray, width: int) -> np.ndarray:
    """A row of bytes for each value."""
    return np.frombuffer(np.ascontiguousarray(values).tobytes(), "u1").reshape(len(values), width)


def pack(part: np.ndarray) -> bytes:
    """Entries as compressed columns: hashes to 40 bits, ids and places as differences."""
    columns = [np.frombuffer(part[name].tobytes(), "u1").reshape(len(part), 8)[:, 3:] for name in ("anchor", "stretch")]
    ids = np.diff(part["id"], prepend=0)
    start = part["start"] - np.where(ids == 0, np.concatenate(([0], part["start"][:-1])), 0)
    plain = b"".join([*(c.tobytes() for c in columns), part["left"].tobytes(), part["right"].tobytes()])
    small = b"".join([*(c.T.tobytes() for c in (bytes_of(ids, 8), bytes_of(start.astype("<i4"), 4))),
                      (part["size"] - SPAN).astype("u1").tobytes(), part["offset"].astype("u1").tobytes()])
    packed = pa.compress(small, codec="zstd", asbytes=True)
    return len(part).to_bytes(4, "little") + plain + packed


def unpack(payload: bytes) -> np.ndarray:
    count = int.from_bytes(payload[:4], "little")
    out = np.zeros(count, dtype=ENTRY)
    at = 4
    for name in ("anchor", "stretch"):
        wide = np.zeros((count, 8), dtype="u1")
        wide[:, 3:] = np.frombuffer(payload, "u1", 5 * count, at).reshape(count, 5)
        out[name] = wide.reshape(-1).view("<u8")
        at += 5 * count
    for name in ("left", "right"):
        out[name] = np.frombuffer(payload, "<u2", count, at)
        at += 2 * count
    small = np.frombuffer(pa.decompress(payload[at:], 14 * count, codec="zstd", asbytes=True), "u1").reshape(14, count)
    ids = np.ascontiguousarray(small[:8].T).reshape(-1).view("<i8")
    out["id"] = np.cumsum(ids)
    start = np.ascontiguousarray(small[8:12].T).reshape(-1).view("<i4").astype(np.int64)
    run = np.flatnonzero(np.concatenate(([True], ids[1:] != 0)))
    total = np.cumsum(start)
    before = np.repeat(total[run] - start[run], np.diff(np.append(run, count)))
    out["start"] = total - before
    out["size"], out["offset"] = small[12].astype(np.int32) + SPAN, small[13]
    return out


def agreeing(piece: flat.Piece, found: np.ndarray, keeper: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whether the bytes of the asked stretches are those of their keepers, which have the same hashes."""
    out = np.ones(len(found), dtype=bool)
    at = np.flatnonzero(asked)
    first = piece.offsets[found["text"]] + found["start"]
    for part in np.array_split(at, -(-len(at) // (1 << 15))) if len(at) else ():
        size = found["size"][part].astype(np.int64)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        one, two = np.repeat(first[part], size) + step, np.minimum(np.repeat(first[keeper[part]], size) + step, len(piece.data) - 1)
        same = piece.data[one] == piece.data[two]
        out[part] = np.logical_and.reduceat(same, np.cumsum(size) - size) & (found["size"][keeper[part]] == size)
    return out


def indexing(buckets: int):
    """id, text become packed entries by bucket, and ranges decided within a piece."""
    def index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in flat.pieces(batch.column(1)):
                ids = batch.column(0).slice(piece.first, piece.rows).to_numpy(zero_copy_only=False)
                found = entries(piece, ids)
                order = np.lexsort((found["id"], found["stretch"], found["anchor"]))
                found = found[order]
                same = np.concatenate(([False], (found["stretch"][1:] == found["stretch"][:-1])
                                       & (found["anchor"][1:] == found["anchor"][:-1])))
                head = np.flatnonzero(~same)
                least = np.repeat(found["id"][head], np.diff(np.append(head, len(found))))
                later = found["id"] > least
                keeper = np.repeat(head, np.diff(np.append(head, len(found))))
                agree = agreeing(piece, found, keeper, later)
                # equal hashes of different bytes: no longer equal, the sort decides
                found["stretch"][~agree] ^= flat.mix(np.flatnonzero(~agree).astype(np.uint64) + flat.ODD)
                later &= agree
                gone = found[later]
                if len(gone):
                    yield range_rows(gone["id"], gone["start"], gone["start"] + gone["size"])
                found = found[~later]
                bucket = ((found["anchor"] >> np.uint64(16)) % np.uint64(buckets)).astype(np.int32)
                order = np.lexsort((found["start"], found["id"], bucket))
                found, bucket = found[order], bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                end = np.append(at[1:], len(found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[at]), pa.array(np.ones(len(at), np.int32)),
                    pa.array([pack(found[a:b]) for a, b in zip(at, end)], pa.binary()), pa.nulls(len(at), pa.int64()),
                    pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int32())], names=NAMES)
    return index_batches


OUT = "id bigint, start int, end int, anchor bigint, offset int, peers int"
OUT_NAMES = ["id", "start", "end", "anchor", "offset", "peers"]


def decided(ids, start, end) -> pa.RecordBatch:
    ids, start, end = ranges(ids, start.astype(np.int64), end.astype(np.int64))
    none = pa.nulls(len(ids), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.array(ids), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), none,
        none.cast(pa.int32()), none.cast(pa.int32())], names=OUT_NAMES)


def settle(found: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One bucket: equal stretches are decided, those that may share windows are asked for."""
    found = found[np.lexsort((found["start"], found["id"], found["stretch"], found["anchor"]))]
    anchor = np.concatenate(([True], found["anchor"][1:] != found["anchor"][:-1]))
    equal = np.concatenate(([True], found["stretch"][1:] != found["stretch"][:-1])) | anchor
    head = np.flatnonzero(equal)
    number = np.cumsum(equal) - 1
    later = found["id"] > found["id"][head][number]
    gone = found[later]
    yield decided(gone["id"], gone["start"], gone["start"] + gone["size"])
    found, number = found[~later], number[~later]
    group = np.cumsum(np.concatenate(([True], found["anchor"][1:] != found["anchor"][:-1]))) - 1
    open_ = np.zeros(len(found), dtype=bool)
    # another stretch of the anchor, in another text, agrees on this side; of SPAN bytes in common
    # one side has MARGIN at least, so a stretch that ends before has none in common that way
    reach = {"left": found["offset"], "right": found["size"] - GRAM - found["offset"]}
    for side in ("left", "right"):
        far = np.flatnonzero(reach[side] >= MARGIN)
        key = group[far].astype(np.int64) * 65536 + found[side][far]
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.diff(key[order], prepend=-1))
        several = np.ones(len(at), dtype=bool)
        for own in (number[far[order]], found["id"][far[order]]):
            several &= np.maximum.reduceat(own, at) != np.minimum.reduceat(own, at) if len(at) else False
        open_[far[order]] |= np.repeat(several, np.diff(np.append(at, len(order))))
    asked = found[open_]
    peers = np.bincount(group[open_], minlength=int(group.max()) + 1 if len(group) else 0)[group[open_]]
    yield pa.RecordBatch.from_arrays([
        pa.array(asked["id"]), pa.array(asked["start"]), pa.array(asked["start"] + asked["size"]),
        pa.array(asked["anchor"].view(np.int64)), pa.array(asked["offset"]), pa.array(peers.astype(np.int32))],
        names=OUT_NAMES)


def bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: ranges pass, the entries of a bucket are settled together."""
    bucket, held = None, []
    for batch in batches:
        kind = batch.column(1).to_numpy()
        passing = batch.filter(pa.array(kind == 0))
        if passing.num_rows:
            yield decided(*(passing.column(i).to_numpy() for i in (3, 4, 5)))
        sent = batch.filter(pa.array(kind == 1))
        for own, payload in zip(sent.column(0).to_pylist(), sent.column(2)):
            if own != bucket and held:
                yield from settle(np.concatenate(held))
                held = []
            bucket = own
            held.append(unpack(payload.as_buffer().to_pybytes()))
    if held:
        yield from settle(np.concatenate(held))


def same_windows(data: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether SPAN bytes agree at each pair of places."""
    step = np.arange(SPAN)
    return (data[one[:, None] + step] == data[two[:, None] + step]).all(axis=1)


def fetch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, asked (start, end, anchor, offset, peers) become stretches, or single windows
    where an anchor has many: anchor, slice, id, start, offset (the anchor's place), bytes."""
    for batch in batches:
        for piece in flat.pieces(batch.column(1)):
            part = batch.slice(piece.first, piece.rows)
            asked = part.column(2)
            row = pc.list_parent_indices(asked).to_numpy(zero_copy_only=False)
            start, end, anchor, offset, peers = (c.to_numpy(zero_copy_only=False) for c in asked.flatten().flatten())
            ids = part.column(0).to_numpy()[row]
            start, end = start.astype(np.int64), end.astype(np.int64)
            fits = piece.offsets[row] + end <= piece.offsets[row + 1]
            ids, row, start, end, anchor, offset, peers = (c[fits] for c in (ids, row, start, end, anchor, offset, peers))
            hot = peers > HOT
            count = np.where(hot, end - start - SPAN + 1, 1)
            own = np.repeat(np.arange(len(ids)), count)
            step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            first = start[own] + step
            size = np.where(hot[own], SPAN, (end - start)[own])
            at = piece.offsets[row[own]] + first
            piece_slice = np.zeros(len(own), dtype=np.int32)
            if hot.any():
                prefix = flat.prefix_hashes(piece.data, flat.BYTES)
                many = hot[own]
                hashes = flat.mix(flat.range_hashes(prefix, at[many], at[many] + SPAN))
                piece_slice[many] = 1 + (hashes % (peers[own][many] // HOT * 16 + 16).astype(np.uint64)).astype(np.int32)
                # of equal windows in a piece only those of the smallest id go on, the others go
                order = np.lexsort((ids[own][many], hashes))
                new = np.concatenate(([True], np.diff(hashes[order]) != 0))
                keeper = order[np.flatnonzero(new)][np.cumsum(new) - 1]
                later = ids[own][many][order] > ids[own][many][keeper]
                mine, kept = at[many][order[later]], at[many][keeper[later]]
                agree = np.concatenate([np.zeros(0, dtype=bool), *(same_windows(piece.data, mine[a:a + (1 << 15)], kept[a:a + (1 << 15)])
                                                                   for a in range(0, len(mine), 1 << 15))])
                piece_slice[np.flatnonzero(many)[order[later][agree]]] = -1
            bounds = np.concatenate(([0], np.cumsum(size)))
            spots = np.repeat(at - bounds[:-1], size) + np.arange(bounds[-1])
            held = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(own), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(piece.data[spots].tobytes())])
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor[own]), pa.array(piece_slice), pa.array(ids[own]), pa.array(first.astype(np.int32)),
                pa.array((offset[own] - step).astype(np.int32)), held.cast(pa.binary())],
                names=["anchor", "slice", "id", "start", "offset", "bytes"])


class Suffixes:
    """Suffixes of a byte array, compared over at most SPAN bytes by hashes of their prefixes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.prefix = flat.prefix_hashes(data, flat.BYTES)

    def extension(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes have in common, SPAN at most, by binary search."""
        low, high = np.zeros(len(one), dtype=np.int64), np.full(len(one), SPAN, dtype=np.int64)
        for _ in range(SPAN.bit_length()):
            middle = (low + high + 1) // 2
            same = flat.range_hashes(self.prefix, one, one + middle) == flat.range_hashes(self.prefix, two, two + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, one: np.ndarray, two: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether a suffix comes before another; equal ones as ``ties`` says."""
        common = self.extension(one, two)
        next_ = np.minimum(common, SPAN - 1)
        return np.where(common == SPAN, ties, self.data[one + next_] < self.data[two + next_])

    def sorted(self, suffix: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of suffixes within each group (equal numbers side by side): merge sort of all groups at once."""
        size = np.bincount(group)
        first = np.cumsum(size) - size
        order = np.arange(len(suffix))
        width = 1
        while width < (size.max() if len(size) else 0):
            active = np.flatnonzero((size > width)[group])
            own_group = group[active]
            place = active - first[own_group]
            left = place // width % 2 == 0
            run = place // width * width
            other = np.where(left, run + width, run - width)
            low = np.minimum(other, size[own_group]) + first[own_group]
            high = np.minimum(other + width, size[own_group]) + first[own_group]
            base, mine = low.copy(), suffix[order[active]]
            while True:
                searching = np.flatnonzero(low < high)
                if not len(searching):
                    break
                middle = (low[searching] + high[searching]) // 2
                # how many of the other run come before mine: equal ones only if that run is the left one
                ahead = self.before(suffix[order[middle]], mine[searching], ~left[searching])
                low[searching] = np.where(ahead, middle + 1, low[searching])
                high[searching] = np.where(ahead, high[searching], middle)
            target = first[own_group] + np.minimum(run, np.where(left, run, other)) + (place - run) + (low - base)
            merged = order.copy()
            merged[target] = order[active]
            order = merged
            width *= 2
        return order


def several(keys: np.ndarray) -> np.ndarray:
    """Which of the sorted keys occur more than once."""
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[1:] == keys[:-1]
    return same[1:] | same[:-1]


def sort_windows(keys: list[np.ndarray], ids: np.ndarray, start: np.ndarray, offset: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    """Whole groups of stretches (equal keys side by side): ranges of windows that an earlier id has too.

    Equal windows have their anchor at the same place and begin alike, so only windows that
    agree in both are sorted together.
    """
    flat_texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(flat_texts.buffers()[1], np.int64)[flat_texts.offset:flat_texts.offset + len(texts) + 1]
    data = np.frombuffer(flat_texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    change = np.zeros(len(ids), dtype=bool)
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    group = np.cumsum(change)
    count = np.diff(offsets) - SPAN + 1
    own = np.repeat(np.arange(len(ids)), count)
    step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    place = group[own].astype(np.int64) * REACH + (offset[own] - step)
    suffix = offsets[own] + step
    suffixes = Suffixes(data)
    place = flat.mix(place.astype(np.uint64)) ^ flat.mix(flat.range_hashes(suffixes.prefix, suffix, suffix + HEAD) + flat.ODD)
    order = np.argsort(place, kind="stable")
    order = order[several(place[order])]  # a window alone in its group has no equal
    own, step, suffix, place = own[order], step[order], suffix[order], place[order]
    place = np.cumsum(np.concatenate(([0], place[1:] != place[:-1]))) if len(place) else place.astype(np.int64)
    order = suffixes.sorted(suffix, place)
    own, step, suffix = own[order], step[order], suffix[order]
    hashed = np.zeros(len(own), dtype=bool)
    near = 1 + np.flatnonzero(place[1:] == place[:-1])
    hashed[near] = suffixes.extension(suffix[near], suffix[near - 1]) == SPAN
    # collisions: equal neighbours have to agree byte by byte
    for at in range(0, len(own), 1 << 16):
        chosen = at + np.flatnonzero(hashed[at:at + (1 << 16)])
        hashed[chosen] = same_windows(data, suffix[chosen], suffix[chosen - 1])
    head = np.flatnonzero(~hashed)
    least = np.minimum.reduceat(ids[own], head) if len(head) else ids[:0]
    gone = ids[own] > np.repeat(least, np.diff(np.append(head, len(own))))
    begin = start[own[gone]].astype(np.int64) + step[gone]
    return decided(ids[own[gone]], begin, begin + SPAN)


def window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows anchor, slice, id, start, offset, bytes, sorted by anchor and slice."""
    held: list[pa.RecordBatch] = []

    def work() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        anchor, part, ids, start, offset = (table.column(i).to_numpy() for i in range(5))
        texts = table.column(5).combine_chunks()
        return sort_windows([anchor, part], ids, start, offset, texts)

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        last = (anchor == anchor[-1]) & (part == part[-1])
        done = int(np.argmax(last))
        if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (anchor[0], part[0]) or done:
            held.append(batch.slice(0, done))
            yield work()
            held = []
        held.append(batch.slice(done))
    if held:
        yield work()


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, starts, ends become id, n_bytes, n_removed, n_spans, kept_sha256 and the text left."""
    for batch in batches:
        for piece in flat.pieces(batch.column(1)):
            part = batch.slice(piece.first, piece.rows)
            row = pc.list_parent_indices(part.column(2)).to_numpy(zero_copy_only=False)
            start = piece.offsets[row] + part.column(2).flatten().to_numpy(zero_copy_only=False)
            end = piece.offsets[row] + part.column(3).flatten().to_numpy(zero_copy_only=False)
            limit = piece.offsets[row + 1]
            edge = np.zeros(len(piece.data) + 1, dtype=np.int32)
            np.add.at(edge, np.minimum(start, limit), 1)
            np.add.at(edge, np.minimum(end, limit), -1)
            gone = np.cumsum(edge[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(gone)))
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            firsts = piece.offsets[:-1][piece.offsets[:-1] < len(gone)]
            begin[firsts] = gone[firsts]
            spans = np.concatenate(([0], np.cumsum(begin)))
            kept = piece.data[~gone].tobytes()
            bounds = piece.offsets - total[piece.offsets]
            left = [kept[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(np.diff(piece.offsets)), pa.array(np.diff(total[piece.offsets])),
                pa.array(np.diff(spans[piece.offsets])), pa.array([hashlib.sha256(k).hexdigest() for k in left]),
                pa.array(left, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def squeeze_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the way through a shuffle."""
    for batch in batches:
        size, held = [], []
        for text in batch.column(1).cast(pa.large_binary()):
            raw = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
            size.append(len(raw))
            held.append(pa.compress(raw, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(held, pa.binary())], names=["id", "size", "squeezed"])


def spread(work):
    """``work`` on batches id, size, squeezed, ... as if on id, text, ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            at = 0
            while at < batch.num_rows:  # a few megabytes of text at a time
                upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 4 * flat.PIECE, "right")))
                part = batch.slice(at, upto - at)
                texts = [pa.decompress(held.as_buffer(), int(size), codec="zstd", asbytes=True) if size else b""
                         for held, size in zip(part.column(2), sizes[at:upto])]
                column = pa.array(texts, pa.large_binary()).view(pa.large_string())
                names = ["id", "text", *batch.schema.names[3:]]
                yield from work(iter([pa.RecordBatch.from_arrays(
                    [part.column(0), column, *(part.column(i) for i in range(3, part.num_columns))], names=names)]))
                at = upto
    return run


def repeated_ranges(texts: DataFrame, buckets: int) -> DataFrame:
    """id, start, end of byte ranges that an earlier document has too (id and text not null)."""
    met = texts.mapInArrow(indexing(buckets), ROWS)
    settled = cut(met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(bucket_batches, OUT), "settled")
    asked = settled.where("anchor is not null").groupBy("id").agg(
        F.collect_list(F.struct("start", "end", "anchor", "offset", "peers")).alias("asked"))
    squeezed = texts.mapInArrow(squeeze_batches, "id bigint, size bigint, squeezed binary")
    fetched = squeezed.join(asked, "id").select("id", "size", "squeezed", "asked").mapInArrow(
        spread(fetch_batches), "anchor bigint, slice int, id bigint, start int, offset int, bytes binary")
    fetched = cut(fetched, "stretches", compression="zstd")
    windows = fetched.where("slice >= 0").repartition("anchor", "slice").sortWithinPartitions("anchor", "slice").mapInArrow(
        window_batches, OUT)
    alike = fetched.where("slice < 0").select("id", "start", (F.col("start") + SPAN).alias("end"))
    return settled.where("anchor is null").select("id", "start", "end").unionAll(
        windows.select("id", "start", "end")).unionAll(alike)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of every row."""
    texts = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    lost = cut(repeated_ranges(texts.where("id is not null"), max(1, -(-size // BUCKET))).groupBy("id").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")), "ranges")
    none = F.array().cast("array<int>")
    squeezed = texts.mapInArrow(squeeze_batches, "id bigint, size bigint, squeezed binary")
    return squeezed.join(lost, "id", "left").select(
        "id", "size", "squeezed", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"),
    ).mapInArrow(spread(cut_batches), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
                 ).withColumnRenamed("id", id_column)
