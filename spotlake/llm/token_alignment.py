"""Alignment of the tokens of two tokenizers, all documents of a batch in lockstep.

1. A task encodes its texts with both tokenizers; the byte-level one by its merge ranks where the
   text is plain Latin-1, as that gives the same ids in a quarter of the time. Tokens become byte ranges; a document whose
   tokens of either kind do not spell its bytes has no tokens. One NumPy state vector holds an
   A pointer and a B pointer for every document of the piece. Each step emits one link per
   document (the ranges at its two pointers overlap), emits a cut where both tokens end
   together, and advances the pointer whose token ends first, or both. Finished documents are
   compacted away. Documents of more than SEGMENT tokens enter as several rows of the state
   vector, parted where both tokenizers end, so steps are bounded by SEGMENT, not by a text.
2. The results of about BLOCK bytes of text are one row: the figures of its documents, the
   distinct id pairs, and each document's pairs as places among them with their counts.
3. The pairs of all blocks are summed to the number of documents that hold them, and marked
   where that is the highest of their A id.
4. Totals go back to the blocks that asked for them, one row per block and distinct pair, and
   each block sums them over its documents' links.

Nothing is sent to the driver or broadcast. Tokenizer files are read by every task from
``files``, a folder that all executors have.

Nulls: a null text is empty; an empty text has no tokens, zeros and an empty hash. A null id
is kept like any other. Repeated rows are aligned one by one, and each counts as a document.
An empty table gives an empty result. Other columns are not looked at. Memory follows BLOCK
and the longest text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship

ship(__name__)

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
SEGMENT = 256
SEARCH = 64  # tokens behind a segment's end among which a common end is looked for
PART = 1 << 18  # bytes of text encoded at once
BLOCK = 1 << 21
LONG_RUN, LONG_GAP = 2000, 500  # bytes of a word and of white space between words that plain texts stay under
#: How byte-level vocabularies part a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
B_BITS = 16  # of a pair's code, for the B id


def default_files() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path(A_FILE))


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others for code points from 256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def number_table(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to ``count`` - 1, left aligned with a place behind, and their lengths."""
    texts = [str(n) for n in range(count)]
    width = len(texts[-1]) + 1
    digits = np.frombuffer("".join(t.ljust(width) for t in texts).encode(), np.uint8).reshape(count, width)
    return digits, np.array([len(t) for t in texts])


#: Space for white space, ``x`` for any other byte of Latin-1.
SHAPE = bytes(32 if b in (9, 10, 11, 12, 13, 32, 0x85, 0xA0) else 120 for b in range(256))


def is_plain(text: str) -> bool:
    """Whether both libraries surely agree: Latin-1, without very long words or gaps.

    Letters of later Unicode versions may be known to one library only.
    """
    try:
        shape = text.encode("latin-1").translate(SHAPE)
    except UnicodeEncodeError:
        return False
    return b"x" * LONG_RUN not in shape and b" " * LONG_GAP not in shape


class Tokenizers:
    """Both tokenizers and the bytes of their ids."""

    def __init__(self, files: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(f"{files}/{A_FILE}")
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=f"{files}/{B_FILE}")
        letters = byte_letters()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda item: item[1])
        self.a_bytes = [b""] * (names[-1][1] + 1)
        for name, number in names:
            self.a_bytes[number] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.b_bytes = [piece_bytes(self.b.id_to_piece(n)) for n in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # the same ids by a faster library; an id is the rank of its merge, special ones are no merges
        import tiktoken

        special = {t for t, token in self.a.get_added_tokens_decoder().items() if token.special}
        self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            x: n for n, x in enumerate(self.a_bytes) if n not in special})
        self.digits, self.length = number_table(max(len(self.a_bytes), len(self.b_bytes)))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of every text; none for both where either does not spell space and text."""
        none = np.zeros(0, dtype=np.int64)
        out = []
        plain = list(map(is_plain, texts))
        others = iter(self.a.encode_batch_fast([" " + t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        for text, p, b in zip(texts, plain, self.b.encode(texts, num_threads=1)):
            a = self.ranks.encode_ordinary(" " + text) if p else next(others).ids
            raw = b" " + text.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) if same else (none, none))
        return out


def segments(a_end: np.ndarray, b_end: np.ndarray) -> tuple[list[int], list[int]]:
    """Where the segments of a document begin among its A and its B tokens."""
    a_first, b_first, at = [0], [0], SEGMENT
    while at < len(a_end):
        near = a_end[at:at + SEARCH]
        place = np.searchsorted(b_end, near)
        common = np.flatnonzero(b_end[np.minimum(place, len(b_end) - 1)] == near)
        if len(common):
            a, b = at + int(common[0]) + 1, int(place[common[0]]) + 1
            if a < len(a_end):
                a_first.append(a)
                b_first.append(b)
            at = a + SEGMENT
        else:
            at += SEARCH
    return a_first, b_first


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_at: np.ndarray, a_to: np.ndarray, b_at: np.ndarray):
    """Links and cuts of rows that start at the pointers ``a_at``, ``b_at`` and are over at ``a_to``.

    Both token kinds of a row cover the same bytes. Returns the A and the B place of every
    link, and whether each A token and each B token is the last of its group.
    """
    a_last, b_last = np.zeros(len(a_end), dtype=bool), np.zeros(len(b_end), dtype=bool)
    a_links, b_links = [], []
    going = a_at < a_to
    i, j, to = a_at[going], b_at[going], a_to[going]
    while len(i):
        a_links.append(i)
        b_links.append(j)
        one, two = a_end[i], b_end[j]
        cuts = one == two
        a_last[i[cuts]] = True
        b_last[j[cuts]] = True
        i, j = i + (one <= two), j + (two <= one)
        going = i < to
        if not going.all():  # finished rows leave
            i, j, to = i[going], j[going], to[going]
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(a_links or none), np.concatenate(b_links or none), a_last, b_last


def group_texts(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, at: np.ndarray,
                digits: np.ndarray, length: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of every document, as one byte array with its bounds (a ``;`` ends each)."""
    a_group = np.cumsum(a_last) - a_last
    b_group = np.cumsum(b_last) - b_last
    a_place = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
    b_place = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
    ids = np.zeros(len(a) + len(b), dtype=np.int64)
    mark = np.full(len(ids), ord(","), dtype=np.uint8)
    ids[a_place], ids[b_place] = a, b
    mark[a_place[a_last]], mark[b_place[b_last]] = ord("|"), ord(";")
    size = length[ids]
    held = digits[ids]
    held[np.arange(len(ids)), size] = mark
    ends = np.concatenate(([0], np.cumsum(size + 1)))
    return held[np.arange(held.shape[1]) <= size[:, None]].tobytes(), ends[at]


class Block:
    """Results of consecutive pieces, on their way to one row."""

    def __init__(self):
        self.ids, self.hashes, self.figures, self.keys, self.counts, self.rows, self.size = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: list[str], size: int, both: Tokenizers) -> None:
        coded, part, held = [], [], 0
        for text in texts:  # a few at a time: encodings are many times larger than their texts
            part.append(text)
            held += len(text)
            if held >= PART:
                coded += both.encode(part)
                part, held = [], 0
        coded += both.encode(part) if part else []
        a_at = np.concatenate(([0], np.cumsum([len(a) for a, _ in coded])))
        b_at = np.concatenate(([0], np.cumsum([len(b) for _, b in coded])))
        a, b = np.concatenate([a for a, _ in coded]), np.concatenate([b for _, b in coded])
        a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])  # documents cover the same bytes in both
        a_from, b_from = [], []
        for n in range(len(coded)):
            more_a, more_b = segments(a_end[a_at[n]:a_at[n + 1]], b_end[b_at[n]:b_at[n + 1]])
            a_from += [int(a_at[n]) + x for x in more_a]
            b_from += [int(b_at[n]) + x for x in more_b]
        a_from = np.array(a_from, dtype=np.int64)
        link_a, link_b, a_last, b_last = lockstep(
            a_end, b_end, a_from, np.append(a_from[1:], len(a)), np.array(b_from, dtype=np.int64))
        document = np.searchsorted(a_at, link_a, "right") - 1
        figures = np.zeros((len(coded), 4), dtype=np.int64)
        figures[:, 0], figures[:, 1] = np.diff(a_at), np.diff(b_at)
        figures[:, 2] = np.diff(np.concatenate(([0], np.cumsum(a_last)))[a_at])
        figures[:, 3] = np.bincount(document, minlength=len(coded))
        spelled, bounds = group_texts(a, b, a_last, b_last, a_at + b_at, both.digits, both.length)
        self.hashes += [hashlib.sha256(spelled[x:y - 1]).hexdigest() if y > x else ""
                        for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        key = ((self.rows + document) << 2 * B_BITS) | (a[link_a] << B_BITS) | b[link_b]
        keys, counts = np.unique(key, return_counts=True)
        self.ids.append(ids)
        self.figures.append(figures)
        self.keys.append(keys)
        self.counts.append(counts)
        self.rows += len(coded)
        self.size += size

    def batch(self, number: int) -> pa.RecordBatch:
        """block, ids, hashes, figures, and the pairs: distinct codes, documents of each, and per
        document how many it has, their places among the codes and how often each is linked."""
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        codes, place, documents = np.unique(keys & ((1 << 2 * B_BITS) - 1), return_inverse=True, return_counts=True)
        own = np.bincount(keys >> 2 * B_BITS, minlength=self.rows)
        binaries = [np.concatenate(self.figures).astype("<i8"), codes.astype("<i8"), documents.astype("<i4"),
                    own.astype("<i4"), place.astype("<i4"), counts.astype("<i4")]
        ids = pa.concat_arrays(self.ids)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([self.hashes], pa.list_(pa.string())),
            *(pa.array([flat.packed(x)], pa.binary()) for x in binaries)], names=NAMES)


NAMES = ["block", "ids", "hashes", "figures", "codes", "documents", "own", "places", "counts"]


def aligning(files: str, block: int):
    """id, text become blocks."""
    def align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, held = Tokenizers(files), Block()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column(1)
            for piece in flat.pieces(column):
                texts = [t or "" for t in column.slice(piece.first, piece.rows).to_pylist()]
                held.add(batch.column(0).slice(piece.first, piece.rows), texts, len(piece.data), both)
                if held.size >= block:
                    yield held.batch(number)
                    held, number = Block(), number + 1
        if held.rows:
            yield held.batch(number)
    return align_batches


def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, codes, documents: a row for each distinct pair of a block."""
    for batch in batches:
        for number, codes, documents in zip(*(batch.column(i) for i in range(3))):
            codes = np.frombuffer(codes.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(codes), number.as_py())), pa.array(codes),
                pa.array(np.frombuffer(documents.as_buffer(), "<i4").astype(np.int64))], names=["block", "code", "documents"])


def block_figures(block: pa.Table, totals: pa.Table) -> pa.Table:
    """One block and the totals of its pairs: the figures of its documents."""
    row = {name: block.column(name)[0] for name in block.column_names}
    of = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)
    own, places, counts = of("own", "<i4"), of("places", "<i4"), of("counts", "<i4").astype(np.int64)
    order = np.argsort(totals.column("code").to_numpy())  # as the block's codes are sorted
    total, best = totals.column("total").to_numpy()[order], totals.column("best").to_numpy()[order]
    sums = [np.concatenate(([0], np.cumsum(x))) for x in (counts * best[places], counts * total[places])]
    edge = np.concatenate(([0], np.cumsum(own)))
    figures = of("figures", "<i8").reshape(-1, 4)
    return pa.table([
        row["ids"].values, *(pa.array(np.ascontiguousarray(figures[:, i])) for i in range(4)),
        *(pa.array(np.diff(x[edge])) for x in sums), row["hashes"].values], names=FIGURES)


FIGURES = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned_blocks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", files: str | None = None, block: int = BLOCK,
) -> DataFrame:
    """The aligned documents in blocks, written to the shared scratch space."""
    kind = docs.schema[id_column].dataType.simpleString()
    columns = f"block bigint, ids array<{kind}>, hashes array<string>, " + ", ".join(f"{n} binary" for n in NAMES[3:])
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return cut(texts.mapInArrow(aligning(files or default_files(), block), columns), "aligned", compression="zstd")


def pair_totals(blocks: DataFrame) -> DataFrame:
    """a, b, total, best: in how many documents the ids are linked, and whether no other B id has more for ``a``."""
    pairs = blocks.select("block", "codes", "documents").mapInArrow(pair_batches, "block bigint, code bigint, documents bigint")
    totals = cut(pairs.groupBy("code").agg(F.sum("documents").alias("total")), "pair-totals").withColumn(
        "a", F.shiftright("code", B_BITS))
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    return totals.join(most, "a").select(
        "a", (F.col("code").bitwiseAND((1 << B_BITS) - 1)).alias("b"), "total", (F.col("total") == F.col("most")).alias("best"))


def token_alignment(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", files: str | None = None, block: int = BLOCK,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    blocks = aligned_blocks(docs, id_column, text_column, files, block)
    totals = cut(pair_totals(blocks), "pair-marks").select(
        (F.shiftleft("a", B_BITS) + F.col("b")).alias("code"), "total", F.col("best").cast("long").alias("best"))
    asked = blocks.select("block", "codes", "documents").mapInArrow(pair_batches, "block bigint, code bigint, documents bigint")
    answers = asked.select("block", "code").join(totals, "code").select("block", "code", "total", "best")
    figures = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        block_figures, f"id {kind}, " + ", ".join(f"{n} bigint" for n in FIGURES[1:-1]) + ", groups_sha256 string")
    return figures.withColumnRenamed("id", id_column)
