"""Jaccard join of whole texts on word shingles with signature trees.

Two documents link when their sets of distinct five-word shingles overlap by at least 75 %
(7 * common >= 3 * (size + size)). The result is the component of each document.

1. Every text becomes a set of 64-bit shingle hashes; kept are its size, a fingerprint, a
   token bitmap of two to four bits per shingle and the SKETCH smallest hashes. Documents
   with equal sets form one class.
2. Classes that share a sketch hash meet in a bucket. Linked classes share at least three
   quarters of their union, so the chance that they share none of the smallest hashes is
   0.25 ** 48, less than that of two texts having one hash; sets of up to SKETCH shingles
   meet surely. A hash of more than HOT classes is frequent content: only classes with more
   than a quarter of such hashes in their sketch meet there, as any other class shares a
   rarer hash with each of its partners (chance to miss: below 1e-12).
3. In each bucket every class is compared with the first one. This links large groups of
   near copies by as many pairs as they have members.
4. Buckets whose classes are not yet one component become signature trees: leaves are
   classes sorted by size, a node holds the OR of the bitmaps below it, their range of sizes
   and the most shingles that share a bit. Two trees, or a tree and itself, are traversed
   together; a pair of nodes goes on only if sizes and common bits allow the overlap and
   not all classes below are linked already. Buckets of more than BLOCK classes are cut
   into blocks, and each pair of blocks is a task's work of its own. Of the buckets with more
   than BIG classes that two classes share, only the one with the smallest hash reports them.
5. What is left is compared exactly, set by set, the likeliest pairs of each class first:
   links join components, and pairs within one need no comparison any more. The last round
   over the trees takes all pairs that are still left. All links together give the components.

Nulls: a null text is empty; empty texts link with nothing and are their own component; a
null id has no component and takes no part. Rows that share an id count as one document.
An empty table gives an empty result. Other columns are not looked at. Memory follows the
longest text, a batch of rows and two blocks of bitmaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotlake.llm import flat
from spotlake.llm.common import cut, ship
from spotlake.llm.components import components

ship(__name__)

SHINGLE = 5
SKETCH = 48
HOT = 256
BLOCK = 1024
BIG = 32
FAN = 8
CHUNK_BYTES = 1 << 24
#: Bytes of text that are hashed at once.
PIECE = 1 << 19
#: Pairs compared per class in each round over the trees; the last round has no limit.
ROUNDS = (2, None)


def shingle_sets(piece: flat.Piece) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a piece."""
    words = flat.words(piece)
    rank = flat.codes(SHINGLE)[:SHINGLE] | np.uint64(1)
    count = max(len(words.hashes) - SHINGLE + 1, 0)
    rolled = np.zeros(count, dtype=np.uint64)
    for place in range(SHINGLE):
        rolled += words.hashes[place:place + count] * rank[place]
    rolled = flat.mix(rolled)
    sets = []
    for first, last in zip(words.at[:-1].tolist(), words.at[1:].tolist()):
        if last - first >= SHINGLE:
            sets.append(np.unique(rolled[first:last - SHINGLE + 1]))
        else:  # the whole sequence is one shingle, none if there are no words
            few = words.hashes[first:last] * rank[:last - first]
            sets.append(flat.mix(few.sum(keepdims=True) + np.uint64(last - first))[:last - first])
    return sets


def width_of(size: int) -> int:
    """Bits of the bitmap for a set: a power of two, 2 to 4 per shingle, 256 at least."""
    return max(256, 1 << int(2 * size - 1).bit_length())


def bitmap(hashes: np.ndarray) -> bytes:
    bits = np.zeros(width_of(len(hashes)), dtype=np.uint8)
    bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in flat.pieces(batch.column(1), PIECE):
            sets = shingle_sets(piece)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            low = [s[:SKETCH] for s in sets]
            one, two = [], []
            for s in sets:
                spread = flat.mix(s + flat.ODD)
                one.append(int(spread.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(np.bitwise_xor.reduce(spread, initial=np.uint64(0)).view(np.int64)))
            bounds = np.concatenate(([0], np.cumsum([len(s) for s in low]))).astype(np.int32)
            values = np.concatenate(low).view(np.int64) if low else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(piece.first, piece.rows), pa.array(sizes), pa.array(one, pa.int64()),
                pa.array(two, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                pa.array([bitmap(s) for s in sets], pa.binary()),
            ], names=["id", "n", "print1", "print2", "sketch", "bits"])


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in flat.pieces(batch.column(1), PIECE):
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(piece.first, piece.rows),
                pa.array([s.tobytes() for s in shingle_sets(piece)], pa.binary())], names=["id", "hashes"])


def compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows a, b, set of a, set of b: keep the pairs that link."""
    for batch in batches:
        keep = []
        for one, two in zip(batch.column(2), batch.column(3)):
            left, right = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, two))
            place = np.searchsorted(left, right)
            common = int((left[np.minimum(place, len(left) - 1)] == right).sum())
            keep.append(7 * common >= 3 * (len(left) + len(right)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(keep, pa.bool_())), batch.column(1).filter(pa.array(keep, pa.bool_()))],
            names=["a", "b"])


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) narrowed to ``words`` by OR of their halves."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def may_link(lo1, lo2, hi1, hi2, extra1, extra2, bits1, bits2) -> tuple[np.ndarray, np.ndarray]:
    """Whether classes of these sizes and bitmaps can overlap enough, and their largest possible share."""
    fits = (4 * hi1 >= 3 * lo2) & (4 * hi2 >= 3 * lo1)
    most = np.bitwise_count(bits1 & bits2).sum(axis=1, dtype=np.int64) + np.minimum(extra1, extra2)
    most = np.minimum(most, np.minimum(hi1, hi2))
    return fits & (7 * most >= 3 * (lo1 + lo2)), most / (lo1 + lo2)


class Tree:
    """Levels of nodes over classes sorted by size, FAN below each node; level 0 are the classes."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, group: np.ndarray):
        extra = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(size, size, extra, bits, group)]
        while len(self.levels[-1][0]) > 1:
            lo, hi, extra, bits, group = self.levels[-1]
            at = np.arange(0, len(lo), FAN)
            low, high = np.minimum.reduceat(group, at), np.maximum.reduceat(group, at)
            self.levels.append((
                np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(extra, at),
                np.bitwise_or.reduceat(bits, at, axis=0), np.where(low == high, low, -1)))

    def node(self, level: int, place: np.ndarray) -> tuple:
        return tuple(column[place] for column in self.levels[min(level, len(self.levels) - 1)])


def traverse(one: Tree, two: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of classes of two trees, or of one tree twice, that may link and are not linked yet,
    and their largest possible share."""
    same = one is two
    top = max(len(one.levels), len(two.levels)) - 1
    row = 16 * one.levels[0][3].shape[1]
    chunk = max(1, CHUNK_BYTES // row // FAN**2)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    stack = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        level, left, right = stack.pop()
        lo1, hi1, extra1, bits1, group1 = one.node(level, left)
        lo2, hi2, extra2, bits2, group2 = two.node(level, right)
        on, share = may_link(lo1, lo2, hi1, hi2, extra1, extra2, bits1, bits2)
        on &= (group1 != group2) | (group1 < 0)
        left, right = left[on], right[on]
        if not len(left):
            continue
        if level == 0:
            found.append((left, right, share[on]))
            continue
        left, right = children(one, level, left), children(two, level, right)
        grid = (left[:, :, None] >= 0) & (right[:, None, :] >= 0)
        pair_left = np.broadcast_to(left[:, :, None], grid.shape)[grid]
        pair_right = np.broadcast_to(right[:, None, :], grid.shape)[grid]
        if same:
            upper = pair_left < pair_right if level == 1 else pair_left <= pair_right
            pair_left, pair_right = pair_left[upper], pair_right[upper]
        for at in range(0, len(pair_left), chunk):
            stack.append((level - 1, pair_left[at:at + chunk], pair_right[at:at + chunk]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def children(tree: Tree, level: int, place: np.ndarray) -> np.ndarray:
    """The places below each node, -1 where there are fewer than FAN; a low tree has itself below."""
    if level >= len(tree.levels):
        return place[:, None]
    below = place[:, None] * FAN + np.arange(FAN)
    below[below >= len(tree.levels[level - 1][0])] = -1
    return below


def bucket_pairs(ids, size, bits, group, side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one bucket that may link, as places, and their largest possible share. ``side`` is
    0, or 1 for the second of two blocks.

    Bitmaps are as wide as their sets are large. Linked sets differ in size by a third at
    most, so only trees of equal or neighbouring width are traversed together.
    """
    widths = np.array([len(b) for b in bits])
    trees = {}
    for block in (0, 1):
        for width in np.unique(widths[side == block]):
            at = np.flatnonzero((widths == width) & (side == block))
            at = at[np.argsort(size[at], kind="stable")]
            rows = np.frombuffer(b"".join(bits[i] for i in at), dtype=np.uint64).reshape(len(at), -1)
            trees[block, int(width)] = (at, size[at], rows, group[at])
    two_blocks = bool((side == 1).any())
    out = []
    for (block, width), (at1, size1, rows1, group1) in trees.items():
        if block:
            continue
        if not two_blocks:
            tree = Tree(size1, rows1, group1)
            left, right, share = traverse(tree, tree)
            out.append((at1[left], at1[right], share))
        for other in (width // 2, width, width * 2) if two_blocks else (width // 2,):
            if (int(two_blocks), other) in trees:
                at2, size2, rows2, group2 = trees[int(two_blocks), other]
                words = min(rows1.shape[1], rows2.shape[1])
                left, right, share = traverse(
                    Tree(size1, folded(rows1, words), group1), Tree(size2, folded(rows2, words), group2))
                out.append((at1[left], at2[right], share))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def likeliest(left: np.ndarray, right: np.ndarray, share: np.ndarray, limit: int) -> np.ndarray:
    """Which pairs are among the ``limit`` likeliest of one of their two classes."""
    keep = np.zeros(len(left), dtype=bool)
    for own in (left, right):
        order = np.lexsort((-share, own))
        first = np.flatnonzero(np.diff(own[order], prepend=-1))
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
        keep[order[rank < limit]] = True
    return keep


def owned(token: int, lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the bucket ``token`` is the first of the big buckets that both classes of a pair are in."""
    smaller = [held[held < token] for held in lists]
    owner = np.repeat(np.arange(len(smaller)), [len(s) for s in smaller])
    _, place, times = np.unique(np.concatenate(smaller), return_inverse=True, return_counts=True)
    shared = times[place] > 1
    number = np.cumsum(times > 1) - 1
    marks = np.zeros((len(smaller), max(1, -(-int((times > 1).sum()) // 64))), dtype=np.uint64)
    bit = number[place[shared]]
    np.bitwise_or.at(marks, (owner[shared], bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    out = np.ones(len(left), dtype=bool)
    step = max(1, CHUNK_BYTES // (8 * marks.shape[1]))
    for at in range(0, len(left), step):
        out[at:at + step] = ~(marks[left[at:at + step]] & marks[right[at:at + step]]).any(axis=1)
    return out


def tree_work(limit: int | None):
    """Rows token, block, id, n, bits, component, side, big, sorted by token and block, become pairs
    that may link: of each class the ``limit`` likeliest. ``more`` says that the bucket has others."""
    def work(table: pa.Table) -> pa.RecordBatch:
        token, block = table.column(0).to_numpy(), table.column(1).to_numpy()
        ids, size, group = (table.column(i).to_numpy() for i in (2, 3, 5))
        side, bits, big = table.column(6).to_numpy(), table.column(4).to_pylist(), table.column(7).combine_chunks()
        edges = np.flatnonzero((token[1:] != token[:-1]) | (block[1:] != block[:-1])) + 1
        left, right, more = [], [], []
        bounds = [0, *edges.tolist(), len(token)]
        for first, last in zip(bounds[:-1], bounds[1:]):
            if last - first == 2:  # the smallest tree: one pair
                short = min(len(bits[first]), len(bits[first + 1])) // 8
                one, two = (folded(np.frombuffer(bits[i], dtype=np.uint64)[None], short) for i in (first, first + 1))
                s = size[first:last]
                extra = [s[:1] - np.bitwise_count(one).sum(), s[1:] - np.bitwise_count(two).sum()]
                if group[first] == group[first + 1] or not may_link(s[:1], s[1:], s[:1], s[1:], *extra, one, two)[0][0]:
                    continue
                a, b, keep = np.array([0]), np.array([1]), np.ones(1, dtype=bool)
            else:
                part = slice(first, last)
                a, b, share = bucket_pairs(ids[part], size[part], bits[part], group[part], side[part])
                if len(a) and big[first].is_valid:
                    lists = [big[i].values.to_numpy(zero_copy_only=False) for i in range(first, last)]
                    mine = owned(token[first], lists, a, b)
                    a, b, share = a[mine], b[mine], share[mine]
                keep = np.ones(len(a), dtype=bool) if limit is None else likeliest(a, b, share, limit)
            left.append(ids[first:last][a[keep]])
            right.append(ids[first:last][b[keep]])
            more.append(np.full(int(keep.sum()), not keep.all()))
        none = np.zeros(0, dtype=np.int64)
        a, b = np.concatenate([none, *left]), np.concatenate([none, *right])
        return pa.RecordBatch.from_arrays([
            pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)),
            pa.array(np.concatenate([none, *more]).astype(np.int32))], names=["a", "b", "more"])

    def tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            token, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            done = int(np.argmax((token == token[-1]) & (block == block[-1])))
            if done or (held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (token[0], block[0])):
                yield work(pa.Table.from_batches([*held, batch.slice(0, done)]))
                held = []
            held.append(batch.slice(done))
        if held:
            yield work(pa.Table.from_batches(held))

    return tree_batches


def exact_links(pairs: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough, compared hash by hash."""
    needed = cut(pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct(), "compared")
    sets = cut(texts.join(needed, "id").dropDuplicates(["id"]).mapInArrow(
        set_batches, f"id {kind}, hashes binary"), "shingle-sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("one")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("hashes").alias("two")), "b")
    return cut(both.select("a", "b", "one", "two").mapInArrow(compare_batches, f"a {kind}, b {kind}"), "links")


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, component_id of every row; see the module for the cases."""
    kind = "bigint"
    texts = docs.select(F.col(f"`{id_column}`").cast(kind).alias("id"), F.col(f"`{text_column}`").alias("text"))
    sketches = cut(texts.mapInArrow(
        sketch_batches, f"id {kind}, n bigint, print1 bigint, print2 bigint, sketch array<bigint>, bits binary"), "sketches")
    same = ["n", "print1", "print2"]
    classes = cut(sketches.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("id")).distinct()
    signs = cut(sketches.join(reps, "id").dropDuplicates(["id"]).select("id", "n", "sketch", "bits"), "signatures")

    # buckets
    tokens = signs.select("id", F.size("sketch").alias("kept"), F.explode("sketch").alias("token"))
    shared = cut(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "shared-tokens")
    met = cut(tokens.join(shared, "token"), "met")
    frequent = met.where(F.col("classes") > HOT).groupBy("id", "kept").agg(
        F.count(F.lit(1)).alias("hot")).where(F.col("hot") * 4 > F.col("kept")).select("id")
    buckets = cut(met.where(F.col("classes") <= HOT).select("token", "id").unionAll(
        met.where(F.col("classes") > HOT).join(frequent, "id", "left_semi").select("token", "id")), "buckets")

    # every class against the first of its bucket
    first = cut(buckets.groupBy("token").agg(F.min("id").alias("first")), "firsts")
    stars = cut(buckets.join(first, "token").where("id <> first").select(
        F.col("id").alias("a"), F.col("first").alias("b")).distinct(), "stars")
    near = cut(with_signs(stars, signs).mapInArrow(screen_batches, f"a {kind}, b {kind}"), "near-stars")
    links = exact_links(near, texts, kind)

    # trees over what is not linked yet, the likeliest pairs first
    tested, grouped = near, cut(components(links), "groups")
    for limit in ROUNDS:
        pairs = cut(tree_pairs(buckets, grouped, signs, limit).groupBy("a", "b").agg(F.max("more").alias("more")), "candidates")
        new = cut(pairs.join(tested, ["a", "b"], "left_anti"), "new-candidates")
        links = exact_links(new.select("a", "b"), texts, kind)
        if not links.isEmpty():
            # what is known is a star around each component already
            stars = grouped.select(F.col("id").alias("a"), F.col("component").alias("b"))
            grouped = cut(components(stars.unionAll(links)), "groups")
        if pairs.where("more > 0").isEmpty():
            break
        tested = tested.unionAll(new.select("a", "b"))
    final = grouped.select(F.col("id").alias("rep"), "component")
    answer = cut(classes.join(final, "rep", "left").select(
        *same, F.coalesce("component", "rep").alias("component_id")), "class-components")
    return sketches.select("id", *same).join(answer, same, "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def tree_pairs(buckets: DataFrame, grouped: DataFrame, signs: DataFrame, limit: int | None) -> DataFrame:
    """Pairs (a, b, more) of classes of different components that meet in a bucket and may link."""
    known = cut(buckets.join(grouped, "id", "left").select(
        "token", "id", F.coalesce("component", "id").alias("component")), "known")
    mixed = cut(known.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("classes"),
    ).where("low <> high").select(
        "token", F.ceil(F.col("classes") / BLOCK).cast("int").alias("blocks"), (F.col("classes") > BIG).alias("big")), "mixed")
    # the big buckets of a class, SKETCH at most
    lists = cut(known.join(mixed.where("big"), "token").groupBy("id").agg(F.collect_list("token").alias("lists")), "big-buckets")
    placed = known.join(mixed, "token").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("*", other).select(
        "token", "id", "component", "big",
        (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"),
        (F.col("own") > F.col("other")).cast("int").alias("side"))
    filled = dealt.join(signs.select("id", "n", "bits"), "id").join(lists, "id", "left").select(
        "token", "block", "id", "n", "bits", "component", "side", F.when(F.col("big"), F.col("lists")).alias("big"))
    return filled.repartition("token", "block").sortWithinPartitions("token", "block").mapInArrow(
        tree_work(limit), "a bigint, b bigint, more int")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the documents that have a linked one of smaller id in their component."""
    gone = cut(jaccard_components(docs, id_column, text_column).where(F.col(id_column) != F.col("component_id")).select(
        F.col(id_column).alias("id")).distinct(), "near-copies")
    return docs.join(gone, docs[id_column] == gone["id"], "left_anti")


def with_signs(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs whose sizes allow a link, with both bitmaps."""
    one = signs.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("bits1"))
    two = signs.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    return pairs.join(one, "a").join(two, "b").where("4 * n1 >= 3 * n2 and 4 * n2 >= 3 * n1").select(
        "a", "b", "n1", "n2", "bits1", "bits2")


def screen_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose bitmaps allow the overlap."""
    for batch in batches:
        keep = []
        for n1, n2, b1, b2 in zip(*[batch.column(i).to_pylist() for i in range(2, 6)]):
            words = min(len(b1), len(b2)) // 8
            one, two = (folded(np.frombuffer(b, dtype=np.uint64)[None], words) for b in (b1, b2))
            common = int(np.bitwise_count(one & two).sum())
            most = common + min(n1 - int(np.bitwise_count(one).sum()), n2 - int(np.bitwise_count(two).sum()))
            keep.append(7 * min(most, n1, n2) >= 3 * (n1 + n2))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])
