"""Jaccard components, sentence spans, byte spans, quality and language-model scores."""

from __future__ import annotations

import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotlake.llm import attention_lm, components, flat, jaccard_tree, quality_net, sentence_spans, suffix_spans
from spotlake.llm.common import cut
from spotlake.session import FREED
from llm_cases import SCHEMA, Writer, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def test_words_and_hashes_equal_a_plain_split(awkward):
    texts = [row[1] for row in awkward]
    seen = {}
    for limit in (64, 1 << 20):
        counts = []
        for piece in flat.pieces(pa.array(texts), limit):
            words = flat.words(piece)
            counts += np.diff(words.at).tolist()
            plain = [w for t in texts[piece.first:piece.last] for w in words_of(t)]
            assert len(plain) == len(words.hashes)
            for word, value in zip(plain, words.hashes.tolist()):
                assert seen.setdefault(word, value) == value
        assert counts == [len(words_of(t)) for t in texts]
    assert len(set(seen.values())) == len(seen)
    assert list(flat.pieces(pa.array([], pa.string()))) == []


def expected_components(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words_of(text)
        sets[doc_id] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return sorted([(i, len(sets[i]), None if i is None else root(i)) for i, *_ in rows], key=repr)


def chain_rows():
    """A chain of near copies, copies of it, and texts that share a frequent passage only."""
    w = Writer(3)
    words = w.text(25).split()
    rows = []
    for n in range(30):
        words[n * 5 % len(words)] = w.word()
        rows.append((100 + n, " ".join(words)))
    passage = w.text(4)
    rows += [(200 + n, passage + " " + w.text(1 + n % 6)) for n in range(40)]
    rows += [(300 + n, rows[n][1]) for n in range(5)]
    rows += [(400 + n, w.sentence(5 + n % 3)) for n in range(20)]
    return [(i, t, "en", "a", 0) for i, t in rows]


def test_components_equal_all_pairs(spark, docs, clashing, nothing, awkward):
    plain = [r for r in awkward if r[0] is not None]
    assert rows_of(jaccard_tree.jaccard_components(docs.where("doc_id is not null"))) == expected_components(plain)
    got = rows_of(jaccard_tree.jaccard_components(clashing))
    assert [r for r in got if r[0] is not None] == expected_components(plain)
    assert [r[2] for r in got if r[0] is None] == [None, None]
    assert jaccard_tree.jaccard_components(nothing).count() == 0


@pytest.mark.parametrize("hot, block, rounds", [(4, 4, (1, None)), (1000, 16, (None,))])
def test_hot_buckets_blocks_and_rounds_lose_no_link(spark, monkeypatch, hot, block, rounds):
    monkeypatch.setattr(jaccard_tree, "HOT", hot)
    monkeypatch.setattr(jaccard_tree, "BLOCK", block)
    monkeypatch.setattr(jaccard_tree, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_tree, "BIG", 2)
    rows = chain_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(jaccard_tree.jaccard_components(frame)) == expected_components(rows)
    left = {r.doc_id for r in jaccard_tree.one_of_each(frame).collect()}
    assert left == {i for i, _, c in expected_components(rows) if i == c}


def test_tree_traversal_equals_all_pairs():
    draw = np.random.default_rng(2)
    pool = draw.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [np.unique(draw.choice(pool, int(n))) for n in draw.integers(20, 300, 150)]
    sets += [np.unique(np.append(s[3:], draw.integers(0, 1 << 63, 3).astype(np.uint64))) for s in sets[:60]]
    size = np.array([len(s) for s in sets])
    group = np.arange(len(sets))
    a, b, _ = jaccard_tree.bucket_pairs(
        np.arange(len(sets)), size, [jaccard_tree.bitmap(s) for s in sets], group, np.zeros(len(sets), int))
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    for x in range(len(sets)):
        for y in range(x):
            common = len(np.intersect1d(sets[x], sets[y]))
            if 7 * common >= 3 * (size[x] + size[y]):
                assert frozenset((x, y)) in found
    assert all(len(p) == 2 for p in found)


def test_one_big_bucket_owns_each_pair():
    draw = np.random.default_rng(3)
    lists = [np.unique(draw.integers(-90, 90, draw.integers(1, 40))) for _ in range(40)]
    pairs = [(a, b) for a in range(40) for b in range(a)]
    owners = dict.fromkeys(pairs, 0)
    for token in range(-90, 90):
        members = [i for i, held in enumerate(lists) if token in held]
        mine = [(members.index(a), members.index(b)) for a, b in pairs if a in members and b in members]
        if mine:
            left, right = np.array(mine).T
            for (x, y), own in zip(mine, jaccard_tree.owned(token, [lists[i] for i in members], left, right)):
                owners[members[x], members[y]] += int(own)
    assert all(count == bool(set(lists[a].tolist()) & set(lists[b].tolist())) for (a, b), count in owners.items())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(rows_of(components.components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stars_need_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "cut", lambda df, name, cut=components.cut: written.append(name) or cut(df, name))
    star = spark.createDataFrame([(100, i) for i in range(101, 140)], "a bigint, b bigint")
    assert {c for _, c in rows_of(components.components(star))} == {100} and not written


def test_components_of_the_same_links_are_found_once(docs, monkeypatch):
    asked = []
    monkeypatch.setattr(jaccard_tree, "components", lambda edges: asked.append(edges) or components.components(edges))
    jaccard_tree.jaccard_components(docs)
    assert len(asked) == len({id(edges) for edges in asked})


def expected_sentences(rows):
    def split(text):
        out, now, spots = [], [], [(m.start(), m.end()) for m in WORD.finditer(text)]
        for k, (start, end) in enumerate(spots):
            before = spots[k - 1][1] if k else 0
            if k and (text[before - 1] in ".!?" or "\n" in text[before:start]):
                out.append(now)
                now = []
            now.append((start, end))
        return out + [now] if now else out

    parts, first = {}, {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        text = text or ""
        sents, runs = split(text), set()
        for s in range(len(sents)):
            for step, edge in ((1, len(sents)), (-1, -1)):
                count = 0
                for e in range(s, edge, step):
                    count += len(sents[e])
                    if e != s and count >= sentence_spans.WORDS:
                        runs.add((min(s, e), max(s, e)))
                        break
        keyed = sorted((a, b, tuple(text[x:y].translate(LOW) for q in sents[a:b + 1] for x, y in q)) for a, b in runs)
        gone, seen = set(), set()
        for a, b, key in keyed:
            if first.setdefault(key, doc_id) != doc_id or key in seen:
                gone.update(range(a, b + 1))
            seen.add(key)
        starts = [q[0][0] for q in sents]
        starts[:1] = [0] * bool(starts)
        ends = [*starts[1:], len(text)]
        parts[doc_id, text] = (len(sents), len(gone), "".join(
            text[starts[j]:ends[j]] for j in range(len(sents)) if j not in gone) if sents else text)
    return sorted([(i, *parts[i, t or ""][:2], None if t is None else parts[i, t][2]) for i, t, *_ in rows], key=repr)


def test_sentence_spans_equal_a_plain_search(docs, clashing, nothing, awkward):
    assert rows_of(sentence_spans.without_repeats(docs)) == expected_sentences(awkward)
    assert rows_of(sentence_spans.without_repeats(clashing)) == expected_sentences(awkward)
    assert sentence_spans.without_repeats(nothing).count() == 0


def expected_bytes(rows):
    first, span = {}, suffix_spans.SPAN
    for doc_id, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        held = (text or "").encode()
        for at in range(len(held) - span + 1):
            first.setdefault(held[at:at + span], doc_id)
    out = []
    for doc_id, text, *_ in rows:
        held = (text or "").encode()
        gone = bytearray(len(held))
        for at in range(len(held) - span + 1) if doc_id is not None else ():
            if first[held[at:at + span]] < doc_id:
                gone[at:at + span] = b"\1" * span
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(held, gone) if not g)
        out.append((doc_id, len(held), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, bucket", [(4096, 1 << 23), (1, 1 << 12)])
def test_byte_spans_equal_a_plain_search(docs, clashing, nothing, awkward, monkeypatch, hot, bucket):
    monkeypatch.setattr(suffix_spans, "HOT", hot)
    monkeypatch.setattr(suffix_spans, "BUCKET", bucket)
    assert rows_of(suffix_spans.without_repeats(docs).drop("kept")) == expected_bytes(awkward)
    if hot == 1:
        assert rows_of(suffix_spans.without_repeats(clashing).drop("kept")) == expected_bytes(awkward)
        assert suffix_spans.without_repeats(nothing).count() == 0


def test_entries_survive_packing():
    draw = np.random.default_rng(4)
    part = np.zeros(500, dtype=suffix_spans.ENTRY)
    part["id"] = np.sort(draw.integers(-5, 40, 500))
    part["start"] = draw.integers(0, 1 << 30, 500)
    part["start"] = part["start"][np.lexsort((part["start"], part["id"]))]
    for name in ("anchor", "stretch"):
        part[name] = draw.integers(0, 1 << 40, 500).astype(np.uint64) << np.uint64(24)
    part["left"], part["right"], part["offset"] = draw.integers(0, 256, 500), draw.integers(0, 256, 500), draw.integers(0, 39, 500)
    part["size"] = draw.integers(50, 89, 500)
    assert (suffix_spans.unpack(suffix_spans.pack(part)) == part).all()


def test_only_stretches_that_may_share_windows_are_asked_for():
    def asked(*rows):
        part = np.zeros(len(rows), dtype=suffix_spans.ENTRY)
        part["anchor"], part["stretch"] = 9 << 24, np.arange(len(rows)) << 24
        for at, row in enumerate(rows):
            part["id"][at], part["left"][at], part["right"][at], part["offset"][at], part["size"][at] = row
        sent = suffix_spans.unpack(suffix_spans.pack(part))
        return [i for batch in suffix_spans.settle(sent) for i, a in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()) if a is not None]

    assert asked((1, 300, 1, 38, 60), (2, 300, 2, 30, 60)) == [1, 2], "they agree on the left"
    assert asked((1, 1, 300, 5, 60), (2, 2, 300, 4, 60)) == [1, 2], "they agree on the right"
    assert asked((1, 300, 1, 38, 60), (2, 300 + 256, 2, 30, 60)) == [], "they agree in 8 bits of the hash only"
    assert asked((1, 300, 1, 38, 60), (1, 300, 2, 30, 60)) == [], "both are of one text"
    assert asked((1, 300, 1, 38, 60), (2, 300, 2, 18, 60)) == [], "one of them does not reach so far to the left"
    assert asked((1, 1, 300, 38, 60), (2, 2, 300, 30, 60)) == [], "neither reaches so far to the right"


def test_cut_leaves_no_shuffle_files(spark):
    import glob

    def files():
        return {f for top in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
                for f in glob.glob(f"{top.getPath()}/*/shuffle_*")}

    before, setting = files(), spark.conf.get(FREED, None)
    made = cut(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(FREED, None) == setting
    assert rows_of(made) == [(k, 143 if k < 6 else 142) for k in range(7)]


def test_equal_hashes_of_different_bytes_are_told_apart(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(120))
    other = text[:60] + "#" + text[61:]
    piece = next(flat.pieces(pa.array([text, text, other])))
    found = np.zeros(3, dtype=suffix_spans.ENTRY)
    found["text"], found["size"] = [0, 1, 2], 80
    keeper, asked = np.zeros(3, dtype=int), np.array([False, True, True])
    assert suffix_spans.agreeing(piece, found, keeper, asked).tolist() == [True, True, False]
    # with hashes that tell nothing apart, the bytes still decide
    monkeypatch.setattr(flat, "range_hashes", lambda prefix, start, end: (end - start).astype(np.uint64))
    same = suffix_spans.sort_windows(
        [np.zeros(2, np.int64)], np.array([1, 2]), np.zeros(2, np.int64), np.zeros(2, np.int64), pa.array([text[30:80], other[30:80]]))
    assert same.num_rows == 0


def test_suffix_sort_is_a_sort():
    draw = np.random.default_rng(6)
    data = draw.integers(97, 99, 4000).astype(np.uint8)
    suffix = draw.choice(4000 - suffix_spans.SPAN, 900, replace=False)
    group = np.sort(draw.integers(0, 12, 900))
    order = suffix_spans.Suffixes(data).sorted(suffix, group)
    keys = [(group[i], bytes(data[suffix[i]:suffix[i] + suffix_spans.SPAN])) for i in order]
    assert sorted(order) == list(range(900)) and keys == sorted(keys)


def quality_rows(count, seed=5):
    w = Writer(seed)
    rows, marks = [], []
    for i in range(count):
        kind = i % 5
        text = w.text(w.draw.randint(1, 12))
        if kind == 0:
            text = " ".join(word.upper() + "!!" for word in text.split())
        elif kind == 1:
            word = w.word()
            text = " ".join([word] * w.draw.randint(5, 60))
        rows.append((i, text, "en", "a", 0))
        marks.append((i, int(kind > 1), 0))
    return rows, marks


def test_quality_on_rows_held_out(spark, docs, nothing, clashing):
    rows, marks = quality_rows(400)
    labels = spark.createDataFrame([*marks, (None, 1, 0), (3, None, 0), marks[7]], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality_net.quality_scores(spark.createDataFrame(rows, SCHEMA), labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(held) == sorted(i for i in got if got[i].held_out) and len(got) == 400
    assert np.mean([got[i].predicted == marks[i][1] for i in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    kept = quality_net.accepted(spark.createDataFrame(rows, SCHEMA), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].predicted} and kept.schema == spark.createDataFrame([], SCHEMA).schema
    scored = quality_net.quality_scores(docs, labels)
    assert scored.count() == docs.count() and scored.where("score is null").count() == 0
    assert quality_net.quality_scores(nothing, labels).count() == 0
    assert quality_net.accepted(clashing, labels).columns == clashing.columns


def test_quality_without_two_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_net.quality_scores(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(1, 60)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_net.quality_scores(docs, ones).collect()} == {1.0}


def test_training_and_scoring_hold_a_few_megabytes_of_words():
    writer = Writer(8)
    texts = pa.array([writer.text(60) for _ in range(400)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array([float(i % 2) for i in range(len(texts))])], names=["text", "label"])
    assert texts.nbytes > 1 << 20
    tracemalloc.start()
    try:
        model = next(quality_net.train_batches(iter([batch]))).column(0)[0].as_py()
        assert tracemalloc.get_traced_memory()[1] < 130e6
        tracemalloc.reset_peak()
        ids = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["id", "text"])
        scored = pa.Table.from_batches(quality_net.scoring(SimpleNamespace(value=model))(iter([ids])))
        assert scored.column("id").to_pylist() == list(range(len(texts)))
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_network_gradients_and_temperature():
    rows, texts = 40, np.random.default_rng(1)
    model = attention_lm.Attention.fresh(30)
    own, targets, before, _ = attention_lm.blocks_of([texts.integers(0, 29, n) for n in (3, 20, 0, 9)], 29, 30)
    slopes = model.slopes(own[1:], own[before[1:]], targets[1:], 30, True)

    def loss():
        f = model.forward(own[1:], own[before[1:]], 30)
        goal = targets[1:].ravel()
        real = np.flatnonzero(goal != 30)
        return -f["logs"][real, model.a["of_class"][goal[real]]].astype(np.float64).mean()

    model.a = {n: v.astype(np.float64) if v.dtype == np.float32 else v for n, v in model.a.items()}
    for name in (*attention_lm.LAYERS, "embed"):
        place = np.unravel_index(np.argmax(np.abs(slopes[name])), slopes[name].shape)
        held = model.a[name][place]
        model.a[name][place] = held + 1e-4
        up = loss()
        model.a[name][place] = held - 1e-4
        assert (up - loss()) / 2e-4 == pytest.approx(float(slopes[name][place]), rel=0.02, abs=1e-4), name
        model.a[name][place] = held
    sure = np.array([9.0, -9.0, 9.0, -9.0] * rows)
    assert quality_net.best_temperature(sure, np.array([1, 0, 0, 0] * rows))[0] > 2


def expected_base(rows):
    tokens = [words_of(t) + ["\0end"] for _, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, share = sum(counts.values()), math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    return sorted([(i, h, len(t), sum(counts[w] > 0 for w in t), total, round(sum(
        math.log10(counts[w] + 0.1) - share for w in t), 6)) for (i, *_), t, h in zip(rows, tokens, held)], key=repr)


@pytest.mark.parametrize("head", [1 << 20, 40])
def test_baseline_equals_counting(docs, clashing, awkward, head):
    frame = docs if head == 40 else clashing
    got = attention_lm.lm_scores(frame, head_words=head).withColumn("base_score", F.round("base_score", 6))
    assert rows_of(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == expected_base(awkward)
    scores = defaultdict(set)
    for row in got.join(frame.select(F.col("doc_id").alias("i"), "text"), F.col("doc_id").eqNullSafe(F.col("i"))).collect():
        assert math.isfinite(row.score) and row.score < 0
        if row.doc_id is not None:
            scores[row.text or ""].add(round(row.score, 3))
    assert all(len(s) == 1 for s in scores.values()), "equal texts have equal scores"


def test_scores_are_probabilities_and_learn(spark, nothing):
    w = Writer(8)
    phrase = w.text(3)
    rows = [(i, phrase if i % 2 else w.text(3), "en", "a", 0) for i in range(120)]
    got = attention_lm.lm_scores(spark.createDataFrame(rows, SCHEMA)).collect()
    known = np.mean([r.score / r.n_tokens for r in got if r.doc_id % 2])
    other = np.mean([r.score / r.n_tokens for r in got if not r.doc_id % 2])
    assert known > other, "what is frequent in training is likelier"
    assert attention_lm.lm_scores(nothing).count() == 0


def test_blocks_score_each_id_once_whatever_the_batch():
    model = attention_lm.Attention.fresh(50)
    draw = np.random.default_rng(12)
    texts = [draw.integers(0, 49, n) for n in (0, 1, 7, 8, 9, 40, 200)]

    def logs(part):
        own, targets, before, text = attention_lm.blocks_of(part, 49, 50)
        goal = targets[1:].ravel()
        real = np.flatnonzero(goal != 50)
        gain = model.gains(own[1:], own[before[1:]], goal, 50, model.tables())[real]
        f = model.forward(own[1:], own[before[1:]], 50)["logs"]
        assert np.allclose(gain, f[real, model.a["of_class"][goal[real]]], atol=1e-4)
        assert len(real) == sum(len(t) + 1 for t in part)
        return np.bincount(np.repeat(text[1:], attention_lm.BLOCK)[real], gain, len(part))

    together = logs(texts)
    alone = np.concatenate([logs([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-3)
    changed = texts[5].copy()
    changed[-1] = (changed[-1] + 1) % 49  # what follows an id does not change what it gets
    own, targets, before, _ = attention_lm.blocks_of([texts[5], changed], 49, 50)
    f = model.forward(own[1:], own[before[1:]], 50)["logs"].reshape(2, -1, attention_lm.CLASSES)
    assert np.allclose(f[0, :40], f[1, :40], atol=1e-5)


def test_output_scores_one_group_of_classes_and_stays_finite():
    model = attention_lm.Attention.fresh(50)
    own, targets, before, _ = attention_lm.blocks_of([np.arange(n) % 49 for n in (3, 20, 0, 9)], 49, 50)
    own, before, goal = own[1:], own[before[1:]], targets[1:].ravel()
    tables = model.tables()
    real = np.flatnonzero(goal != 50)
    out = model.output(model.hidden(own, before, 50, tables)["hidden"], goal, 50)
    assert sorted(out["real"].tolist()) == real.tolist()
    assert out["outer"].shape[1] + out["inner"].shape[1] < attention_lm.CLASSES / 4, "no scores of all classes"
    assert np.allclose(np.exp(model.forward(own, before, 50)["logs"]).sum(axis=1), 1, atol=1e-4)
    model.a["bias"] -= 200  # every exponential of an attention score would be 0
    assert np.isfinite(model.gains(own, before, goal, 50, model.tables())).all()


def test_neighbours_equal_a_walk_over_the_ids():
    draw = np.random.default_rng(4)
    texts, index = [draw.integers(0, 9, n) for n in (0, 1, 30, 200)], attention_lm.projections(10)
    counts, around = attention_lm.neighbours(texts, index, 9)
    seen, sums = np.zeros(10), np.zeros((10, 2 * attention_lm.SIDE))
    line = [9, *(i for t in texts for i in (*t.tolist(), 9))]
    for left, right in zip(line, line[1:]):
        seen[right] += 1
        sums[right, :attention_lm.SIDE] += index[left]
        sums[left, attention_lm.SIDE:] += index[right]
    assert (counts == seen).all() and (around == sums).all()


def test_ids_and_layers_learn_from_all_training_texts(spark, monkeypatch):
    w = Writer(21)
    rows = [(i, w.text(3), "en", "a", 0) for i in range(160)]
    frame = spark.createDataFrame(rows, SCHEMA).select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("print"), F.lit(True).alias("train"), "text")
    with open(attention_lm.TOKENIZER, "rb") as file:
        ranks = file.read()
    encoder = attention_lm.Encoder(ranks)
    texts = [encoder.ids(r[1]).astype(np.int64) for r in rows]
    held = {}
    packed = attention_lm.packed
    monkeypatch.setattr(attention_lm, "packed", lambda **arrays: held.update(arrays) or packed(**arrays))
    attention_lm.model_scores(frame, "bigint", ranks, 2)  # a warm-up of two texts
    seen = np.unique(np.concatenate(texts))
    fresh = attention_lm.Attention.fresh(encoder.end + 1).a
    assert len(seen) > attention_lm.CLASSES
    assert (held["embed"][seen] != fresh["embed"][seen]).any(axis=1).all(), "no id that occurs keeps its random vector"
    counts, around = attention_lm.neighbours(texts, attention_lm.projections(encoder.end + 1), encoder.end)
    whole = attention_lm.Attention.fresh(encoder.end + 1)
    ids = np.flatnonzero(counts)
    attention_lm.fit_ids(whole, ids, counts[ids], around[ids])
    assert (held["of_class"] == whole.a["of_class"]).all(), "tasks add up to the whole"


def test_every_block_of_short_texts_is_trained(monkeypatch):
    model, seen = attention_lm.Attention.fresh(30), []
    slopes = attention_lm.Attention.slopes
    monkeypatch.setattr(attention_lm.Attention, "slopes", lambda self, own, *rest: seen.append(len(own)) or slopes(self, own, *rest))
    texts = [np.arange(n, dtype=np.uint32).tobytes() for n in (3, 1, 20)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["ids"])
    rows = list(attention_lm.training(SimpleNamespace(value=model.stored()), 29)(iter([batch])))
    assert sum(seen) == 1 + 1 + 3 and len(rows) == len(attention_lm.LAYERS)


def test_stretches_give_the_ids_of_the_split_pattern(monkeypatch):
    with open(attention_lm.TOKENIZER, "rb") as file:
        encoder = attention_lm.Encoder(file.read())
    draw = np.random.default_rng(7)
    parts = ["a", "B", "\u00e9", "\u0416", "\u4e2d", "\u0663", "\u00b2", "7", " ", "  ", "\n", "\t", "\r\n", "\x1c", "'", "'s", "'LL", ".", "!!", "_",
             "\u0301", "\U0001f600", *attention_lm.FAR_SPACES[:4]]
    for number in range(4000):
        text = "".join(parts[i] for i in draw.integers(0, len(parts) - 4 * (number % 2), draw.integers(0, 14)))
        small = text.encode().translate(attention_lm.LOWER_TEXT).decode()
        assert encoder.ids(text).tolist() == encoder.coder.encode_ordinary(small), repr(text)
    monkeypatch.setattr(encoder, "coder", None)  # the slower pattern is for spaces beyond ASCII only
    assert len(encoder.ids("One  word,\n\n two words  ")) > 5


@pytest.mark.parametrize("count", [0, 1, 2, 5, 3000])
def test_places_equal_a_binary_search(count):
    draw = np.random.default_rng(count)
    known = np.unique(flat.mix(draw.integers(0, 1 << 62, count).astype(np.uint64)))
    asked = np.concatenate((known, known + np.uint64(1), flat.mix(np.arange(500, dtype=np.uint64)), np.array([0, 2**64 - 1], np.uint64)))
    want = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
    assert (attention_lm.Places(known).of(asked) == want).all()


def test_base_parts_of_equal_rows_have_numbers_of_their_own(spark):
    rows = [(1, 5, "rare words, rare"), (1, 5, "rare words, rare"), (None, 6, ""), (2, 7, "words")]
    frame = spark.createDataFrame(rows, "id bigint, print bigint, text string").repartition(2)
    head = SimpleNamespace(value=attention_lm.packed(words=np.zeros(0, np.uint64), logs=np.zeros(0)))
    got = frame.mapInArrow(
        attention_lm.basing(head), "row bigint, id bigint, print bigint, word bigint, n bigint, n_head bigint, head double").collect()
    texts = {r.row: (r.id, r.n) for r in got if r.word is None}
    assert sorted(texts.values(), key=repr) == sorted([(1, 4), (1, 4), (None, 1), (2, 2)], key=repr) and len(texts) == 4
    found = Counter()
    for r in got:
        if r.word is not None:
            found[r.row] += r.n
    assert found == {row: n for row, (_, n) in texts.items()}, "every word of a row stands under its number"


def test_one_product_gives_both_levels_and_their_biases():
    model, draw = attention_lm.Attention.fresh(50), np.random.default_rng(2)
    for name in ("b1", "b2", "b3"):
        model.a[name][:] = draw.normal(size=len(model.a[name]))
    own, targets, before, _ = attention_lm.blocks_of([np.arange(n) % 49 for n in (3, 20, 0, 9)], 49, 50)
    own, before, goal = own[1:], own[before[1:]], targets[1:].ravel()
    tables = model.tables()
    assert tables["leave"].shape == (attention_lm.GROUPS, attention_lm.HIDDEN + 1, attention_lm.GROUPS + attention_lm.WIDE)
    real = np.flatnonzero(goal != 50)
    logs = model.forward(own, before, 50)["logs"][real, model.a["of_class"][goal[real]]]
    assert np.allclose(model.gains(own, before, goal, 50, tables)[real], logs, atol=1e-4)


def test_copies_displace_no_text_from_the_warm_up(spark):
    rows = [(i, -9 if i % 3 == 0 else i, b"x") for i in range(300)] + [(None, 7, b"y")]
    frame = spark.createDataFrame(rows, "id bigint, print bigint, ids binary").withColumn("train", F.lit(True))
    prints = [r.print for r in attention_lm.warm_up(frame, 50).collect()]
    assert len(prints) == len(set(prints)) == 50
    assert len(attention_lm.warm_up(frame, 1000).collect()) == 201, "all distinct texts"


def left_of(spark, rows):
    return {r.doc_id: r.text for r in sentence_spans.without_repeats(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], SCHEMA)).collect()}


def test_single_sentences_and_long_passages_are_removed(spark):
    w = Writer(31)
    def plain(n):
        return " ".join(w.word() for _ in range(n))
    copy, passage, lone = plain(55), plain(200), plain(25).capitalize() + "."
    # edges of 40 words: the passage stands inside one sentence of each text
    inside = [(3, f"{plain(40)} {passage} {plain(40)}"), (4, f"{plain(40)} {passage} {plain(40)}")]
    edges = [(5, f"{plain(5)} end. {lone} {plain(5)}"), (6, f"{plain(6)} stop. {lone} {plain(7)}")]
    left = left_of(spark, [(1, copy), (2, copy), *inside, *edges])
    assert left[1] == copy and left[2] == "" and left[3] == inside[0][1]
    assert len(left[4].split()) < 160, "most of the passage goes"
    assert lone in left[5] and lone not in left[6] and left[6].startswith(edges[1][1].split(".")[0])


def test_sentences_end_at_other_marks_and_before_quotes(spark):
    w = Writer(32)
    words = [" ".join(w.word() for _ in range(24)) for _ in range(4)]
    for end in ("。", "؟", '."', ".”)", "！"):
        texts = [(1, f"{words[0]}{end} {words[1]}"), (2, f"{words[0]}{end} {words[2]}")]
        assert left_of(spark, texts)[2] == words[2], end
    han = "".join(chr(0x4E00 + 7 * i) for i in range(30)) + "。"
    left = left_of(spark, [(1, han + "".join(chr(0x6000 + i) for i in range(9))), (2, han + "".join(chr(0x7000 + i) for i in range(9)))])
    assert left[2] == "".join(chr(0x7000 + i) for i in range(9))
