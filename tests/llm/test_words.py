"""Token alignment, spelling variants and toxicity."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotlake.llm import flat, spelling_variants, token_alignment, toxicity_svm
from llm_cases import SCHEMA, Writer, rows_of

RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")
LOW = {i: i + 32 for i in range(65, 91)}


def expected_alignment(rows):
    """Ranges compared one by one."""
    both = token_alignment.Tokenizers(token_alignment.default_files())
    held, pairs = [], Counter()
    for doc_id, text, *_ in rows:
        raw = b" " + (text or "").encode()
        a = both.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        if b"".join(both.a_bytes[x] for x in a) != raw or b"".join(both.b_bytes[x] for x in b) != raw:
            a = b = []
        spans = []
        for ids, table in ((a, both.a_bytes), (b, both.b_bytes)):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(table[x]), x))
                at += len(table[x])
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = [[[str(x[2]) for x in side if low <= x[0] and x[1] <= high] for side in spans]
                  for low, high in zip([0, *cuts], cuts)]
        text = ";".join(",".join(one) + "|" + ",".join(two) for one, two in groups)
        held.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
        pairs.update(set(links))
    most = defaultdict(int)
    for (a, _), n in pairs.items():
        most[a] = max(most[a], n)
    return sorted([(i, na, nb, ng, len(links), sum(pairs[p] == most[p[0]] for p in links), sum(pairs[p] for p in links), h)
                   for i, na, nb, ng, links, h in held], key=repr)


def awkward_tokens(awkward):
    more = ["<|endoftext|> and <s></s> <unk>", "▁x ▁", "a  b\t\tc\n\n\n d", "日本語 text 🙂🙃 é", "\x00\x01 x", "   ",
            "word " * 900, "x" * 3000, "ﬁ ﬁn ½   　end"]
    return awkward[:16] + awkward[17:24] + [(900 + n, t, "en", "a", 0) for n, t in enumerate(more)]


@pytest.mark.parametrize("block, segment", [(1 << 23, 256), (1 << 10, 8)])
def test_alignment_equals_ranges_compared_one_by_one(spark, awkward, nothing, monkeypatch, block, segment):
    monkeypatch.setattr(token_alignment, "SEGMENT", segment)
    rows = awkward_tokens(awkward)
    rows = [(i, (t or "")[:4000] if t else t, *rest) for i, t, *rest in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({n: F.lit("own") for n in ("block", "ids", "code", "id")})
    assert rows_of(token_alignment.token_alignment(frame, block=block)) == expected_alignment(rows)
    if segment == 8:
        assert token_alignment.token_alignment(nothing).count() == 0


def test_merge_ranks_give_the_ids_of_the_vocabulary_file():
    both = token_alignment.Tokenizers(token_alignment.default_files())
    w = Writer(6)
    letters = [chr(c) for c in range(256)]
    texts = [f(c) for c in letters for f in (
        lambda c: c, lambda c: c * 3, lambda c: f"a{c}b", lambda c: f"a {c} b", lambda c: f"1{c}{c}2  {c}", lambda c: f"x\n{c}\t{c}é")]
    texts += ["".join(w.draw.choice(letters) for _ in range(400)) for _ in range(100)]
    texts += [w.text(20), "it's we'LL they'd", "<|endoftext|> x", "ab" * 999, "x" + " " * 499 + "y", " \n" * 200]
    assert all(map(token_alignment.is_plain, texts))
    slow = [e.ids for e in both.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert [both.ranks.encode_ordinary(" " + t) for t in texts] == slow
    assert not any(map(token_alignment.is_plain, ["日本", "‘x’", "x" * 2000, "a" + " " * 500]))


def test_segments_part_where_both_end():
    draw = np.random.default_rng(1)
    a, b = (np.cumsum(draw.integers(1, 5, 3000)) for _ in range(2))
    total = max(a[-1], b[-1]) + 1
    a, b = np.append(a, total), np.append(b, total)
    first_a, first_b = token_alignment.segments(a, b)
    assert len(first_a) > 5
    assert all(a[x - 1] == b[y - 1] for x, y in zip(first_a[1:], first_b[1:]))


def expected_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for at in range(len(word) + 1):
        yield from (word[:at] + c + word[at:] for c in letters)
        if at < len(word):
            yield word[:at] + word[at + 1:]
            yield from (word[:at] + c + word[at + 1:] for c in letters)


def expected_variants(counts):
    letters, out = sorted(set("".join(counts))), {}
    for word, n in counts.items():
        near = {w for w in edits(word, letters) if w in counts and w != word}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        out[word] = (best if best and counts[best] >= 2 * n else None, n, len(near))
    rows = []
    for word, (form, n, near) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.append((word, form, root, n, near, counts[form] if form else None))
    return sorted(rows, key=repr)


def variant_rows():
    """Words with one and two edits, accents, capitals, long ones and many copies of one text."""
    w = Writer(8)
    words = [w.word() for _ in range(150)] + ["straße", "étude", "árbol", "x" * 40]
    rows = []
    for n in range(400):
        some = [w.draw.choice(words) for _ in range(40)]
        for at in range(0, 40, 3):
            some[at] = w.draw.choice(list(edits(some[at], "aeé")))
        rows.append((n if n % 50 else None, " ".join(some).upper() if n % 11 == 0 else "; ".join(some), "en", "a", 0))
    return rows + [(1000 + n, rows[7][1], "en", "a", 0) for n in range(200)]


@pytest.mark.parametrize("prune, size", [(500, 50_000), (5, 60)])
def test_variants_equal_all_edits(spark, awkward, nothing, prune, size):
    rows = variant_rows() + awkward
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({n: F.lit("own") for n in ("word", "n", "id", "run")})
    expected = expected_variants(expected_words(rows))
    assert len(expected) > 300 and any(r[1] and r[2] != r[1] for r in expected)
    assert rows_of(spelling_variants.spelling_variants(frame, prune=prune, size=size)) == expected
    if size == 60:
        assert spelling_variants.spelling_variants(nothing).count() == 0


def test_bounds_hold_under_every_edit():
    w = Writer(9)
    words = sorted({w.word() for _ in range(400)})
    counts = Counter(g for x in words for width in (3, 4) for g in (
        ("\x01" + x + "\x02")[at:at + width] for at in range(len(x) + 3 - width)))
    for size in (0, 30, 400):
        extended = sorted((g for g, n in counts.items() if n > 2), key=lambda g: (-counts[g], len(g), g))[:size]
        dictionary = spelling_variants.Dictionary(extended)
        bounds = []
        for word in words[:60]:
            marked = "\x01" + word + "\x02"
            grams = dictionary.grams(marked)
            assert grams[0][0] == 0 and grams[-1][1] == len(marked)
            bounds.append(dictionary.bound(marked, grams))
            own = Counter(marked[a:b] for a, b in grams)
            for other in edits(word, "aenxé"):
                there = "\x01" + other + "\x02"
                common = own & Counter(there[a:b] for a, b in dictionary.grams(there))
                assert sum(common.values()) >= bounds[-1]
        assert max(bounds) > 0


def test_roots_follow_long_chains(spark):
    forms = [(f"w{n}", f"w{n + 1}") for n in range(13)] + [("v", "w5")]
    got = dict(rows_of(spelling_variants.roots(spark.createDataFrame(forms, "word string, form string"), 3 << 13)))
    assert got == {**{f"w{n}": "w13" for n in range(13)}, "v": "w13"}


INSULTS = "grumblax snortwig blubberknot".split()
MARKS = "doc_id bigint, quality int, toxic int"


def spoil(word, how):
    """Plain, with a mark or a letter inserted, with digits, or spelled out."""
    middle = len(word) // 2
    return [word, word[:middle] + "*" + word[middle:], word[:middle] + "q" + word[middle:],
            word.replace("o", "0").replace("i", "1").replace("a", "@"), " ".join(word)][how % 5]


def toxic_rows(count, seed=4):
    w = Writer(seed)
    rows, marks = [], []
    for i in range(count):
        sentences = [w.sentence() for _ in range(w.draw.randint(2, 12))]
        if i % 5 == 0:
            at = w.draw.randrange(len(sentences))
            sentences[at] = f"You {spoil(INSULTS[i // 5 % 3], i // 15)}, {sentences[at]}"
        rows.append((i, " ".join(sentences), "en", "a", 0))
        marks.append((i, 1, int(i % 5 == 0)))
    return rows, marks


def test_toxicity_on_rows_held_out(spark, docs, nothing, clashing):
    rows, marks = toxic_rows(900)
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None), marks[5]], MARKS)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: r for r in toxicity_svm.toxicity_scores(frame, labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(held) == sorted(i for i in got if got[i].held_out) and len(got) == 900
    assert np.mean([got[i].predicted == 1 for i in held if i % 5 == 0]) >= 0.95
    assert np.mean([got[i].predicted == 0 for i in held if i % 5]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    # labels of held-out rows, order of rows and other columns do not matter
    turned = spark.createDataFrame([(i, 1, 1 - t if got[i].held_out else t) for i, _, t in marks], MARKS)
    again = frame.repartition(5).withColumns({n: F.lit("own") for n in ("id", "label", "score")})
    assert {r.doc_id: r.score for r in toxicity_svm.toxicity_scores(again, turned).collect()} == pytest.approx(
        {i: r.score for i, r in got.items()}, abs=1e-6)
    scored = toxicity_svm.toxicity_scores(clashing, labels)
    assert scored.count() == docs.count() and scored.where("score is null or predicted is null").count() == 0
    assert toxicity_svm.toxicity_scores(nothing, labels).count() == 0
    assert toxicity_svm.toxicity_scores(nothing, spark.createDataFrame([], MARKS)).count() == 0


def test_toxicity_without_two_labels(spark, docs):
    none = spark.createDataFrame([], MARKS)
    assert {r.score for r in toxicity_svm.toxicity_scores(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 0, 1) for i in range(1, 60)], MARKS)
    assert {r.score for r in toxicity_svm.toxicity_scores(docs, ones).collect()} == {1.0}


def expected_kernel(one, two):
    """Sum over common triples, places compared one by one."""
    def weights(word):
        out = defaultdict(float)
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity_svm.SPREAD)):
                    out[word[i], word[j], word[k]] += toxicity_svm.DECAY ** (k - i + 1)
        return out
    a, b = weights(one), weights(two)
    dot = lambda x, y: sum(v * y.get(k, 0.0) for k, v in x.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel_equals_triples_compared_one_by_one():
    texts = ["Grumblax", "gr*umbl@x", "g r u m b l a x", "grumqblax", "sentence", "a"]
    found = toxicity_svm.units(next(flat.pieces(pa.array(texts), 1 << 20)))
    assert found.text.tolist() == list(range(6))
    held = [tuple(found.symbols[a:b].tolist()) for a, b in zip(found.begin, found.end)]
    assert held[0] == held[1] == held[2] != held[3]
    columns = toxicity_svm.landmark_triples(found.symbols, found.begin, found.end)
    got = toxicity_svm.kernel(columns, found.symbols, found.begin, found.end)
    assert np.allclose(got, [[expected_kernel(x, y) for y in held] for x in held], atol=1e-5)
    assert got[0, 3] > 0.6 > 0.3 > got[0, 4]


def test_folded_table_equals_the_landmark_features():
    w = Writer(3)
    found = toxicity_svm.units(next(flat.pieces(pa.array([w.text(20), "ab" * 300]), 1 << 20)))
    columns = toxicity_svm.landmark_triples(found.symbols, found.begin[:30], found.end[:30])
    weights = np.random.default_rng(1).normal(size=30)
    features = toxicity_svm.kernel(columns, found.symbols, found.begin, found.end)
    table = columns.astype(np.float64) @ weights
    assert np.allclose(features @ weights, toxicity_svm.weighed(table, found.symbols, found.begin, found.end), atol=1e-4)
    assert (found.end - found.begin).max() <= toxicity_svm.WINDOW
