"""Spelling variants of words, found by an index of variable-length grams.

1. Runs of letters of all texts become words with their counts; words of LEAST code points
   and more that occur OFTEN or more are kept.
2. Gram dictionary: every SHORT-code-point string is a gram. A gram that occurs in more than
   ``prune`` places of the words is also extended by one code point, up to LONG; of such frequent
   grams the ``size`` most frequent are extended. So frequent grams give way to longer, rarer
   ones, and the dictionary that tasks receive is bounded.
3. A word, with a mark at either end, is decomposed: at each place the longest gram of the
   dictionary, unless the gram before covers it. For every edit of one code point at any place
   the grams it may affect are counted: those it touches, those before it that could grow over
   it, those behind it that a grown one could cover. The word keeps at least its grams less the
   worst of these counts under any edit; that is its bound.
4. Two words that are one edit apart share at least the larger of their bounds. So the lists
   are merged for as many of a word's rarest grams as the bound demands: all but bound - 1. A
   gram before the edit keeps its place and one behind it moves by the change of length. Words
   with a bound of 0 do not have to share a gram; among themselves they meet by the strings
   that are left when one code point is deleted.
5. Candidates are verified by edit distance. A word's form is its near word with the largest
   count; roots are found by doubling the steps, as counts at least double along a chain.

Nulls: a null text has no words; a null id counts as the empty text in the deletion rule. Rows
that stand twice count twice. Ties between forms: the smallest word in code-point order. Words
may be of any length. Empty tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotlake.llm.common import cut, ship, text_of

ship(__name__)

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST = 5
OFTEN = 3
SPOILED = 97
SHORT = 3
LONG = 5
PRUNE = 500
SIZE = 50_000
FIRST, LAST = "\x01", "\x02"


def words_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """word, n: the words of all texts with their counts."""
    key = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    lower = F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(key.alias("id"), F.explode(F.regexp_extract_all(text_of(text_column), F.lit(RUN), F.lit(0))).alias("raw")).select(
        "id", F.when(F.lower("raw") == F.col("raw"), F.col("raw")).otherwise(lower).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    spoiled = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + F.lit(2), F.length("run")))
    word = F.when(h % SPOILED == 0, spoiled).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= LEAST).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OFTEN)


def frequent_grams(words: DataFrame, prune: int, size: int) -> list[str]:
    """Grams to extend: the ``size`` most frequent of those with more than ``prune`` places, shorter ones first."""
    marked = F.concat(F.lit(FIRST), "word", F.lit(LAST))
    grams = [words.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") + F.lit(3 - width)), lambda at: F.substring(marked, at, F.lit(width)))).alias("gram"))
        for width in range(SHORT, LONG)]
    every = grams[0]
    for more in grams[1:]:
        every = every.unionAll(more)
    counted = every.groupBy("gram").agg(F.count("*").alias("places")).where(F.col("places") > prune)
    return [row[0] for row in counted.orderBy(F.desc("places"), F.length("gram"), "gram").limit(size).collect()]


class Dictionary:
    """The grams of a dictionary, given those that are extended."""

    def __init__(self, extended: list[str]):
        self.extended = set(extended)
        self.inner = {gram[at:] for gram in extended for at in range(1, len(gram))}

    def grams(self, word: str) -> list[tuple[int, int]]:
        """Begin and end of the grams of a word."""
        out, last = [], 0
        for at in range(len(word) - SHORT + 1):
            end = at + SHORT
            while end < len(word) and end - at < LONG and word[at:end] in self.extended:
                end += 1
            if end > last:
                out.append((at, end))
                last = end
        return out

    def may_grow(self, part: str) -> bool:
        """Whether a longer gram begins with ``part``."""
        return len(part) < SHORT or len(part) < LONG and part in self.extended

    def may_be_covered(self, part: str) -> bool:
        """Whether a gram holds ``part`` with something before it."""
        return len(part) < SHORT or part in self.inner or part[:-1] in self.inner

    def bound(self, word: str, grams: list[tuple[int, int]]) -> int:
        """How many grams any word at one edit from this one has in common with it, at least."""
        least = len(grams)
        for edit in range(1, len(word)):  # the marks at both ends stay
            # before the edit: grams that begin where, or behind where, one could grow over it
            grow = next((at for at in range(max(0, edit - LONG + 1), edit) if self.may_grow(word[at:edit])), edit)
            before = sum(end <= edit and at < grow for at, end in grams)
            for behind in ((edit,) if edit == len(word) - 1 else (edit, edit + 1)):  # inserted; replaced or deleted
                covered = next((end for end in range(min(len(word), behind + LONG - 1), behind, -1)
                                if self.may_be_covered(word[behind:end])), behind)
                least = min(least, before + sum(at >= behind and end > covered for at, end in grams))
        return least


def indexing(extended):
    """word, n become word, n, bound, and the begins and texts of its grams."""
    def index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(extended.value)
        for batch in batches:
            bounds, begins, texts = [], [], []
            for word in batch.column(0).to_pylist():
                word = FIRST + word + LAST
                grams = dictionary.grams(word)
                bounds.append(dictionary.bound(word, grams))
                begins.append([at for at, _ in grams])
                texts.append([word[at:end] for at, end in grams])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(bounds, pa.int32()), pa.array(begins, pa.list_(pa.int32())),
                pa.array(texts, pa.list_(pa.string()))], names=["word", "n", "bound", "begins", "grams"])
    return index_batches


def gram_index(words: DataFrame, prune: int = PRUNE, size: int = SIZE) -> DataFrame:
    """word, n, bound, begins and grams of every word."""
    extended = words.sparkSession.sparkContext.broadcast(frequent_grams(words, prune, size))
    return words.select("word", "n").mapInArrow(
        indexing(extended), "word string, n bigint, bound int, begins array<int>, grams array<string>")


def letters(word: Column) -> Column:
    """The word's code points as a set of 64 bits."""
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))


def met(one: DataFrame, two: DataFrame, keys: list[str], ordered: Column | bool = True) -> DataFrame:
    """one, two: words that agree in the keys and are one edit apart. A different letter more or less rules most out."""
    two = two.select(F.col("word").alias("two"), F.col("letters").alias("two_letters"), *keys)
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("two_letters"))) <= 2
    return one.withColumnRenamed("word", "one").join(two, keys).where(
        F.lit(ordered) & alike & (F.levenshtein("one", "two", 1) == 1)).select("one", "two")


def near_pairs(index: DataFrame) -> DataFrame:
    """one, two: the words that are one edit apart, the shorter one (of equal lengths the smaller one) first."""
    postings = index.select("word", "bound", F.explode(F.arrays_zip("begins", "grams")).alias("g")).select(
        "word", "bound", F.col("g.begins").alias("at"), F.col("g.grams").alias("gram"))
    lists = postings.groupBy("gram").agg(F.count("*").alias("size"))
    # of a word's grams, the rarest come first; all but bound - 1 of them are looked up
    ranked = postings.join(lists, "gram").groupBy("word", "bound").agg(
        F.sort_array(F.collect_list(F.struct("size", "gram", "at"))).alias("grams"))
    chosen = cut(ranked.select("word", letters(F.col("word")).alias("letters"), F.length("word").alias("length"), F.explode(
        F.slice("grams", F.lit(1), F.size("grams") - F.greatest("bound", F.lit(1)) + 1)).alias("g")).select(
        "word", "letters", "length", "g.gram", "g.at"), "postings")
    keys, smaller = ["gram", "length", "at"], F.col("one") < F.col("two")
    # the longer word has the gram at the same place, or one further on
    longer = chosen.select("word", "letters", "gram", (F.col("length") - 1).alias("length"),
                           F.explode(F.array(F.col("at"), F.col("at") - 1)).alias("at"))
    loose = index.where("bound <= 0").select("word", letters(F.col("word")).alias("letters"), F.length("word").alias("length"))
    left = loose.select("*", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word")), lambda at: F.concat(
            F.substring("word", F.lit(1), at - 1), F.substring("word", at + 1, F.length("word")))))).alias("left"))
    whole = loose.withColumn("left", F.col("word"))
    pairs = met(chosen, chosen, keys, smaller).unionAll(met(chosen, longer, keys)).unionAll(
        met(left, left, ["left", "length"], smaller)).unionAll(met(whole, left, ["left"]))
    return pairs.distinct()


def roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root of words that have a form: the end of the chain of forms.

    Counts at least double with every step, so after k rounds of doubling 2**k steps are taken.
    """
    steps = max(1, (max(most, 1) // OFTEN).bit_length())
    chain = forms.select("word", F.col("form").alias("root"))
    for _ in range((steps - 1).bit_length()):
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = cut(chain.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return chain


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prune: int = PRUNE, size: int = SIZE,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = cut(words_of(docs, id_column, text_column), "words")
    pairs = cut(near_pairs(cut(gram_index(words, prune, size), "grams")), "near-words")
    both = pairs.select(F.col("one").alias("word"), F.col("two").alias("other")).unionAll(
        pairs.select(F.col("two").alias("word"), F.col("one").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    found = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.minus")).alias("n"))).alias("f"),
    ).select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    ends = roots(found.where("form is not null"), most)
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
