"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words without the punctuation around them, in
lower case, where numbers, units and names (a capitalised word inside a sentence) are
replaced by typed placeholders. Windows of WINDOW tokens are hashed, and the windows of all
documents are joined with those of the benchmark by hash. The benchmark brings each item in
two views, as template and with its names left as words, so that copies in lower case are
found too; windows that are mostly placeholders are left out of these. A third view holds the
words themselves, numbers included, in lower case; the documents' windows of words meet it, so
what is verbatim is found whatever it consists of, and needs no check of slots. A fourth view
is the template with a capitalised first word as a name, which it becomes in a document where
no sentence ends before it.

A document repeats an item if windows for at least RUN tokens (or all of the item) match at
one offset, and if the slots are consistent: within the matched stretch, or within a run of
consecutive matched windows of that length, every value of the item stands for one value of
the document and the other way round. Questions with other numbers, units or names are thus
caught, chance matches of the frame are not.

Documents' windows meet only the distinct hashes of benchmark windows, one long each; Spark
broadcasts these if it finds them small enough. A hot passage costs one row per place.

Nulls: a null text has no windows, an item without text or id is ignored, a document without
id is found under a null id. Items of fewer than WINDOW tokens are compared as one window,
those of fewer than LEAST tokens by their words only. Repeated rows give the same row
once. Empty tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotlake.llm.common import SPACE, cut, let, text_of

WINDOW = 8
RUN = 13
LEAST = 5
EXACT = 2  # the view of an item by its words
EDGES = ".,;:!?\"'()[]{}<>|*#$%&~`“”‘’¿¡"
# Unit words that a re-parameterised question may exchange.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce "
    "ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days "
    "week weeks month months year years cent cents dollar dollars euro euros percent degree degrees"
).split()


def raw_words(text: Column) -> Column:
    """Words by white space; a line feed ends a sentence."""
    return F.split(F.replace(text, F.lit("\n"), F.lit(" . ")), f"{SPACE}+", -1)


def bare_words(raw: Column) -> Column:
    return F.transform(raw, lambda word: F.btrim(word, F.lit(EDGES)))


def with_small(bare: Column) -> Column:
    """word and small (in lower case) of every word, so that a word is put in lower case once."""
    return F.transform(bare, lambda word: F.struct(word.alias("word"), F.lower(word).alias("small")))


def is_numeral(word: Column) -> Column:
    """A number, perhaps with a short unit; the two comparisons say that the first byte is a digit."""
    return (word < ":") & (word >= "0") & word.rlike(r"^[0-9][0-9.,:/-]*\p{L}{0,2}$")


def template_token(raw: Column, word: Column, small: Column, place: Column) -> Column:
    """The placeholder of a number, unit or name, otherwise the word in lower case."""
    before = F.substring(F.get(raw, place - 1), -1, 1)
    is_name = (
        (word != small) & (place > 0) & (F.length(word) > 1)
        & (F.substring(word, 2, 1 << 30) == F.substring(small, 2, 1 << 30)) & ~before.isin(".", "!", "?", ":"))
    return F.when(is_numeral(word), "<num>").when(is_name, "<name>").when(small.isin(UNITS), "<unit>").otherwise(small)


def literal_token(raw: Column, word: Column, small: Column, place: Column) -> Column:
    """As ``template_token`` for a text in lower case: names stay words."""
    return F.when(is_numeral(word), "<num>").when(small.isin(UNITS), "<unit>").otherwise(small)


def exact_token(raw: Column, word: Column, small: Column, place: Column) -> Column:
    """The word in lower case."""
    return small


def opening_token(raw: Column, word: Column, small: Column, place: Column) -> Column:
    """As ``template_token`` for a text that stands inside a sentence: its first word may be a name."""
    is_name = (place == 0) & (word != small) & (F.length(word) > 1) & (
        F.substring(word, 2, 1 << 30) == F.substring(small, 2, 1 << 30))
    return F.when(is_name, "<name>").otherwise(template_token(raw, word, small, place))


def windows(tokens: Column, length: int) -> Column:
    """The hash of every window of ``length`` token hashes, in order."""
    last = F.size(tokens) - length
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(
        F.slice(tokens, at + 1, F.lit(length))))).otherwise(F.array().cast("array<bigint>"))


def items_of(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """item, view, tokens (text and bare word) of every usable item."""
    split = benchmark.where(F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").alias("item"), raw_words(text_of(text_column)).alias("raw")).select(
        "item", "raw", bare_words(F.col("raw")).alias("bare"))

    def view(number: int, form) -> Column:
        tokens = F.transform(with_small(F.col("bare")), lambda one, at: F.struct(
            form(F.col("raw"), one["word"], one["small"], at).alias("token"), one["word"].alias("word")))
        return F.struct(F.lit(number).alias("view"), F.filter(tokens, lambda t: t["word"] != "").alias("tokens"))

    views = [view(0, template_token), view(1, literal_token), view(EXACT, exact_token), view(3, opening_token)]
    return split.select("item", F.explode(F.array(*views)).alias("one")).select("item", "one.*").where(
        F.size("tokens") >= F.when(F.col("view") == EXACT, 1).otherwise(LEAST)).distinct()


def is_slot(token: Column) -> Column:
    return token.isin("<num>", "<name>", "<unit>")


def item_windows(items: DataFrame) -> DataFrame:
    """hash, length, item, view, place, rank among the usable windows, and how many windows the item has."""
    hashes = F.transform("tokens", lambda t: F.xxhash64(t["token"]))
    length = F.least(F.size("tokens"), F.lit(WINDOW))
    plain = items.select("item", "view", "tokens", hashes.alias("hashes"), length.alias("length"))
    exploded = plain.select("item", "view", "tokens", "length", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("hashes") - F.col("length")),
        lambda at: F.xxhash64(F.slice("hashes", at + 1, F.col("length"))))).alias("place", "hash"))
    slots = F.size(F.filter(F.slice("tokens", F.col("place") + 1, F.col("length")), lambda t: is_slot(t["token"])))
    usable = exploded.where(slots * 2 <= F.col("length")).select("hash", "length", "item", "view", "place", F.dense_rank().over(
        Window.partitionBy("item", "view").orderBy("place")).alias("rank"))
    number = usable.groupBy("item", "view").agg(F.count(F.lit(1)).alias("n_item"))
    return usable.join(number, ["item", "view"])


def document_tokens(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id and the hashes of the template tokens and of the words; words of punctuation only are left out."""
    return docs.select(F.col(f"`{id_column}`").alias("id"), raw_words(text_of(text_column)).alias("raw")).select(
        "id", "raw", bare_words(F.col("raw")).alias("bare")).select("id", F.filter(F.transform(
            with_small(F.col("bare")), lambda one, at: F.when(one["word"] != "", F.struct(
                F.xxhash64(template_token(F.col("raw"), one["word"], one["small"], at)).alias("hash"),
                F.xxhash64(one["small"]).alias("word")))),
            lambda t: t.isNotNull()).alias("tokens")).select(
        "id", F.col("tokens.hash").alias("hashes"), F.col("tokens.word").alias("words"))


def leaked_items(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """id, item, n_windows, n_slots and changed_slots of every item that a document repeats."""
    items = cut(items_of(benchmark, item_column, item_text_column), "items")
    keys = cut(item_windows(items), "item-windows")
    lengths = sorted(row[0] for row in keys.select("length").distinct().collect()) or [WINDOW]  # up to WINDOW
    hashed = document_tokens(docs, id_column, text_column).select("id", *[column for n in lengths for column in (
        let(F.col("hashes"), lambda held: windows(held, n)).alias(f"t{n}"),
        let(F.col("words"), lambda held: windows(held, n)).alias(f"w{n}"))])

    def placed(column: Column | str) -> Column:
        return F.transform(column, lambda h, at: F.struct(h.alias("hash"), at.alias("at")))

    def other(n: int) -> Column:
        """Windows of words that are not the same as template."""
        differing = F.zip_with(f"t{n}", f"w{n}", lambda t, w: F.when(t != w, w))
        return F.filter(placed(differing), lambda w: w["hash"].isNotNull())

    places = F.explode(F.concat(*[part for n in lengths for part in (placed(f"t{n}"), other(n))]))
    seen = hashed.select("id", places.alias("one")).select("id", "one.hash", "one.at")
    distinct = cut(keys.select("hash").distinct(), "window-hashes")
    met = cut(seen.join(distinct, "hash", "left_semi"), "met-windows")
    stretches = met.join(keys, "hash").groupBy(
        "id", "item", "view", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.array_sort(F.collect_set(F.struct("rank", "place", "length"))).alias("windows"), F.first("n_item").alias("n_item"))
    enough = F.least(F.col("n_item"), F.lit(RUN - WINDOW + 1))
    long = stretches.where(F.size("windows") >= enough)
    # a stretch is taken whole and by its runs of consecutive windows: a gap spoils the slots of its neighbours only
    one = long.select("id", "item", "view", "shift", "n_item", F.posexplode("windows").alias("number", "w"))
    bounds = [F.count(F.lit(1)).alias("n_windows"), F.min("w.place").alias("first"),
              F.max(F.col("w.place") + F.col("w.length")).alias("end"), F.first("n_item").alias("n_item")]
    runs = one.groupBy("id", "item", "view", "shift", (F.col("w.rank") - F.col("number")).alias("run")).agg(*bounds).drop("run")
    whole = long.select(
        "id", "item", "view", "shift", F.size("windows").cast("long").alias("n_windows"),
        F.get("windows", F.lit(0))["place"].alias("first"),
        F.array_max(F.transform("windows", lambda w: w["place"] + w["length"])).alias("end"), "n_item")
    candidates = cut(whole.unionByName(runs.where(F.col("n_windows") >= enough)).distinct(), "stretches")

    # the slots of the stretch, in the item and in the document
    inside = F.filter(F.transform("tokens", lambda token, at: F.struct(
        token["token"].alias("token"), (at + F.col("shift")).alias("at"), at.alias("place"), F.lower(token["word"]).alias("item"))),
        lambda s: is_slot(s["token"]) & (s["place"] >= F.col("first")) & (s["place"] < F.col("end")))
    with_item = cut(candidates.join(items, ["item", "view"]).select(
        "id", "item", "n_windows", inside.alias("slots")), "candidates")
    result = [F.col("id"), F.col("item"), "n_windows"]
    literal = with_item.where(F.size("slots") == 0).select(*result, F.lit(0).alias("n_slots"), F.lit(0).alias("changed_slots"))
    # only stretches with slots need the words of their documents
    c = with_item.where(F.size("slots") > 0).alias("c")
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text_column).alias("text")).alias("t")
    words = F.filter(bare_words(raw_words(F.col("t.text"))), lambda word: word != "")
    filled = c.join(texts, F.col("c.id").eqNullSafe(F.col("t.id"))).select("c.*", let(words, lambda held: F.transform(
        "c.slots", lambda s: F.struct(s["token"], s["item"], F.lower(F.get(held, s["at"])).alias("doc")))).alias("pairs"))
    there = F.transform("pairs", lambda s: F.struct(s["token"], s["item"]))
    here = F.transform("pairs", lambda s: F.struct(s["token"], s["doc"]))
    number = F.size(F.array_distinct("pairs"))
    consistent = (number == F.size(F.array_distinct(there))) & (number == F.size(F.array_distinct(here)))
    changed = F.size(F.filter("pairs", lambda s: s["item"] != s["doc"]))
    slotted = filled.where(consistent).select(*result, F.size("pairs").alias("n_slots"), changed.alias("changed_slots"))
    return literal.unionAll(slotted).groupBy("id", "item").agg(
        F.max(F.struct("n_windows", "n_slots", "changed_slots")).alias("best")).select(
        F.col("id").alias(id_column), F.col("item").alias(item_column), "best.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the documents that repeat a benchmark item."""
    found = cut(leaked_items(docs, benchmark, id_column, **names).select(F.col(id_column).alias("id")).distinct(), "leaks")
    return docs.join(found, docs[id_column].eqNullSafe(found["id"]), "left_anti")
