"""Shared by the tests of the text operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "an er in on th re ha st en ti ou la do mi ra el vo ka su ne".split()


class Writer:
    """Reproducible prose from a few syllables."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def word(self) -> str:
        return "".join(self.draw.choice(SYLLABLES) for _ in range(self.draw.randint(2, 4)))

    def sentence(self, words: int | None = None) -> str:
        return " ".join(self.word() for _ in range(words or self.draw.randint(4, 14))).capitalize() + "."

    def text(self, sentences: int) -> str:
        return " ".join(self.sentence() + ("\n" if self.draw.random() < 0.2 else "") for _ in range(sentences))


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=repr)
