"""Text rules.

Folding (accents off, upper case, printable ASCII only) needs Unicode decomposition, which
no built-in expression offers. Plain text stays in JVM expressions and only sends a null
through the Arrow exchange; other text is folded there by vectorised kernels, once per
distinct value of a batch. All label columns of one ``select`` share a single exchange.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from spotlake.schemas import MISSING, TIME_WIDTH

# the folding helper travels inside the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The whitespace that Python's str.strip() removes
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Words that stand for a missing value in the batch feeds
NULL_WORDS = ("nan", "None", "")
# Words a stored table may still hold for "missing"
STORED_NULL_WORDS = ("nan", "None", "N/A", "null")

_NON_PRINTABLE = r"[^\x20-\x7E\n]"


def fold_string(value: str) -> str:
    """The folding rule for one string; the Arrow helper and the tests use it."""
    ascii_only = unicodedata.normalize("NFKD", value).upper().encode("ascii", "ignore").decode("ascii")
    return re.sub(_NON_PRINTABLE, "", ascii_only)


def _expanding() -> dict[str, str]:
    """The few characters without decomposition whose upper case has plain letters, such as sharp s."""
    found = {}
    for code in range(0x80, 0x3000):
        upper = chr(code).upper()
        if any(ch < "\x80" for ch in upper) and unicodedata.normalize("NFKD", chr(code)) == chr(code):
            found[chr(code)] = "".join(ch for ch in upper if ch < "\x80")
    return found


_EXPANDING = _expanding()
# Fixed value: letters that are newer than the Unicode version of the rule, which drops them
_NEWER = "[\U0001CCD6-\U0001CCF9]"


@F.arrow_udf(T.StringType())
def _fold_special(values: pa.Array) -> pa.Array:
    encoded = values.dictionary_encode()
    known = pc.replace_substring_regex(encoded.dictionary.cast(pa.string()), pattern=_NEWER, replacement="")
    folded = pc.utf8_normalize(known, form="NFKD")
    for letter, plain in _EXPANDING.items():
        folded = pc.replace_substring(folded, pattern=letter, replacement=plain)
    folded = pc.replace_substring_regex(folded, pattern=_NON_PRINTABLE, replacement="")
    return pc.ascii_upper(folded).take(encoded.indices)


def fold(c: Column) -> Column:
    """Accents off, upper case, nothing outside printable ASCII and newline; null stays null."""
    return F.coalesce(_fold_special(F.when(c.rlike(_NON_PRINTABLE), c)), F.upper(c))


def strip(c: Column) -> Column:
    """Trim every kind of white space, as the batch feeds do (plain ``trim`` cuts spaces only).

    Trimming a set of characters is slow, so only text that starts or ends with one pays.
    """
    ends = list(WHITESPACE)
    padded = F.left(c, F.lit(1)).isin(ends) | F.right(c, F.lit(1)).isin(ends)
    return F.when(padded, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def _or_missing(c: Column, absent: str) -> Column:
    """Null, or text that matches ``absent`` from end to end, becomes the missing marker.

    One regular expression keeps ``c`` (often a long expression) referenced only once.
    """
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"\A(?:{absent})\z", MISSING)


def _words(*words: str) -> str:
    return "|".join(re.escape(w) for w in words)


def cut(c: Column, width: int) -> Column:
    """Live feeds, first step of a label: cut, then trim."""
    return F.trim(F.substring(c.cast("string"), 1, width))


def folded_label(c: Column) -> Column:
    """Live feeds, second step: fold; blank becomes the missing marker."""
    return _or_missing(fold(c), " *")


def label(c: Column, width: int) -> Column:
    return folded_label(cut(c, width))


def fold_unless_marker(c: Column) -> Column:
    """Fold, but let null, the missing marker and the null words through unchanged."""
    return F.when(c.isNull() | c.isin(MISSING, *NULL_WORDS), c).otherwise(fold(c))


def folded_batch_label(c: Column, width: int) -> Column:
    """Catalogue feeds, after trimming: fold, null words become the missing marker, cut last."""
    return F.substring(_or_missing(fold_unless_marker(c), _words(*NULL_WORDS)), 1, width)


def batch_label(c: Column, width: int) -> Column:
    return folded_batch_label(strip(c.cast("string")), width)


def long_text(c: Column, *more_null_words: str) -> Column:
    """Trimmed but otherwise whole text; null words become the missing marker."""
    return _or_missing(strip(c.cast("string")), _words(*NULL_WORDS, *more_null_words))


def optional_text(c: Column) -> Column:
    """Live subtitle rule: trimmed, blank or absent becomes the missing marker."""
    return _or_missing(F.trim(c), "")


def clock_text(c: Column, width: int = TIME_WIDTH) -> Column:
    return F.substring(strip(c.cast("string")), 1, width)


def is_marker(c: Column) -> Column:
    """Stored text that means "missing": null, blank or one of the leftover null words."""
    return c.isNull() | (F.trim(c) == "") | c.isin(*STORED_NULL_WORDS)


def is_named(c: Column) -> Column:
    """A value a ranking may show: neither null nor one of the two stored sentinels."""
    return c.isNotNull() & ~c.isin(MISSING, "")
