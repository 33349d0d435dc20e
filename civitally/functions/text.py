"""Text parsing, tidying and ordered rules as Spark columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .choice import first_of

# A place where no letter, digit or underscore stands before, in any script.
WORD_START = r"(?<![\p{L}\p{N}_])"

Words = Sequence[str]
CategoryRules = Sequence[tuple[str, Words]]
AliasRules = Sequence[tuple[str, str]]


def parse_ts(column: str | Column, fmt: str) -> Column:
    """Timestamp in the given format; text that does not fit becomes NULL."""
    return F.try_to_timestamp(_col(column), F.lit(fmt))


def parse_bool(column: str | Column) -> Column:
    """true / false in any case with outer spaces; anything else becomes NULL."""
    text = F.lower(F.trim(_col(column)))
    return F.when(text == "true", True).when(text == "false", False)


def parse_int(column: str | Column) -> Column:
    """Integer from text that may carry a fraction (``32.0``, half rounds away from zero)."""
    number = F.round(_col(column).try_cast("double"))
    return number.try_cast("int")


def tidy_text(column: str | Column) -> Column:
    """Drop spaces round ``/`` and at the ends."""
    return F.trim(F.regexp_replace(_col(column), r"\s*/\s*", "/"))


def any_word(words: Words, prefix: str = "") -> str:
    """Case-insensitive pattern that finds any of the words inside a text."""
    return f"(?i){prefix}(" + "|".join(re.escape(w).replace(r"\ ", " ") for w in words) + ")"


def not_containing(column: str | Column, words: Words) -> Column:
    """True where no word occurs. A NULL text is not true, so a filter drops it too."""
    return ~_col(column).rlike(any_word(words))


def has_text(column: str | Column) -> Column:
    return _col(column).isNotNull() & (_col(column) != "")


def classify(column: str | Column, rules: CategoryRules, default: str) -> Column:
    """Category of the first rule with a word contained in the text, whatever the case.

    Words match inside longer words: HOUSE is found in WAREHOUSE. NULL gets the default.
    """
    text = _col(column)
    chain = []
    for name, words in rules:
        chain.append((text.rlike(any_word(words)), name))
    return first_of(chain, default)


def classify_values(column: str | Column, groups: CategoryRules, default: str) -> Column:
    """Group of the first value list holding exactly this value."""
    value = _col(column)
    chain = []
    for name, values in groups:
        chain.append((value.isin(list(values)), name))
    return first_of(chain, default)


def normalize_label(
    column: str | Column,
    punctuation: AliasRules = fv.LABEL_PUNCTUATION,
    aliases: AliasRules = fv.LABEL_ALIASES,
) -> Column:
    """Canonical label: upper case, then punctuation and alias rules one after the other.

    Costs one regex pass per rule, so apply it to distinct labels (``sum_by_label``).
    """
    text = F.trim(F.upper(_col(column)))
    for pattern, replacement in (*punctuation, *aliases):
        text = F.regexp_replace(text, pattern, replacement)
    return text


def first_contained(column: str | Column, words: Words) -> Column:
    """First listed word contained in the lower-cased text, in upper case; NULL if none."""
    text = F.lower(_col(column))
    chain = []
    for word in words:
        chain.append((text.contains(word), word.upper()))
    return first_of(chain, F.lit(None).cast("string"))


def route(
    column: str | Column,
    routes: Sequence[tuple[str, Words, str | None]] = fv.QUESTION_ROUTES,
    types: Words = fv.QUESTION_TYPES,
) -> Column:
    """Answer table of the first route with a word that begins like one of its words.

    A route that names a type also needs that type to be the first one contained.
    """
    text = F.lower(_col(column))
    found_type = first_contained(column, types)
    chain = []
    for target, words, needed in routes:
        test = text.rlike(any_word(words, prefix=WORD_START))
        if needed is not None:
            test = (found_type == needed) & test
        chain.append((test, target))
    return first_of(chain, F.lit(None).cast("string"))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
