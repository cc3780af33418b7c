"""Text normalisers as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that text from sheets and pages carries at its ends, no-break and ideographic spaces included.
EDGE_SPACE = r"^[\s\x{00a0}\x{3000}]+|[\s\x{00a0}\x{3000}]+$"

#: Separators of multi-valued cells.
LIST_SEPARATORS = "[、，；,;]+"

# Words without weight in an institution's canonical name, and punctuation read as a space.
CANONICAL_STOP_WORDS = ("university", "universiti", "college", "the", "of", "at", "and", "school", "in", "for", "institute", "technological", "technology", "national", "state", "federal")
WIDE_PUNCTUATION = "（）【】《》“”‘’，。；！￥、"
# Words dropped from names before a fuzzy comparison, and short forms written out.
FUZZY_STOP_WORDS = ("university", "college", "institute", "school", "of", "the", "and", "&")
SHORT_FORMS = (
    ("mit", "massachusetts institute technology"),
    ("ucl", "university college london"),
    ("nyu", "new york university"),
    ("ucla", "university california los angeles"),
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def edge_strip(c: Column | str) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(col(c), EDGE_SPACE, "")


def blank_to_null(c: Column | str) -> Column:
    """Stripped text; null where nothing is left."""
    return F.nullif(edge_strip(c), F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often, and in whatever lambda, f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def split_list(c: Column | str, separators: str = LIST_SEPARATORS) -> Column:
    """Parts of a multi-valued cell, stripped, without blanks; an empty array for null."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), separators), edge_strip)
    return F.filter(parts, lambda x: x != "")


def tokens(c: Column | str) -> Column:
    """Words between white space."""
    return F.filter(F.split(col(c), r"[\s\x{00a0}\x{3000}]+"), lambda x: x != "")


def without(words: Column, stop: Iterable[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(*stop))


def canonical_name(c: Column | str, stop: Iterable[str] = CANONICAL_STOP_WORDS) -> Column:
    """Lower-cased words without punctuation and stop words, joined by a space."""
    plain = F.translate(col(c), WIDE_PUNCTUATION, " " * len(WIDE_PUNCTUATION))
    plain = F.regexp_replace(F.lower(plain), r"[()'`.,\-]", " ")
    return F.array_join(without(tokens(plain), stop), " ")


def acronym(c: Column | str) -> Column:
    """All capitals A to Z of a name; '' if it has none."""
    return F.array_join(F.regexp_extract_all(col(c), F.lit("[A-Z]"), 0), "")


def fuzzy_name(c: Column | str, stop: Iterable[str] = FUZZY_STOP_WORDS, short_forms: Iterable[tuple[str, str]] = SHORT_FORMS, compat: bool = False) -> Column:
    """A name prepared for fuzzy comparison.

    Short forms are written out where they stand as whole words; with compat also inside other words."""
    out = F.array_join(without(tokens(F.lower(col(c))), stop), " ")
    for short, full in short_forms:
        out = F.replace(out, F.lit(short), F.lit(full)) if compat else F.regexp_replace(out, rf"\b{short}\b", full)
    return out


def subject_column(c: Column | str, prefix: str = "qs_2026_", suffix: str = "_rank") -> Column:
    """A subject's name as a column name."""
    out = F.replace(F.lower(col(c)), F.lit("&"), F.lit("and"))
    out = F.regexp_replace(F.regexp_replace(out, "[ /-]", "_"), "[$.,()'\"]", "")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_+|_+$", "")
    return F.concat(F.lit(prefix), out, F.lit(suffix))


def file_name(c: Column | str, longest: int = 50) -> Column:
    """Text as a safe file name; 'unknown' if nothing is left."""
    out = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[^\p{L}\p{N}_\s\-]", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[-\s]+", "_"), "^_+|_+$", "")
    out = F.substring(out, 1, longest)
    return F.when(out == "", "unknown").otherwise(out)


def file_stem(c: Column | str) -> Column:
    """Name of a file without folders and its last extension."""
    return F.regexp_replace(F.substring_index(col(c), "/", -1), r"(?<=.)\.[^.]*$", "")


def before_first(c: Column | str, separator: str = "_") -> Column:
    return F.substring_index(col(c), separator, 1)


def after_last(c: Column | str, separator: str = "_") -> Column:
    return F.substring_index(col(c), separator, -1)


def classifier_text(c: Column | str) -> Column:
    """Text for a classifier: heading marks dropped, signs to spaces, white space squeezed, lower case."""
    out = F.replace(F.coalesce(col(c), F.lit("")), F.lit("[HEADING]"), F.lit(""))
    out = F.regexp_replace(out, r"[^\p{L}\p{N}_\s]", " ")
    return F.lower(F.trim(F.regexp_replace(out, r"\s+", " ")))


def append_line(note: Column | str, more: Column | str) -> Column:
    """more on a new line of note; either alone if the other is blank."""
    return F.concat_ws("\n", F.nullif(col(note), F.lit("")), F.nullif(col(more), F.lit("")))


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """True if any of the words (lower case) stands in the lower-cased text."""
    low, out = F.lower(F.coalesce(col(c), F.lit(""))), F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def count_present(c: Column | str, words: Iterable[str]) -> Column:
    """How many of the words (lower case) stand in the lower-cased text."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    return F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)))


def first_present(c: Column | str, words: Iterable[str]) -> Column:
    """The first of the words, in their order, that stands in the lower-cased text; null if none."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    return F.try_element_at(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)), F.lit(1))


def first_mapped(c: Column | str, mapping: Iterable[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The value of the first key, in order, that stands in the text whatever its case."""
    low, out = F.lower(F.coalesce(col(c), F.lit(""))), None
    for key, value in mapping:
        hit = F.contains(low, F.lit(key.lower()))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise) if out is not None else F.lit(None).cast("string")
