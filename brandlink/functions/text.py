"""String and array column expressions (inventory X1-X13).

All functions take and return ``Column`` objects and compile to native Spark
expressions, so they run inside whole-stage code generation with no Python
worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import STOPWORDS
from .translit import MULTI, SINGLE

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ascii(c: ColumnOrName) -> Column:
    """Whether a string has as many bytes as characters (quick to tell)."""
    return F.octet_length(_col(c)) == F.char_length(_col(c))


def transliterate(c: ColumnOrName) -> Column:
    """Latin letters with marks, ligatures and sharp s to ASCII."""
    c = _col(c)
    out = c
    for src, dst in MULTI.items():
        out = F.replace(out, F.lit(src), F.lit(dst))
    # the replace chain runs only on the rare strings holding such a letter (a
    # string that is shorter without them)
    rare = F.octet_length(F.translate(c, "".join(MULTI), "")) < F.octet_length(c)
    out = F.when(rare, out).otherwise(c)
    src = "".join(SINGLE.keys())
    dst = "".join(SINGLE.values())
    return F.translate(out, src, dst)


def slug(c: ColumnOrName, replacements: Iterable[tuple[str, str]] = (),
         separator: str = " ", upper: bool = True) -> Column:
    """Slug of a name (X1/X2): user replacements, quotes to separators,
    transliteration, lower case, thousands commas dropped, every run of other
    characters to one separator, trimmed; upper-cased when ``upper``.

    ``slug('M&M''s', [('&','et')])`` is ``METM S``; null stays null.
    """
    reps = list(replacements)
    out = _col(c)
    for old, new in reps:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.replace(out, F.lit("'"), F.lit("-"))
    # a text of ASCII alone has nothing to transliterate; quotes produced by the
    # transliteration vanish instead of separating
    plain = F.replace(transliterate(out), F.lit("'"), F.lit(""))
    if all(new.isascii() for _, new in reps):
        plain = F.when(is_ascii(c), out).otherwise(plain)
    out = F.lower(plain)
    out = F.regexp_replace(out, r",(?<=[0-9],)(?=[0-9])", "")
    out = F.regexp_replace(out, "[^a-z0-9]+", " ")
    out = F.trim(out)
    for old, new in reps:
        out = F.replace(out, F.lit(old), F.lit(new))
    if separator != " ":
        out = F.replace(out, F.lit(" "), F.lit(separator))
    return F.upper(out) if upper else out


def slug_compact(c: ColumnOrName) -> Column:
    """Slug with an empty separator (X3): lower-case letters and digits only."""
    return slug(c, (), separator="", upper=False)


def upper_strip(c: ColumnOrName) -> Column:
    """Upper case, then strip Unicode white space at both ends."""
    return F.regexp_replace(F.upper(_col(c)), r"(?U)^\s+|\s+$", "")


def zfill(c: ColumnOrName, width: int = 13) -> Column:
    """Left-pad with zeros up to ``width``; longer values unchanged."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def byte_length(c: ColumnOrName) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(_col(c))


_PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""


def sentence_words(arr: ColumnOrName) -> Column:
    """List of sentences to list of words (X8): split on white space, drop
    ASCII punctuation inside each word, lower case; empty words dropped."""
    words = F.flatten(F.transform(
        _col(arr), lambda s: F.split(F.trim(s), r"\s+")))
    words = F.transform(words, lambda w: F.lower(F.regexp_replace(w, _PUNCT, "")))
    return F.filter(words, lambda w: F.length(w) > 0)


def distinct_words(arr: ColumnOrName) -> Column:
    """Distinct words in a fixed (sorted) order."""
    return F.array_sort(F.array_distinct(_col(arr)))


def remove_stopwords(arr: ColumnOrName, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Drop words found in the stop list."""
    stop = list(dict.fromkeys(stopwords))  # a literal list: Spark looks words up in a hash set
    return F.filter(_col(arr), lambda w: ~w.isin(stop))


def char_ngrams(c: ColumnOrName, lo: int = 2, hi: int = 5) -> Column:
    """All character n-grams with ``lo <= n <= hi``, in order of n then position
    (X12).  Strings shorter than ``lo`` give an empty array."""
    s = _col(c)
    n_len = F.length(s)
    grams = F.flatten(F.transform(
        F.sequence(F.lit(lo), F.least(F.lit(hi), n_len)),
        lambda n: F.transform(F.sequence(F.lit(1), n_len - n + 1),
                              lambda i: F.substring(s, i, n)),
    ))
    return F.when(n_len >= lo, grams).otherwise(F.array().cast("array<string>"))


def word_tokens(c: ColumnOrName, stopwords: Sequence[str] | None = STOPWORDS,
                min_len: int = 2) -> Column:
    """Word tokens of ``min_len`` or more ASCII letters between word
    boundaries, lower-cased, stop words removed (X13).  A token glued to a
    digit (``7up``) gives nothing."""
    # a run of letters is never given up in part (``}+``); texts of ASCII alone need
    # no Unicode tables to see a boundary
    run = r"\b([a-z]{%d,}+)\b" % min_len
    # the lambda names the string, so that it is made once for all three uses
    toks = F.transform(F.array(F.lower(_col(c))), lambda low: F.when(
        is_ascii(low), F.regexp_extract_all(low, F.lit(run), 1)).otherwise(
        F.regexp_extract_all(low, F.lit("(?U)" + run), 1)))[0]
    if stopwords:
        toks = remove_stopwords(toks, stopwords)
    return toks


def first_number(c: ColumnOrName) -> Column:
    """First run of digits in a string, null when there is none."""
    d = F.regexp_extract(_col(c), "[0-9]+", 0)
    return F.when(d != "", d)
