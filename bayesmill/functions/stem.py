"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980)
and the lemma + stem term normalisation job.

The stemmer is a small per-word helper, run as a vectorised pandas UDF on the
*distinct* terms only (``normalize_terms``).
"""

from __future__ import annotations

import functools
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# ship this module with the UDFs (no install needed on executors)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The suffix rules of the published algorithm, steps 2, 3, 4.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize")


def _cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in "aeiou":
        return False
    if ch == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of vowel-consonant sequences in ``stem``."""
    n, i, L = 0, 0, len(stem)
    while i < L and _cons(stem, i):
        i += 1
    while i < L:
        while i < L and not _cons(stem, i):
            i += 1
        if i >= L:
            break
        n += 1
        while i < L and _cons(stem, i):
            i += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


@functools.lru_cache(maxsize=1 << 16)
def porter_stem(word: str) -> str:
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _m(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if _m(w[:-len(suf)]) > 0:
                w = w[:-len(suf)] + rep
            break
    # step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if _m(w[:-len(suf)]) > 0:
                w = w[:-len(suf)] + rep
            break
    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            stem = w[:-len(suf)]
            if _m(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _m(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    if _m(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


@pandas_udf(StringType())
def stem(words: pd.Series) -> pd.Series:
    return words.map(lambda x: None if x is None else porter_stem(x))


def normalize_terms(terms: DataFrame, term_col: str = "term",
                    lemmas: DataFrame | dict[str, str] | None = None) -> DataFrame:
    """``(term, norm, n long)`` for the distinct terms, with the rows each has: lemma (user
    table ``(form, lemma)`` or a dictionary, unchanged when absent; of several lemmas the
    smallest) then Porter stem. The stemmer sees each distinct term once; callers
    join the result back on ``term``.
    """
    d = terms.groupBy(F.col(term_col).alias("term")).agg(F.count(F.lit(1)).alias("n"))
    base = F.col("term")
    if lemmas is not None:
        if isinstance(lemmas, dict):
            lemmas = terms.sparkSession.createDataFrame(list(lemmas.items()), "form string, lemma string")
        lem = lemmas.groupBy(F.col("form").alias("term")).agg(F.min("lemma").alias("lemma"))
        d = d.join(lem, "term", "left")
        base = F.coalesce("lemma", "term")
    return d.select("term", stem(base).alias("norm"), "n")
