"""Column expressions for text: clean, tokenise, stop words, n-grams, bags.

Every function returns a built-in Spark expression (JVM side); nothing here
runs Python per row. Arrays are guarded so that short texts give empty
arrays, never errors under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.functions.stopwords import default_stop_words

# Fixed values of the text cleaner: keep ASCII letters and the space; line
# breaks become spaces first (the reference reads one line per document, so
# its lines never hold them); every other character is deleted, not blanked.
LINE_BREAKS = "[\r\n]"
NOT_LETTER_OR_SPACE = "[^a-zA-Z ]"
SPACES = " +"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Delete everything but ``[a-zA-Z ]`` (after line breaks -> space), then lower-case."""
    t = F.regexp_replace(_col(text), LINE_BREAKS, " ")
    t = F.regexp_replace(t, NOT_LETTER_OR_SPACE, "")
    return F.lower(t)


def tokenize(text: Column | str) -> Column:
    """Clean, split on runs of spaces, drop empty tokens -> ``array<string>``."""
    parts = F.split(clean_text(text), SPACES)
    return F.array_remove(parts, "")


def remove_stop_words(tokens: Column | str, stop_words: Iterable[str] | None = None) -> Column:
    """Drop tokens found in ``stop_words`` (default: Spark ML's English list).

    The membership test compiles to a hash ``INSET`` inside the lambda.
    """
    words = default_stop_words() if stop_words is None else tuple(stop_words)
    words = tuple(w for w in words if w)
    if not words:
        return _col(tokens)
    return F.filter(_col(tokens), lambda x: ~x.isin(*words))


def filtered_tokens(text: Column | str, stop_words: Iterable[str] | None = None) -> Column:
    """``remove_stop_words(tokenize(text))`` with both tests in one filter lambda."""
    words = default_stop_words() if stop_words is None else tuple(stop_words)
    words = tuple(w for w in words if w)
    parts = F.split(clean_text(text), SPACES)
    if not words:
        return F.array_remove(parts, "")
    return F.filter(parts, lambda x: (x != "") & ~x.isin(*words))


def ngrams(tokens: Column | str, n: int, sep: str = "") -> Column:
    """Adjacent n-grams of a token array, joined with ``sep`` (default: no separator).

    Texts shorter than ``n`` tokens give an empty array. ``tokens`` must be a
    column reference (see ``with_terms``), not a computed expression.
    """
    t = _col(tokens)
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return t
    if n == 2:
        # pairs of neighbours: the array against itself shifted by one
        size = F.size(t)
        pairs = F.zip_with(F.slice(t, 1, size - 1), F.slice(t, 2, size - 1),
                           (lambda a, b: F.concat(a, b)) if sep == "" else (lambda a, b: F.concat_ws(sep, a, b)))
        return F.when(size < 2, F.array().cast("array<string>")).otherwise(pairs)
    # element_at is 1-based; each gram is the concatenation of n neighbours
    grams = F.transform(
        F.sequence(F.lit(1), F.size(t) - n + 1),
        lambda i: F.concat_ws(sep, *[F.element_at(t, i + k) for k in range(n)]),
    )
    return F.when(F.size(t) < n, F.array().cast("array<string>")).otherwise(grams)


def bigrams(tokens: Column | str, sep: str = "") -> Column:
    return ngrams(tokens, 2, sep)


def term_bag(tokens: Column | str, grams: Sequence[int] = (1, 2), sep: str = "") -> Column:
    """All n-grams for each n in ``grams`` in one array; repeats are kept."""
    parts = [ngrams(tokens, n, sep) for n in sorted(set(grams))]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def with_terms(df: DataFrame, text_col: str = "text", out_col: str = "terms",
               stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2),
               sep: str = "", drop_text: bool = True) -> DataFrame:
    """Full text front end as staged projections: clean -> split -> lower ->
    stop words -> n-gram bag in ``out_col``.

    The token array is materialised in its own projection first. The n-gram
    lambdas then read a column reference; composing the tokenizer expression
    straight into them would re-run it for every element (quadratic per
    document).
    """
    tok = "_tokens"
    keep = [c for c in df.columns if not (drop_text and c == text_col)]
    staged = df.select(*keep, filtered_tokens(text_col, stop_words).alias(tok))
    return staged.select(*keep, term_bag(F.col(tok), grams, sep).alias(out_col))
