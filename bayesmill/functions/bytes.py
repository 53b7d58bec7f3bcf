"""Column expressions for byte-dump files (address + 2-char codes per line)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the byte tokenizer: CRLF becomes a space, tokens are split
# on whitespace and only tokens of exactly two characters are kept (this drops
# the 8-character addresses and keeps the unknown-byte code "??").
TOKEN_LENGTH = 2
ID_LENGTH = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


WHITESPACE = "\\s+"
# whitespace, and whole tokens of one or of three and more characters
NOT_CODES = "\\s+|(?<!\\S)(?:\\S{3,}+|\\S(?!\\S))"


def byte_tokens(content: Column | str) -> Column:
    """Whitespace tokens of exactly two characters (CRLF counts as whitespace).

    Split on whitespace runs, keep length-two tokens (measured faster than a
    single lookaround regex over the text).
    """
    return F.filter(F.split(_col(content), WHITESPACE), lambda x: F.length(x) == TOKEN_LENGTH)


def byte_string(content: Column | str) -> Column:
    """The two-character tokens concatenated: token i is ``substring(s, 2i+1, 2)``.

    All else is deleted in one pass over the text; a large file never becomes an array of tokens.
    """
    return F.regexp_replace(_col(content), NOT_CODES, "")


def file_id(path: Column | str) -> Column:
    """Last 20 characters of the base name before its first dot (dots in host or folder names don't count)."""
    base = F.substring_index(_col(path), "/", -1)
    stem = F.substring_index(base, ".", 1)
    return F.substring(stem, -ID_LENGTH, ID_LENGTH)
