"""Stop-word list.

The list is a parameter of every text job. The default is Spark ML's English
list, shipped as a plain text file beside this module (see ``data/README.md``)
and read on first use. Apostrophes are removed from each word because the
cleaner deletes them from the text before the test (``don't`` -> ``dont``).
"""

from __future__ import annotations

import functools
from pathlib import Path

DATA = Path(__file__).with_name("data")


def raw_stop_words(lang: str = "english") -> tuple[str, ...]:
    """The words of ``data/stopwords_<lang>.txt`` as they stand in the file."""
    return tuple((DATA / f"stopwords_{lang}.txt").read_text(encoding="utf-8").split())


@functools.lru_cache(maxsize=8)
def default_stop_words(lang: str = "english") -> tuple[str, ...]:
    return tuple(dict.fromkeys(w for w in (x.replace("'", "") for x in raw_stop_words(lang)) if w))
