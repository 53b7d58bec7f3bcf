"""ANSI/DuckDB SQL fragments for the independent oracle queries.

Each fragment mirrors one Spark expression in ``bayesmill.functions``; the
oracle statements in ``bayesmill.plans`` are built from them so that both
engines apply the same fixed values (class list, cleaner patterns, stop words).
"""

from __future__ import annotations

from collections.abc import Iterable

from bayesmill.functions.stopwords import default_stop_words
from bayesmill.sources.tables import CLASSES, TEST_MODULUS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items: Iterable[str]) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]::VARCHAR[]"


CLASS_LIST = str_list(CLASSES)
CLASS_VALUES = "(VALUES " + ", ".join(f"({q(c)})" for c in CLASSES) + ") AS cls(class)"


def tokens(text: str) -> str:
    cleaned = (f"lower(regexp_replace(regexp_replace({text}, '[\\r\\n]', ' ', 'g'), "
               f"'[^a-zA-Z ]', '', 'g'))")
    return f"list_filter(regexp_split_to_array({cleaned}, ' +'), lambda x: x <> '')"


def stop_filtered(toks: str, stop_words=None) -> str:
    words = default_stop_words() if stop_words is None else tuple(stop_words)
    return f"list_filter({toks}, lambda x: NOT list_contains({str_list(words)}, x))"


def ngrams(t: str, n: int, sep: str = "") -> str:
    if n == 1:
        return t
    parts = ", ".join(f"{t}[i + {k}]" for k in range(n))
    return (f"CASE WHEN len({t}) < {n} THEN []::VARCHAR[] ELSE "
            f"list_transform(range(1, len({t}) - {n} + 2), lambda i: concat_ws({q(sep)}, {parts})) END")


def bag(t: str, grams=(1, 2), sep: str = "") -> str:
    parts = [ngrams(t, n, sep) for n in sorted(set(grams))]
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


TRAIN_WHERE = f"doc_id % {TEST_MODULUS} <> 0"
TEST_WHERE = f"doc_id % {TEST_MODULUS} = 0"

LABEL_LINES = ("SELECT doc_id, concat_ws(',', 'E11', CASE quality WHEN 1 THEN 'HIQ' WHEN 0 THEN 'LOQ' END, "
               "CASE WHEN toxic = 1 THEN 'TOX' END, 'M11', CASE WHEN quality = 1 THEN 'HIQ' END) AS line "
               "FROM labels")

LABEL_SETS = (f"SELECT doc_id, list_sort(list_distinct(list_filter(string_split(coalesce(line, ''), ','), "
              f"lambda x: list_contains({CLASS_LIST}, x)))) AS classes FROM ({LABEL_LINES})")


def text_ctes(where: str, grams=(1, 2), prefix: str = "") -> str:
    """CTEs ``{p}docs, {p}tok, {p}bag, {p}occ, {p}tf`` over ``documents`` filtered by ``where``."""
    p = prefix
    return (
        f"{p}docs AS (SELECT doc_id, text FROM documents WHERE {where}), "
        f"{p}tok AS (SELECT doc_id, {stop_filtered(tokens('text'))} AS t FROM {p}docs), "
        f"{p}bag AS (SELECT doc_id, {bag('t', grams)} AS b FROM {p}tok), "
        f"{p}occ AS (SELECT doc_id, unnest(b) AS term FROM {p}bag), "
        f"{p}tf AS (SELECT doc_id, term, count(*) AS tf FROM {p}occ GROUP BY doc_id, term)"
    )


def nb_ctes() -> str:
    """Naive Bayes fit in plain SQL (dense vocabulary x classes, sum of tf*idf products)."""
    return (
        "WITH " + text_ctes(TRAIN_WHERE) + ", "
        "n AS (SELECT count(*) AS n FROM docs), "
        "dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term), "
        "idf AS (SELECT term, df, ln((n.n + 1.0) / (df + 1.0)) AS idf FROM dfq CROSS JOIN n), "
        f"labsets AS ({LABEL_SETS}), "
        "lab AS (SELECT l.doc_id, unnest(l.classes) AS class FROM labsets l JOIN docs d ON l.doc_id = d.doc_id), "
        f"cls AS (SELECT class FROM {CLASS_VALUES}), "
        "ccount AS (SELECT class, count(*) AS class_docs FROM lab GROUP BY class), "
        "cstat AS (SELECT c.class, coalesce(cc.class_docs, 0) AS class_docs, "
        "  ln(coalesce(cc.class_docs, 0) / sum(coalesce(cc.class_docs, 0)) OVER ()) AS prior "
        "  FROM cls c LEFT JOIN ccount cc ON c.class = cc.class), "
        "res AS (SELECT tf.doc_id, tf.term, tf.tf * idf.idf AS w, lab.class FROM tf "
        "  JOIN idf ON tf.term = idf.term JOIN lab ON tf.doc_id = lab.doc_id), "
        "wq AS (SELECT c.class, (SELECT count(*) FROM res r WHERE r.class = c.class) AS pair_count FROM cls c), "
        "vq AS (SELECT count(*) AS v FROM dfq), "
        "cts AS (SELECT class, term, sum(w) AS x FROM res GROUP BY class, term), "
        "model AS (SELECT d.term, c.class, ln((coalesce(cts.x, 1.0 / (wq.pair_count + vq.v)) + 1.0) "
        "  / (wq.pair_count + vq.v)) AS logp FROM dfq d CROSS JOIN cls c CROSS JOIN vq "
        "  JOIN wq ON wq.class = c.class LEFT JOIN cts ON cts.term = d.term AND cts.class = c.class), "
        + text_ctes(TEST_WHERE, prefix="t_") + ", "
        "scores AS (SELECT o.doc_id, m.class, sum(m.logp) + min(cs.prior) AS score FROM t_occ o "
        "  JOIN model m ON o.term = m.term JOIN cstat cs ON cs.class = m.class GROUP BY o.doc_id, m.class), "
        "pred AS (SELECT doc_id, class AS label FROM (SELECT doc_id, class, row_number() OVER "
        "  (PARTITION BY doc_id ORDER BY score DESC, class) AS rk FROM scores) WHERE rk = 1) "
    )
