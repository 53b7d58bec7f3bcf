"""Source divergence audit: hash-consed segment trees of term counts, whose node pairs are priced once.

Tasks count terms by (lang, source) as they read whole texts, so only sums are shuffled. A language keeps the terms that
LEAST_DOCS of its documents or more hold; every (lang, source) group, and the language as one, gives each kept term the
smoothed frequency p = 1 + floor(SCALE * (count + 1) / (N + V)). Two frequencies differ by floor((p - q)^2 / q).

For sources against each other, a language's terms are dealt into blocks by hash. A block's task builds one segment tree
a group over its terms, most frequent first; equal subtrees of counts are one node, whichever group or place they come
from, so the long runs of zeros of small groups fold into a few nodes. A pair of trees is walked at once, level by level:
a pair of nodes that is met again only adds to how often it counts, and its leaves are priced once. Block sums add up.
For terms against the language, prices are columns, and a ranked window keeps TOP terms a group.

Memory: a block holds about CELLS counts (dense), or SPREAD times the square of the number of sources if that is more, up to
MOST_CELLS, so that its rows of pairs stay few beside its counts. The number of pairs of sources is that of the result.

Defined results: null text, lang and source are ''; a null text or one without terms still makes its group; repeated
rows are documents each; ties rank by the item's bytes; an empty table gives no rows; other columns are not read. A
language that keeps no term has pairs of value 0 and no terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.llm.common import saved

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
CELLS = 1 << 16
SPREAD = 4
MOST_CELLS = 1 << 24
HELD_TERMS = 300_000  # counted in a task before they are told
PAIRS_AT_ONCE = 256

# Bytes of a term: letters in lower case and all of non-ASCII characters; any other byte parts terms.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task; a row without term says that the group occurs."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def told() -> pa.RecordBatch:
        terms, n, n_docs, sizes = [], [], [], []
        for seen, docs in groups.values():
            terms += [*seen, None]
            n += [*seen.values(), 0]
            n_docs += [*map(docs.__getitem__, seen), 0]
            sizes.append(len(seen) + 1)
        of = pa.array(np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64)))
        names = [pa.array([g[k] for g in groups], pa.string()).take(of) for k in (0, 1)]
        groups.clear()
        return pa.RecordBatch.from_arrays([*names, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    held = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            seen, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, terms = len(seen), terms_of(text)
            seen.update(terms)
            docs.update(set(terms))
            held += len(seen) - before
            if held >= HELD_TERMS:
                yield told()
                held = 0
    yield told()


def frequencies(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """p of counts in groups whose N + V is ``total`` (Python's integers where 64 bits don't hold the product)."""
    if counts.size and int(counts.max()) + 1 > (1 << 62) // SCALE:
        counts = counts.astype(object)
    return (1 + SCALE * (counts + 1) // total).astype(np.int64)


class Forest:
    """The segment trees of a block's groups, equal subtrees shared.

    ``counts``: a row a group, a column a term. Leaves are the distinct counts; on each level above, a node is a distinct
    pair of nodes below. -1 stands for the places that fill up the last level.
    """

    def __init__(self, counts: np.ndarray):
        groups, terms = counts.shape
        size = 1 << max(0, terms - 1).bit_length()
        full = np.full((groups, size), -1, np.int64)
        full[:, :terms] = counts
        self.leaves, at = np.unique(full, return_inverse=True)
        at = at.reshape(groups, size).astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        below = len(self.leaves)
        while size > 1:
            nodes, at = np.unique(at[:, ::2] * below + at[:, 1::2], return_inverse=True)
            size //= 2
            at = at.reshape(groups, size).astype(np.int64)
            self.levels.append((nodes // below, nodes % below))
            below = len(nodes)
        self.roots = at[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of groups: (pair, count in a, count in b, how often) of their leaves, by pair; equal pairs of nodes are one."""
        pair, x, y, often = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            left, right = self.levels[depth]
            nodes = len(self.levels[depth - 1][0]) if depth else len(self.leaves)
            code = np.concatenate([(pair * nodes + left[x]) * nodes + left[y], (pair * nodes + right[x]) * nodes + right[y]])
            order = np.argsort(code, kind="stable")
            code = code[order]
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            often, code = np.add.reduceat(np.concatenate([often, often])[order], first), code[first]
            pair, x, y = code // nodes // nodes, code // nodes % nodes, code % nodes
        real = self.leaves[x] >= 0
        return pair[real], self.leaves[x][real], self.leaves[y][real], often[real]


def prices(counts: np.ndarray, totals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, other, value) of all pairs of different groups, a part at a time."""
    forest, groups = Forest(counts), len(counts)
    low, high = np.triu_indices(groups, 1)
    for at in range(0, len(low), PAIRS_AT_ONCE):
        a, b = low[at:at + PAIRS_AT_ONCE], high[at:at + PAIRS_AT_ONCE]
        pair, ca, cb, often = forest.walk(a, b)
        p, q = frequencies(ca, totals[a][pair]), frequencies(cb, totals[b][pair])
        square, forth, back = (p - q) ** 2, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        np.add.at(forth, pair, square // q * often)
        np.add.at(back, pair, square // p * often)
        yield np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([forth, back])


_PRICED = "lang string, source string, item string, value long"


def _block(rows: pa.Table) -> pa.Table:
    """One block: rows without term are its groups, the others are counts."""
    lang = rows.column("lang")[0].as_py()
    heads = rows.filter(pc.is_null(rows.column("term")))
    entries = rows.filter(pc.is_valid(rows.column("term")))
    sources = heads.column("source").to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    totals = heads.column("total").to_numpy()
    terms, at = np.unique(np.array(entries.column("term").to_pylist(), object), return_inverse=True)
    sums = np.zeros(len(terms), np.int64)
    n = entries.column("n").to_numpy()
    np.add.at(sums, at, n)
    rank = np.empty(len(terms), np.int64)
    rank[np.argsort(-sums, kind="stable")] = np.arange(len(terms))
    counts = np.zeros((len(sources), len(terms)), np.int64)
    counts[[place[s] for s in entries.column("source").to_pylist()], rank[at]] = n
    out = [pa.table({"lang": [lang] * len(v), "source": [sources[i] for i in a.tolist()], "item": [sources[i] for i in b.tolist()], "value": v},
                    pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))
           for a, b, v in (prices(counts, totals) if len(terms) else _free(len(sources)))]
    return pa.concat_tables(out) if out else pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]).empty_table()


def _free(groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of different groups at price 0."""
    a, b = np.nonzero(~np.eye(groups, dtype=bool))
    yield a, b, np.zeros(len(a), np.int64)


def _frequency(count: Column, total: Column) -> Column:
    number = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * number(count + 1), number(total)) + 1


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every other source of the lang, and the ``top`` terms, of each group."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    told = saved(texts.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    words = told.where(F.col("term").isNotNull())
    kept = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    entries = saved(words.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "term_entries")

    # a row a group, with what holds for its language
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    names = told.where(F.col("term").isNull()).select("lang", "source")
    langs = names.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("all_n")), "lang", "left")
    groups = names.join(sums, ["lang", "source"], "left").join(langs, "lang").fillna(0, ["group_n", "v", "all_n"])
    wide = F.least(F.greatest(F.lit(cells), SPREAD * F.col("sources") * F.col("sources")), F.lit(MOST_CELLS))
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") * F.col("sources") / wide))
    groups = saved(groups.select("lang", "source", (F.col("group_n") + F.col("v")).alias("total"), (F.col("all_n") + F.col("v")).alias("all_total"), blocks.alias("blocks")), "term_groups")

    known = entries.join(groups, ["lang", "source"])
    heads = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total")
    rows = known.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "n", "total")
    priced = rows.unionByName(heads).groupBy("lang", "block").applyInArrow(_block, _PRICED)
    pairs = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    p, q = _frequency(F.col("n"), F.col("total")), _frequency(F.col("lang_n"), F.col("all_total"))
    above = known.withColumns({"p": p, "q": q}).where((F.col("p") > F.col("q")) & (F.col("n") > 0))
    price = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    terms = above.select("lang", "source", F.col("term").alias("item"), price.cast("long").alias("value")).withColumn("part", F.lit("term"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked = pairs.withColumn("rank", F.row_number().over(order)).select(columns)
    return ranked.unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(columns))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (coalesce(t.n, 0) + v.v) AS p,
        1 + (1000000000::HUGEINT * (kept.c + 1)) // (v.n + v.v) AS q
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
    FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
    UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
