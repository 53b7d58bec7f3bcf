"""Personal data by candidate boosting: loose generators propose spans, boosted trees judge format and context, thresholds decide.

DataFrame functions only. Strict rules (fixed values below) give the base spans. Three loose generators propose whatever
looks like an address, a number or a phone inside a longer run, once for each kind that it could be, so proposals
overlap. A proposal's features are binned format (digits, brackets, dots, gaps) and context (neighbouring characters,
hint words before it); the marks that make a base span, "@" and "+", are masked, so a span in another guise looks the
same. Some proposals tell what is right: those that overlap a base span of their kind. Those whose plain form (guises
undone) fails the kind's rule are wrong. The rest, right in plain form but no base span, is what has to be judged: it is
left out of training. A few labelled examples (SEEDS) count as proposals of every table, for kinds that it has too few of.

Since bins are few, all proposals of the whole table sum up in one small table of features. On that table regression
trees are boosted (logistic loss); on its calibration fold, each kind's threshold is the least score from which on
PRECISION of the proposals are right. Proposals above it whose plain form is right and that overlap no base span are
added, the best first where they overlap each other. The trees become one column expression, so scoring is a projection
and texts are never shuffled.

Defined results: null texts count as empty, repeated rows are judged alike, an empty table gives no rows, other columns
are not returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.llm.common import let, saved

KINDS = ("email", "ip", "card", "phone")

# The base rules, written so that a long text takes no more than linear time. Runs are taken possessively
# and entered at their start only; card numbers are runs of 12 to 19 digits with no further digit to either side.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
IP_PARTS = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"

# The generators, and the words that hint at a kind when they stand before a proposal. Runs are of any length.
MAIL_LIKE = r"(?<![^\s<>(),;:\"'])[^\s<>(),;:\"'@\[\]]++\s?(?:@|[(\[]at[)\]])\s?[^\s<>(),;:\"'@]*[A-Za-z0-9]"
NUMBER_LIKE = r"(?<![0-9A-Za-z])[+(]{0,2}[0-9]++(?:[\x20().-]++[0-9]++)*+"
PHONE_LIKE = r"(?<![0-9A-Za-z])(?<![0-9][.-])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])(?![.-][0-9])"
AT = r"\s?[(\[]at[)\]]\s?"
COUNTRY = r"^\+[0-9]{1,3}(?=[\x20(.-])"
HINTS = (("email", "mail|contact|write to"), ("phone", "phone|tel|call|mobile|fax"), ("card", "card|visa|credit|account"), ("ip", "ip|host|server|address"))
BEFORE = 24

# Labelled examples: text before, span, text after, kind, whether it is right.
SEEDS = tuple((*x, kind, True) for kind, rows in (
    ("email", (("mail ", "jane.doe@example.org", "."), ("", "info@mail.example.com", " "), ("of ", "r2d2@example.net", " and"))),
    ("ip", (("host ", "192.0.2.17", ","), ("", "198.51.100.4", " "))),
    ("card", (("card ", "4111 1111 1111 1111", " "), ("", "5500000000000004", "."), ("no. ", "3400-0000-0000-009", " "))),
    ("phone", (("call ", "+1 (555) 010-9999", "."), ("", "(555) 010-9999", " "), ("", "+44 20 7946 0958", " "), ("", "+1 555-010-9999", " "), ("tel ", "+49 555 010 9999", ","), ("fax ", "+1 555.010.9999", " "))),
) for x in rows) + tuple((*x, kind, False) for kind, rows in (
    ("email", (("see ", "user@host", " "), ("by ", "@name", " "), ("", "a(at)b", " "))),
    ("ip", (("v", "1.2.3", " "), ("", "999.1.1.300", " "), ("section ", "4.1.2", " "))),
    ("card", (("", "1234567890123456", " "), ("id ", "20240506", " "), ("", "1000000000000001", " "))),
    ("phone", (("on ", "2024-05-06", " "), ("", "12345678", " "), ("", "1234567890123456", " "), ("pages ", "10-12", " "), ("", "3.14159", " "), ("", "1 000 000", " "), ("id ", "1234567890", " "), ("", "10.0.0.1", " "))),
) for x in rows)
SEED_WEIGHT = 8

ROUNDS, DEPTH, RATE, RIDGE = 24, 3, 0.3, 1.0
PRECISION = 0.98
LEAST_PROPOSALS = 20  # of a kind in the calibration fold
FOLDS = 5
FEATURES = ("kind", "digits", "paren", "dots", "gaps", "touch", "hint")

_SPAN = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def found(text: Column, pattern: str) -> Column:
    """Leftmost matches in order, with places in code points and the text around them.

    Texts between matches and matches alternate, so places are running sums of their lengths.
    """
    def fold(m: Column, gaps: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(m, i))
            one = F.struct(start.alias("start"), end.alias("end"), F.get(m, i).alias("text"),
                           F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], one).cast(_SPAN).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), zero, step, lambda acc: acc["out"])

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, F.array().cast(_SPAN)).otherwise(
        let(F.split(text, pattern, -1), lambda gaps: fold(m, gaps))))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, d * 2).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """array<struct<start, k, end>> of the strict rules, by start and kind (its number in KINDS)."""
    digits = lambda s: F.length(_digits(s["text"]))
    kept = (
        F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(F.array().cast(_SPAN)),
        F.filter(found(text, IP), lambda s: s["text"].rlike(IP_PARTS)),
        F.filter(found(text, CARD), lambda s: luhn(_digits(s["text"]))),
        F.when(F.contains(text, F.lit("+")), F.filter(found(text, PHONE), lambda s: digits(s).between(9, 15))).otherwise(F.array().cast(_SPAN)),
    )
    return F.sort_array(F.concat(*[_named(a, k) for k, a in enumerate(kept)]))


def _named(a: Column, k: int) -> Column:
    return F.transform(a, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end")))


def _bin(x: Column, *edges: int) -> Column:
    """How many of the edges ``x`` reaches."""
    return reduce(lambda a, b: a + b, [(x >= e).cast("int") for e in edges])


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def plain(t: Column, k: int) -> Column:
    """Whether a proposal, its guise undone, is right by the kind's rule."""
    digits = _digits(t)
    if k == 0:
        return F.regexp_replace(t, AT, "@").rlike("^(?:" + EMAIL.split("))", 1)[1] + ")$")
    if k == 1:
        return t.rlike(IP_PARTS)
    if k == 2:
        return F.length(digits).between(12, 19) & luhn(digits)
    return F.length(digits).between(9, 15) & t.rlike(r"^\(?\+?\(?[0-9]")


def _features(s: Column, k: int) -> Column:
    before = F.lower(s["before"])
    t = F.regexp_replace(s["text"], COUNTRY if k == 3 else AT, "") if k in (0, 3) else s["text"]  # masks the marks of base spans
    hint = reduce(lambda other, h: F.when(before.rlike(rf"(?:{h[1][1]})[^a-z]*$"), h[0] + 1).otherwise(other), list(enumerate(HINTS))[::-1], F.lit(0))
    touch = F.right(s["before"], F.lit(1)).rlike("[A-Za-z0-9_]").cast("int") + 2 * s["after"].rlike("[A-Za-z0-9_]").cast("int")
    inner = F.trim(t)
    values = {
        "kind": F.lit(k), "digits": _bin(F.length(_digits(inner)), 1, 7, 9, 10, 12, 13, 16, 17, 20),
        "paren": F.contains(inner, F.lit("(")).cast("int"), "dots": _bin(_count(inner, "."), 1, 2, 3, 4), "gaps": _bin(_count(inner, " -"), 1, 2, 3, 4, 6),
        "touch": touch, "hint": hint,
    }
    return F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), plain(s["text"], k).alias("plain"), *[values[f].cast("int").alias(f) for f in FEATURES])


def proposals(text: Column) -> Column:
    """array<struct<start, k, end, plain, features>>: each loose find once for every kind that it could be."""
    mail = F.when(F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]"), found(text, MAIL_LIKE)).otherwise(F.array().cast(_SPAN))
    numbers = F.filter(found(text, NUMBER_LIKE), lambda s: F.length(s["text"]) >= 7)
    as_mail = F.transform(mail, lambda s: _features(s, 0))
    as_number = let(numbers, lambda a: F.concat(*[_proposed(a, k) for k in (1, 2, 3)]))
    return F.array_distinct(F.concat(as_mail, as_number, _proposed(found(text, PHONE_LIKE), 3)))


def _proposed(a: Column, k: int) -> Column:
    return F.transform(a, lambda s: _features(s, k))


def seeds(spark: SparkSession) -> DataFrame:
    """The labelled examples by features, ``right`` and ``wrong``."""
    each = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(t).alias("text"), F.lit(a).alias("after"), F.lit(KINDS.index(k)).alias("k"), F.lit(right).alias("is_right"))
                     for b, t, a, k, right in SEEDS])
    rows = spark.range(1).select(F.inline(each))
    s = rows.withColumn("s", F.struct(F.lit(0).alias("start"), F.length("text").alias("end"), "text", "before", "after"))
    told = s.select("is_right", reduce(lambda other, k: F.when(F.col("k") == k, _features(F.col("s"), k)).otherwise(other), range(len(KINDS)), F.lit(None)).alias("s"))
    return told.select(*[F.col(f"s.{f}").alias(f) for f in FEATURES], "is_right")


@dataclass
class Node:
    """A leaf (``feature`` empty) or a test ``feature <= edge``."""

    value: float = 0.0
    feature: str = ""
    edge: int = 0
    low: Node | None = None
    high: Node | None = None

    def of(self, row: dict) -> float:
        if not self.feature:
            return self.value
        return (self.low if row[self.feature] <= self.edge else self.high).of(row)

    def column(self, s: Column) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(s[self.feature] <= self.edge, self.low.column(s)).otherwise(self.high.column(s))


def _grow(rows: list[dict], depth: int) -> Node:
    """A regression tree on gradients ``g`` and curvatures ``h``, the split of the largest gain first."""
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    leaf = Node(RATE * g / (h + RIDGE))
    if not depth:
        return leaf
    best = (1e-9, "", 0)
    for f in FEATURES:
        sums: dict[int, list[float]] = {}
        for r in rows:
            s = sums.setdefault(r[f], [0.0, 0.0])
            s[0] += r["g"]
            s[1] += r["h"]
        gl = hl = 0.0
        for v in sorted(sums)[:-1]:
            gl, hl = gl + sums[v][0], hl + sums[v][1]
            gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
            if gain > best[0]:
                best = (gain, f, v)
    if not best[1]:
        return leaf
    _, f, v = best
    return Node(0.0, f, v, _grow([r for r in rows if r[f] <= v], depth - 1), _grow([r for r in rows if r[f] > v], depth - 1))


def boost(rows: list[dict], rounds: int = ROUNDS, depth: int = DEPTH) -> list[Node]:
    """Trees from rows of features with ``right`` and ``wrong`` counts; rows weigh by the root of their counts, so that a
    frequent form doesn't drown a rare one."""
    trees: list[Node] = []
    roots = [max(1, r["right"] + r["wrong"]) ** 0.5 for r in rows]
    rows = [dict(r, score=0.0, right=r["right"] / root, wrong=r["wrong"] / root) for r, root in zip(rows, roots, strict=True)]
    for _ in range(rounds if rows else 0):
        for r in rows:
            p, n = 1 / (1 + math.exp(-r["score"])), r["right"] + r["wrong"]
            r["g"], r["h"] = r["right"] - n * p, n * p * (1 - p)
        trees.append(_grow(rows, depth))
        for r in rows:
            r["score"] += trees[-1].of(r)
    return trees


def thresholds(rows: list[dict], trees: list[Node], precision: float = PRECISION) -> list[float]:
    """By kind, the least score from which on at least ``precision`` of the proposals are right (infinite: none)."""
    out = []
    for k in range(len(KINDS)):
        mine = sorted(((sum(t.of(r) for t in trees), r["right"], r["wrong"]) for r in rows if r["kind"] == k), reverse=True)
        best, right, n = math.inf, 0, 0
        for i, (score, good, bad) in enumerate(mine):
            right, n = right + good, n + good + bad
            tied = i + 1 < len(mine) and mine[i + 1][0] == score
            if not tied and n >= LEAST_PROPOSALS and right >= precision * n:
                best = score
        out.append(best)
    return out


def _overlaps(s: Column, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def _sums(scanned: DataFrame) -> list[dict]:
    """Right and wrong proposals by fold and features: as few rows as bins allow, whatever the number of proposals."""
    each = scanned.where(F.size("proposed") > 0).select(
        (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0).alias("calibrates"), "base", F.explode("proposed").alias("s"))
    is_right = F.exists("base", lambda b: (b["k"] == F.col("s.k")) & (b["start"] < F.col("s.end")) & (F.col("s.start") < b["end"]))
    told = each.select("calibrates", *[F.col(f"s.{f}").alias(f) for f in FEATURES], is_right.alias("r"), F.col("s.plain").alias("plain")).where(F.col("r") | ~F.col("plain"))
    sums = told.groupBy("calibrates", *FEATURES).agg(F.sum(F.col("r").cast("long")).alias("right"), F.sum((~F.col("r")).cast("long")).alias("wrong"))
    rows = [r.asDict() for r in sums.collect()]
    for r in seeds(scanned.sparkSession).collect():
        marks = {f: r[f] for f in FEATURES}
        rows += [{"calibrates": c, **marks, "right": SEED_WEIGHT * r["is_right"], "wrong": SEED_WEIGHT * (not r["is_right"])} for c in (False, True)]
    return sorted(rows, key=lambda r: [r[f] for f in FEATURES])


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: arrays of ``struct<start, k, end>`` by start and kind, k being the place in KINDS."""
    t = F.coalesce(F.col("text"), F.lit(""))
    scanned = saved(docs.select("doc_id", base_spans(t).alias("base"), proposals(t).alias("proposed")), "pii_scan")
    rows = _sums(scanned)
    trees = boost([r for r in rows if not r["calibrates"]])
    least = thresholds([r for r in rows if r["calibrates"]], trees)

    def scored(s: Column) -> Column:
        score = reduce(lambda a, b: a + b, [tree.column(s) for tree in trees], F.lit(0.0))
        return F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), score.alias("score"))

    limit = lambda s: reduce(lambda other, k: F.when(s["k"] == k, F.lit(least[k])).otherwise(other), range(len(KINDS)), F.lit(math.inf))
    free = F.filter("proposed", lambda s: s["plain"] & ~_overlaps(s, F.col("base")))
    judged = scanned.withColumn("judged", F.transform(free, scored))
    chosen = judged.withColumn("judged", F.filter("judged", lambda s: s["score"] >= limit(s) - 1e-9))
    before = lambda x, s: (x["score"] > s["score"]) | ((x["score"] == s["score"]) & ((x["start"] < s["start"]) | ((x["start"] == s["start"]) & ((x["end"] > s["end"]) | ((x["end"] == s["end"]) & (x["k"] < s["k"]))))))
    best = F.filter("judged", lambda s: ~F.exists("judged", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]) & before(x, s)))
    added = F.transform(best, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))
    return chosen.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def digest(data: DataFrame) -> DataFrame:
    """The columns that the query returns."""
    counts = {f"n_{kind}": F.size("base") - F.size(F.array_remove(F.transform("base", lambda s: s["k"]), k)) for k, kind in enumerate(KINDS)}
    return data.select("doc_id", *[c.cast("long").alias(n) for n, c in counts.items()], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.col("spans")).alias("spans"))
