from bayesmill.functions.stem import normalize_terms, porter_stem

# word / stem pairs of the published algorithm
PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "generalization": "gener", "oscillators": "oscil",
}


def test_porter_pairs():
    assert {w: porter_stem(w) for w in PAIRS} == PAIRS


def test_normalize_terms_with_lemmas(spark):
    terms = spark.createDataFrame([("geese",), ("running",), ("running",)], "term string")
    lemmas = spark.createDataFrame([("geese", "goose")], "form string, lemma string")
    got = {r["term"]: r["norm"] for r in normalize_terms(terms, lemmas=lemmas).collect()}
    assert got == {"geese": "goos", "running": "run"}


def test_front_end_lemma_then_stem(spark):
    from bayesmill.operators.tfidf import explode_terms

    df = spark.createDataFrame([(1, "Geese were running"), (2, None), (3, "")], "doc_id long, text string")
    lemmas = {"geese": "goose", "were": "be"}
    rows = explode_terms(df, stop_words=(), grams=(1, 2, 3), sep=" ", stem=True, lemmas=lemmas).collect()
    assert sorted((r["doc_id"], r["term"]) for r in rows) == [
        (1, "be"), (1, "be run"), (1, "goos"), (1, "goos be"), (1, "goos be run"), (1, "run")]


def test_of_several_lemmas_the_smallest(spark):
    terms = spark.createDataFrame([("leaves",), ("leaves",)], "term string")
    lemmas = spark.createDataFrame([("leaves", "leave"), ("leaves", "leaf")], "form string, lemma string")
    assert [tuple(r) for r in normalize_terms(terms, lemmas=lemmas).collect()] == [("leaves", "leaf", 2)]


def test_words_are_stemmed_as_a_table(spark):
    """The stemmer runs above the aggregate to distinct words."""
    from bayesmill.operators.tfidf import explode_terms

    df = spark.createDataFrame([(1, "running runs")], "doc_id long, text string")
    plan = explode_terms(df, stem=True)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("ArrowEvalPython"):].splitlines()[1]
    assert "Aggregate [term" in below
