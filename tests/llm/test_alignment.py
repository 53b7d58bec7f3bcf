"""Alignment of two tokenizers against the tokenizers themselves and brute force."""

import bisect
import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest

from bayesmill.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return alignment.Aligner(alignment.ByteLevelTokenizer(f.read()), alignment.PieceTokenizer(g.read()))


def brute(texts, aligner):
    """Groups and links of each text, told by the tokenizers alone."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    t, sp, decoder = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), decoders.ByteLevel()
    t.encode_special_tokens = True
    out = []
    for text in texts:
        groups = []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            size_a, size_b = [len(aligner.a.bytes[i]) for i in a], [len(aligner.b.bytes[i]) for i in b]
            joined = b"".join(aligner.b.bytes[i] for i in b)
            assert decoder.decode([t.id_to_token(i) for i in a]) == " " + text
            if joined == (" " + text).encode():
                i = j = at_a = at_b = first_a = first_b = 0
                while i < len(a) or j < len(b):
                    if at_a <= at_b:
                        at_a, i = at_a + size_a[i], i + 1
                    else:
                        at_b, j = at_b + size_b[j], j + 1
                    if at_a == at_b:
                        groups.append((a[first_a:i], b[first_b:j]))
                        first_a, first_b = i, j
        out.append(groups)
    return out


ODD = ["été ñandú straße", "naïve “quotes” — 漢字 😀 zwj👩‍👩‍👧", "<|endoftext|> <s> </s> <unk> <0x41>", "▁under▁score", "  lead and trail  ", "tab\tline\n\n\nbreak\r\nend",
       "a" * 3000, " ", "\x00nul\x01", "x" * 50 + " " + "ﬁ ligature ½ ²", "don't we'll I'VE 12345678901234567890"]


def test_places_by_galloping():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1, 500), (40, 33), (5000, 300), (300, 5000), (4000, 4100)):
        a, b = (np.unique(rng.integers(0, 9000, k)) for k in (n, m))
        assert alignment.gallop(a, b).tolist() == [bisect.bisect_left(b, x) for x in a]
        i, j = alignment.common_ends(a, b)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    assert [len(x) for x in alignment.common_ends(np.empty(0, np.int64), np.arange(3))] == [0, 0]


def test_fast_path_is_the_tokenizer(aligner):
    assert aligner.a.fast is not None
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in alignment._PLAIN]
    for _ in range(300):
        text = "".join(rng.choice(letters, rng.integers(1, 400)))
        assert aligner.a.ids(text).tolist() == aligner.a.tokenizer.encode(text, add_special_tokens=False).ids


def test_alignment(spark, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", 200)
    rng = np.random.default_rng(2)
    words = [*"the quick brown fox étude straße 漢字 token izer 3.14 don't http://a.b/c".split(), "\n", "  "]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(60)] + ODD + ["", None, "same text", "same text"]
    table = spark.createDataFrame([(i if i else None, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, chunk string").repartition(3)
    got = {r["doc_id"]: r for r in alignment.align(table, A, B).collect()}
    want = brute(texts, aligner)
    count = collections.Counter((a[-1], b[-1]) for groups in want for a, b in groups)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    assert len(got) == len(texts)
    for i, groups in enumerate(want):
        r, links = got[i if i else None], [(a[-1], b[-1]) for a, b in groups]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(groups))
        assert r["groups_sha256"] == (hashlib.sha256(told.encode()).hexdigest() if groups else "")
        assert r["count_sum"] == sum(count[x] for x in links) and r["n_best"] == sum(count[x] == most[x[1]] for x in links)
    assert sum(not g for g in want) >= 3
    assert alignment.align(table.limit(0), A, B).count() == 0
