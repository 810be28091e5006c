"""Token counts, Merkle manifest and periodic runs against brute-force versions."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

from tessera.llm import merkle, periodic_runs, token_counts  # noqa: E402

SF = "/root/testdata/sf0.001"
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module", params=["given", "awkward", "empty"])
def table(request, spark):
    df = {"given": lambda: spark.read.parquet(f"{SF}/documents.parquet"), "awkward": lambda: H.awkward(spark),
          "empty": lambda: H.awkward(spark).limit(0)}[request.param]()
    return df, [r.asDict() for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    given = Tokenizer.from_file(token_counts.vocabulary_path())
    return lambda text: len(given.encode(text, add_special_tokens=False).ids)


def test_token_counts(table, library):
    df, rows = table
    got = token_counts.token_counts(df, token_counts.vocabulary_path(), limit=40).collect()
    H.same([r[:4] for r in got], [(r["doc_id"], len(t.encode()), library(t), library(t) > 40) for r in rows for t in [r["text"] or ""]])
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], set()).add(r["text"] or "")
    for r in got:
        assert any(len(t.encode()) == r.n_bytes and library(t[:r.cut_chars]) <= 40 and (r.cut_chars == len(t) or library(t[:r.cut_chars + 1]) > 40)
                   for t in texts[r.doc_id])


def test_every_prefix(library):
    """Counts at all prefixes of texts made of awkward parts and of random characters."""
    rng = random.Random(4)
    parts = ["don't", "we're", "I'll", " ", "  ", "\n", "\n\n", "\t", "a", "the", "hello", "Ünïcode", "日本語", "　", "\xa0", "\x85", "\x1c", SPECIAL,
             "<|endo", "'re", "'", "!!", "12345", "​", "᠎", "x" * 20, " " * 9, "\r\n", "😀", "ΑΒΓ", "-" * 8, "﻿", "'sx", " 's", "\x1f ", "\nÉa,"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x250), rng.randrange(0x2000, 0x3100), 10, 32, 32])) for _ in range(40)) for _ in range(100)]
    counter = token_counts.PrefixCounter(token_counts.vocabulary_path())
    for t, got in zip(texts, counter.batch(texts), strict=True):
        assert got.tolist() == [library(t[:i]) for i in range(1, len(t) + 1)], t


def test_prefix_table_answers(spark, library):
    """Questions about truncation and budgets are answered from the stored counts."""
    rng = random.Random(5)
    texts = ["", "word", SPECIAL, "  don't  stop \n\n now " * 8, H.LONG[:700]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = token_counts.prefix_table(df, token_counts.vocabulary_path(), block=64)
    for _ in range(4):
        at, limit = rng.randrange(150), rng.randrange(60)
        got = table.select("doc_id", "n_tokens", token_counts.tokens_at(F.lit(at), block=64).alias("at"), token_counts.chars_within(F.lit(limit)).alias("cut"))
        for r in got.collect():
            t = texts[r.doc_id]
            assert r.n_tokens == library(t)
            assert r["at"] == (library(t[:at]) if at <= len(t) else None)
            assert r.cut == max(i for i in range(len(t) + 1) if library(t[:i]) <= limit)


def test_other_vocabularies():
    with pytest.raises(ValueError):
        token_counts.PrefixCounter(token_counts.vocabulary_path("word_bpe_49k.json"))


def test_merkle(table):
    df, rows = table
    altered = merkle.tampered_text(F.col("doc_id"), F.col("text"))
    nodes, proofs = merkle.manifest(merkle.leaves(df, claimed_text=altered))
    H.same(merkle.digest(proofs).collect(), H.merkle(rows))
    found = nodes.collect()
    assert sum(r.level == 0 and r.tree is not None for r in found) == len(rows)
    assert all(r.lo < r.hi for r in found)


def test_merkle_sizes(spark):
    """Trees of one leaf, of whole runs, of one more, over several levels; another fan."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "e": 65, None: 17, "": 2}
    rows = [{"doc_id": i * 10 + len(g or "x"), "source": "s", "lang": g, "n_chars": i, "text": f"Text {g} {i}"} for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string")
    altered = merkle.tampered_text(F.col("doc_id"), F.col("text"))
    for fan in (8, 2):
        got = merkle.digest(merkle.manifest(merkle.leaves(df, claimed_text=altered), fan)[1]).collect()
        H.same(got, H.merkle(rows, fan))
        assert 0 < sum(r.verified for r in got) < len(got)


def test_periodic_runs(table):
    df, rows = table
    got = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(df))).collect()
    H.same(got, H.periodic([(r["doc_id"], r["text"]) for r in rows]))


def test_runs_of_random_words():
    rng = random.Random(2)
    for _ in range(300):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(60))]
            if w and rng.random() < 0.6:
                a, p = rng.randrange(len(w)), 1 + rng.randrange(8)
                w = w[:a] + [(w[a:a + p] * 200)[i] for i in range(rng.randrange(100))] + w[a:]
            docs.append(w)
        flat = np.array([x for d in docs for x in d], dtype=np.int64)
        found = periodic_runs.runs_of(flat, [len(d) for d in docs], v=rng.choice([4, 8, 32]), most=rng.choice([10, 10**6]))
        got = [[] for _ in docs]
        for t, *r in zip(*(x.tolist() for x in found)):
            got[t].append(tuple(r))
        assert [sorted(g) for g in got] == [H.runs(d) for d in docs]


def test_extensions():
    rng = random.Random(3)
    for v in (4, 8, 32):
        cover = periodic_runs.difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
        w = np.array([rng.randrange(2) if rng.random() < 0.1 else 1 for _ in range(200)])
        i, j = np.array([rng.sample(range(200), 2) for _ in range(300)]).T
        want = [next(k for k in range(201) if max(a, b) + k >= 200 or w[a + k] != w[b + k]) for a, b in zip(i, j)]
        assert periodic_runs.Extensions(w, v).lce(i, j).tolist() == want
