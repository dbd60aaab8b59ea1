"""Substring and suffix-array dedup against brute force, also with groups that must be split."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from rolewise.llm import op1_substring_dedup as op1, op6_suffix_array_dedup as op6

SCHEMA = "doc_id long, text string, id string, size int, kept string"


def corpus(rng):
    """Shared passages with edits, copies, repeats within a text, runs of one character, odd spaces, nulls."""
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(4)]
    texts = [None, "", " \t\n ", "short text", "a" * 450, "ab" * 300, "x " * 160, base[0] + "\n" + base[0]]
    for _ in range(40):
        own = [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(2)]
        part = base[rng.integers(4)].split(" ")
        if rng.random() < 0.5:
            part[rng.integers(len(part))] = "edit"
        texts.append(own[0] + " " + " ".join(part[rng.integers(0, 40):rng.integers(90, 121)]) + "  " + own[1])
    texts += texts[9:14]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def brute_words(rows):
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - 49):
            k = b" ".join(w[s:s + 50])
            least[k] = min(least.get(k, 10**9), i)
    out = {}
    for i, t in rows:
        w, gone = (t or "").encode().split(), set()
        for s in range(len(w) - 49):
            if least[b" ".join(w[s:s + 50])] < i:
                gone |= set(range(s, s + 50))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def brute_bytes(rows):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[s:s + 200] for s in range(len(b) - 199))
    out = {}
    for i, t in rows:
        b, gone = (t or "").encode(), set()
        for s in range(len(b) - 199):
            if count[b[s:s + 200]] > 1:
                gone |= set(range(s, s + 200))
        out[i] = (len(b), len(gone), bytes(x for j, x in enumerate(b) if j not in gone))
    return out


@pytest.mark.parametrize("op,brute,limit", [(op1.substring_dedup, brute_words, 10**6), (op1.substring_dedup, brute_words, 500),
                                            (op6.suffix_array_dedup, brute_bytes, 10**6), (op6.suffix_array_dedup, brute_bytes, 2500)])
def test_against_brute_force(spark, rng, op, brute, limit):
    rows = corpus(rng)
    docs = spark.createDataFrame([(i, t, "id", 1, "kept") for i, t in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["n"], r["n_removed"], bytes(r["kept"])) for r in op(docs, group_size=limit).collect()}
    assert got == brute(rows)
    assert sum(v[1] for v in got.values()) > 1000


def test_repeated_rows_and_nulls(spark):
    text = " ".join(f"u{i}" for i in range(70))
    rows = [(None, text), (5, text), (5, text), (None, None), (7, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    one = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in op1.substring_dedup(docs).collect())
    assert one == [(False, 5, 0), (False, 5, 0), (False, 7, 0), (True, 0, 0), (True, 0, 70)]
    six = [r["n_removed"] for r in op6.suffix_array_dedup(docs).orderBy("n").collect()]
    assert six == [0, 0, len(text), len(text), len(text)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert op1.substring_dedup(docs).count() == 0 and op6.suffix_array_dedup(docs).count() == 0


def test_query_digest(spark):
    out = op6.query(spark, "/root/testdata/sf0.001").collect()
    assert all(len(r["kept_sha256"]) == 64 for r in out)
    assert any(r["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in out)
