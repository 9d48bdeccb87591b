"""Spelling variants against comparing all pairs of words."""

import random

import numpy as np
import pytest

from shelfwise.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, N bigint"


def edited(rng, w):
    i, k = rng.randrange(len(w)), rng.random()
    if k < 0.3:
        return w[:i] + w[i + 1:]
    return w[:i] + rng.choice("abcÉ×xy") + w[i + (k >= 0.6):]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 7))) for _ in range(50)]
    out = []
    for i in range(350):
        some = [rng.choice(base) for _ in range(30)]
        some = [edited(rng, w) if rng.random() < 0.5 else w.title() if rng.random() < 0.2 else w for w in some]
        out.append((i if i % 7 else None, rng.choice([" ", ", ", "1"]).join(some)))
    # nulls, no words, repeated rows, very long words one letter apart, every letter counted beyond the clip
    return out + [(5, None), (6, ""), (8, "12 ½ --"), (7, "z" * 3000 + " " + "z" * 2999 + " " + "ab" * 20 + " " + "ab" * 20 + "a")] * 4


def got(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("capacity", [2500, spelling.CAPACITY])
def test_equals_all_pairs(spark, docs, capacity):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    assert got(spelling.variant_forms(spelling.words(frame), capacity)) == spelling.brute_force(docs)


def test_words_alike_in_every_count_are_dealt_into_parts(spark):
    """Anagrams: one leaf holds more letters than a node may."""
    rng = random.Random(2)
    texts = [(i, "".join(rng.sample("abcdefg", 7))) for i in range(600)] * 3
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert got(spelling.variant_forms(spelling.words(frame), 700)) == spelling.brute_force(texts)


def test_every_node_and_chunk_is_bounded(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    vocabulary = spelling.words(frame)
    dealt = spelling.deal(vocabulary, np.arange(spelling.GROUPS), 2500).selectExpr("node", "chunk", "asks", "length(word) AS k")
    sizes = dealt.groupBy("node", "chunk", "asks").sum("k").collect()
    assert max(r["sum(k)"] for r in sizes) < 3 * 2500 + 3000          # hashed lots are even within a factor; the longest word


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.variant_forms(spelling.words(frame)).count() == 0
    assert spelling.variant_forms(spelling.words(spark.createDataFrame([(1, "one two")], "doc_id bigint, text string"))).count() == 0


def test_one_edit():
    def ask(a, b):
        return bool(spelling.one_edit(*(spelling.letters([w])[0].reshape(1, -1) for w in (a, b)))[0])
    assert ask("aaaa", "aaaaa") and ask("abcd", "xabcd") and ask("abcd", "abcdx") and ask("abcd", "abxcd") and ask("abcd", "abxd")
    assert not ask("abcd", "abcd") and not ask("abcd", "abdce") and not ask("abcd", "badc")
