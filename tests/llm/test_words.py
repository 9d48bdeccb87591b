"""Word hashes: no pattern makes unlike words or runs collide."""

import numpy as np
import pytest

from shelfwise.llm import ngram_join, substrings, words

DOCS = "doc_id bigint, text string"


def thue_morse(rounds):
    out = [0]
    for _ in range(rounds):
        out += [1 - x for x in out]
    return out


@pytest.fixture(scope="module")
def pair():
    bits = thue_morse(10)
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_one_pattern_differ(pair):
    w = words.Words([" ".join(pair), None, "a b", pair[0] + "\t" + "é" * 300], words.SPACES, fold=False)
    assert w.counts().tolist() == [2, 0, 2, 2]
    assert w.hash[0] != w.hash[1] and w.hash2[0] != w.hash2[1] and w.hash[0] == w.hash[4] and w.hash2[0] == w.hash2[4]


def test_equal_bytes_give_equal_values_anywhere():
    rng = np.random.default_rng(1)
    some = ["".join(rng.choice(list("abé"), size=k)) for k in (1, 7, 8, 9, 16, 17, 63, 64, 65, 511, 512, 513, 2000)]
    a = words.Words([" ".join(some)], words.SPACES, fold=False)
    b = words.Words(["x", " \n".join(reversed(some)), None], words.SPACES, fold=False)
    assert a.hash.tolist() == b.hash[1:][::-1].tolist() and a.hash2.tolist() == b.hash2[1:][::-1].tolist()
    assert len(set(a.hash.tolist())) == len(some) and not set(a.hash.tolist()) & set(a.hash2.tolist())


def test_runs_of_one_pattern_differ():
    bits = np.array(thue_morse(11), dtype=np.uint64)
    for size in (5, 32, 35, 64, 2048):
        h = words.sequence_hashes(np.concatenate([bits, 1 - bits]) + np.uint64(7), size)
        assert len(h) == 4096 - size + 1
        runs = {tuple(r) for r in np.lib.stride_tricks.sliding_window_view(np.concatenate([bits, 1 - bits]), size).tolist()}
        assert len(set(h.tolist())) == len(runs)
    assert len(words.sequence_hashes(bits[:3], 4)) == 0


def test_substrings_and_sets_tell_patterns_apart(spark, pair):
    texts = [" ".join([w] * 35) for w in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    assert sorted(r.n_removed for r in substrings.dedup_substrings(docs).collect()) == [0, 0]
    docs = spark.createDataFrame(list(enumerate(pair)), DOCS)
    assert sorted(r.component_id for r in ngram_join.join_sets(docs).collect()) == [0, 1]


def test_an_id_with_several_texts_loses_only_copies(spark):
    copy, other = "one two three four five six seven", "quite another text with words of its own"
    docs = spark.createDataFrame([(1, copy), (2, copy), (2, other), (3, other), (2, other)], DOCS)
    kept = sorted(map(tuple, ngram_join.one_of_each_group(docs).collect()))
    assert kept == [(1, copy), (2, other)]
