"""Toxicity: the document score by a plain forward-backward, the sample's bounds, odd rows."""

import math
import random
import re

import numpy as np
import pytest

from shelfwise.llm import toxicity

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def trained():
    rng = random.Random(5)
    clean = ["".join(rng.choices("abcdelmno", k=rng.randint(3, 7))) for _ in range(60)]
    bad = ["vrrgh", "zzkrut", "qoxxit"]
    texts, labels = [], []
    for i in range(240):
        words = rng.choices(clean, k=rng.randint(5, 60))
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(int(any(w in bad for w in words)))
    return toxicity.fit(texts, labels), texts, labels, clean, bad


def plain_score(field, text):
    """(marginals, score) of one text: forward and backward in log space, token by token."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    weight = dict(zip(field.keys.tolist(), field.weights.tolist()))
    logit = []
    for w in words:
        row = toxicity.features(toxicity.Words([w], toxicity.NON_ALNUM, fold=True), np.array([0]))[0]
        logit.append(field.bias + sum(weight.get(int(f), 0.0) for f in row))

    def add(a, b):
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))
    n, t = len(words), field.trans
    ahead = [[0.0, 0.0] for _ in range(n)]
    behind = [[0.0, 0.0] for _ in range(n)]
    for i in range(n):
        for y in (0, 1):
            own = logit[i] * y
            ahead[i][y] = own if i == 0 else own + add(ahead[i - 1][0] + t[0, y], ahead[i - 1][1] + t[1, y])
    for i in range(n - 2, -1, -1):
        for y in (0, 1):
            behind[i][y] = add(*(t[y, z] + logit[i + 1] * z + behind[i + 1][z] for z in (0, 1)))
    p = []
    for i in range(n):
        whole = add(ahead[i][0] + behind[i][0], ahead[i][1] + behind[i][1])
        p.append(math.exp(ahead[i][1] + behind[i][1] - whole))
    total = sum(p)
    x = [math.log1p(total), math.sqrt(total / max(n, 1)), max(p, default=0.0)]
    return p, 1 / (1 + math.exp(-(sum(a * b for a, b in zip(x, field.document)) + field.document[-1])))


def test_scores_equal_a_plain_forward_backward(spark, trained):
    field, texts, _, clean, bad = trained
    asked = texts[:20] + [None, "", "-- !", "VRRGH " + clean[0].upper(), " ".join(clean * 3), bad[1]]
    out, c = toxicity.tag(spark.createDataFrame(list(enumerate(asked)), DOCS).repartition(3), field)
    got = {r.doc_id: r[c] for r in out.collect()}
    for i, text in enumerate(asked):
        p, score = plain_score(field, text)
        assert got[i].score == pytest.approx(score, abs=1e-9)
        found = [(text or "").encode()[a:b].decode() for a, b in got[i].spans]
        assert len(found) == sum(x > 0.5 for x in p) and all(f.lower() in bad for f in found if f.lower() in bad)


def test_toxic_words_are_found(trained):
    field, _, _, clean, bad = trained
    t = toxicity.Tokens([" ".join([*clean[:20], bad[0], *clean[20:30]]), " ".join(clean)])
    p, score = field.score(t)
    assert score[0] >= toxicity.THRESHOLD > score[1] and p[20] > 0.5 and p.argmax() == 20


def test_very_long_and_repeated_texts(spark, trained):
    field, _, _, clean, bad = trained
    long = " ".join(clean * 1000) + " " + bad[0] + " " + bad[1]
    docs = spark.createDataFrame([(1, long, "x"), (1, long, "x"), (2, " ".join(clean * 1000), "y")], DOCS + ", toxicity string")
    out, c = toxicity.tag(docs, field)
    assert c == "_toxicity" and out.columns == [*docs.columns, c]
    rows = out.collect()
    same = [r[c].score for r in rows if r.doc_id == 1]
    assert len(rows) == 3 and same[0] == same[1] > [r[c].score for r in rows if r.doc_id == 2][0]


def test_only_texts_that_are_there_are_drawn_and_bytes_are_bounded(spark, trained):
    _, texts, labels, clean, _ = trained
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, " ".join(clean * 2000)), (0, texts[0])], DOCS).repartition(4)
    marks = [(i, y) for i, y in enumerate(labels)]
    gone = [(10_000 + i, i % 2) for i in range(5000)] + [(900, 1), (None, 1), (5, None), (6, 7)]     # no such text
    labelled = spark.createDataFrame(marks + gone, "doc_id bigint, toxic int")
    field = toxicity.learn(docs, labelled, sample=50)
    assert field.document is not None                       # 50 a class were drawn among texts that exist
    few = toxicity.learn(docs, labelled, sample=50, sample_bytes=400)
    assert few.document is None or len(few.keys) < len(field.keys)
    assert toxicity.learn(docs.limit(0), labelled).document is None
    assert toxicity.learn(docs, labelled.filter("toxic = 1")).document is None
    same = toxicity.learn(docs.repartition(7), labelled.repartition(2), sample=50)
    assert np.array_equal(same.keys, field.keys) and np.allclose(same.weights, field.weights)
