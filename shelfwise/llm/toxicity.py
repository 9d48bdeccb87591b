"""Toxicity by a linear-chain conditional random field.

Labels mark documents, so tokens are labelled first: in the training rows a
feature of a word (the word, its beginnings and its ends) that nearly always
comes in toxic documents marks the tokens that have it, in those documents.
How many documents that takes is a matter of evidence, not of their share: at
least ``LEAST``, and a likelihood ratio of the toxic against the clean rate
over ``EVIDENCE`` (chance in one of a thousand), the same at every size.
The field has two tags (clean, toxic); a token's tag depends on its features'
weights and on its neighbour's tag. It is fitted by conditional likelihood on
segments with and without toxic tokens. Scoring runs forward and backward
over each whole text: the marginals give the offending tokens' offsets, and
three sums of them (how many, how dense, how sure) a document's score, by a
logistic fit on the training rows.

Training rows are a sample: of the labelled rows with a text at most
``sample`` of each class, those with the smallest hashes of their ids, as far
as ``sample_bytes`` go (documented bounds; the corpus itself is only scored).
Everything else covers all rows alike. The model sent to the tasks holds at
most the sample's features.

Words: lower-cased runs of letters, digits and non-ASCII characters. Defined
results: a null or wordless text gets the score of no toxic token; a document
labelled twice counts as toxic if one label says so; null ids and labels
teach nothing; without training rows of both classes every score is 0; a text of
any length is scored whole; extra columns pass through, and the added one
takes a fresh name; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import add_struct, read
from .words import NON_ALNUM, Words, mix, slices

SAMPLE = 2000
THRESHOLD = 0.7
SAMPLE_BYTES = 16_000_000         # of a class's sampled texts
SEGMENT = 48
LANE = 1024                       # tokens that run one after the other
LEAST, EVIDENCE = 3, 10.83
_HEADS, _TAILS = (3, 4, 5, 6, 7), (3, 4, 5)


def features(w: Words, at: np.ndarray) -> np.ndarray:
    """One row of feature hashes for each word place (0: the word is too short for it)."""
    start, end = w.start[at], w.end[at]
    size = end - start
    columns = [w.hash_of(start, end)]
    for kind, lengths in ((1, _HEADS), (2, _TAILS)):
        for k in lengths:
            a, b = (start, np.minimum(start + k, end)) if kind == 1 else (np.maximum(end - k, start), end)
            columns.append(np.where(size >= k, mix(w.hash_of(a, b) + np.uint64(kind)), np.uint64(0)))
    return np.stack(columns, axis=1)


class Tokens:
    """Tokens of some texts, read a slice at a time: ``which`` (each token's
    distinct word), ``first`` (each text's first token, and the total) and
    ``rows`` (the distinct words' features)."""

    def __init__(self, texts: list[str | None]):
        words, counts, seen, rows = [], [], [np.zeros(0, np.uint64)], [np.zeros((0, 1 + len(_HEADS) + len(_TAILS)), np.uint64)]
        for a, b in slices(texts):
            w = Words(texts[a:b], NON_ALNUM, fold=True)
            own, at = np.unique(w.hash, return_index=True)
            words.append(w.hash)
            counts.append(w.counts())
            seen.append(own)
            rows.append(features(w, at))
        words = np.concatenate([np.zeros(0, np.uint64), *words])
        own, at = np.unique(np.concatenate(seen), return_index=True)
        self.rows = np.concatenate(rows)[at]
        self.which = np.searchsorted(own, words)
        self.first = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))).astype(np.int64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def __len__(self) -> int:
        return len(self.which)


def marginals(logit: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(toxic) of every token; ``logit``: toxic against clean weight of each
    token, texts one after the other; ``trans[i, j]``: weight of tag j after
    i. Runs over all texts at once, as odds. Texts are cut into lanes of
    ``LANE`` tokens that run side by side: a token takes the odds before it to
    its own by a linear fraction, so a lane as a whole is a matrix of two by
    two, and the odds at the lanes' borders come first."""
    if not len(logit):
        return np.zeros(0)
    n = np.diff(first)
    lanes = -(-n // LANE)
    text = np.repeat(np.arange(len(n)), lanes)
    number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = first[:-1][text] + number * LANE
    size = np.minimum(n[text] - number * LANE, LANE)
    e, t = np.exp(np.clip(logit, -60, 60)), np.exp(trans)
    opens, closes = number == 0, number == lanes[text] - 1
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, size.max() + 1), side="right")   # lanes longer than each step

    def step_ahead(at: np.ndarray, start: np.ndarray) -> tuple:
        """A token's matrix on the odds before it; a text's first token has odds of its own."""
        return (np.where(start, 0.0, e[at] * t[1, 1]), np.where(start, e[at], e[at] * t[0, 1]),
                np.where(start, 0.0, t[1, 0]), np.where(start, 1.0, t[0, 0]))

    def step_back(at: np.ndarray, last: np.ndarray) -> tuple:
        """A token's matrix on the backward odds of the token behind it; a text's last token has odds 1."""
        behind = e[np.minimum(at + 1, len(e) - 1)]
        return (np.where(last, 0.0, behind * t[1, 1]), np.where(last, 1.0, t[1, 0]),
                np.where(last, 0.0, behind * t[0, 1]), np.where(last, 1.0, t[0, 0]))

    def run(matrix, place, edge, forward: bool) -> np.ndarray:
        # odds that enter each lane, from the lanes' products
        entering = np.ones(len(text))
        if lanes.max() > 1:
            w, x, y, z = np.ones(len(text)), np.zeros(len(text)), np.zeros(len(text)), np.ones(len(text))
            for k, m in enumerate(active.tolist()):
                own = order[:m]
                a, b, c, d = matrix(place(own, k), edge[own] & (k == 0))
                w[own], x[own], y[own], z[own] = (a * w[own] + b * y[own], a * x[own] + b * z[own],
                                                  c * w[own] + d * y[own], c * x[own] + d * z[own])
                most = np.maximum(np.maximum(np.abs(w[own]), np.abs(x[own])), np.maximum(np.abs(y[own]), np.abs(z[own])))
                for v in (w, x, y, z):
                    v[own] /= most
            turn = number if forward else lanes[text] - 1 - number
            for k in range(1, int(lanes.max())):
                own = np.flatnonzero(turn == k)
                before = own - 1 if forward else own + 1
                entering[own] = (w[before] * entering[before] + x[before]) / (y[before] * entering[before] + z[before])
        out, odds = np.empty(len(logit)), entering
        for k, m in enumerate(active.tolist()):
            own = order[:m]
            at = place(own, k)
            a, b, c, d = matrix(at, edge[own] & (k == 0))
            odds[own] = (a * odds[own] + b) / (c * odds[own] + d)
            out[at] = odds[own]
        return out
    ahead = run(step_ahead, lambda own, k: begin[own] + k, opens, True)
    back = run(step_back, lambda own, k: begin[own] + size[own] - 1 - k, closes, False)
    total = ahead * back
    return total / (1 + total)


class Field:
    """The fitted field and the document fit."""

    def __init__(self, keys=None, weights=None, bias=0.0, trans=None, document=None):
        self.keys, self.weights, self.bias, self.trans, self.document = keys, weights, bias, trans, document

    def logits(self, t: Tokens) -> np.ndarray:
        k = np.minimum(np.searchsorted(self.keys, t.rows), len(self.keys) - 1)
        return (np.where(self.keys[k] == t.rows, self.weights[k], 0.0).sum(axis=1) + self.bias)[t.which]

    def summary(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(token marginals, a row of document features each text)."""
        p = marginals(self.logits(t), t.first, self.trans)
        n = t.counts()
        sure = np.append(0.0, np.cumsum(p))
        total = np.maximum(sure[t.first[1:]] - sure[t.first[:-1]], 0)
        top = np.zeros(len(n))
        full = n > 0
        if full.any():
            top[full] = np.maximum.reduceat(p, t.first[:-1][full])
        return p, np.stack([np.log1p(total), np.sqrt(total / np.maximum(n, 1)), top], axis=1)

    def score(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(token marginals, document scores)."""
        if self.document is None:
            return np.zeros(len(t)), np.zeros(len(t.first) - 1)
        p, x = self.summary(t)
        return p, 1 / (1 + np.exp(-np.clip(x @ self.document[:-1] + self.document[-1], -30, 30)))


def evidence(bad: np.ndarray, good: np.ndarray, bad_documents: int, good_documents: int) -> np.ndarray:
    """Log-likelihood ratio (G squared, one degree of freedom) that a feature
    of so many toxic and clean documents has different rates in the two."""
    share = (bad + good) / (bad_documents + good_documents)
    total = np.zeros(len(bad))
    for seen, of in ((bad, bad_documents), (good, good_documents)):
        for count, expected in ((seen, of * share), (of - seen, of * (1 - share))):
            some = count > 0
            total[some] += count[some] * np.log(count[some] / expected[some])
    return 2 * total


def mark_tokens(t: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Token labels from document labels: True in toxic texts where a feature is theirs alone or nearly so."""
    doc = np.repeat(np.arange(len(toxic)), t.counts())
    pair = np.unique(t.which * len(toxic) + doc)                     # a word once a document
    word, owner = pair // len(toxic), pair % len(toxic)
    bad_documents, all_documents = max(1, toxic.sum()), len(toxic)
    hit = np.zeros(len(t.rows), dtype=bool)
    for column in t.rows.T:                                          # one kind of feature after the other
        keys, number = np.unique(column, return_inverse=True)
        once = np.unique(number[word] * len(toxic) + owner)
        number_, owner_ = once // len(toxic), once % len(toxic)
        every = np.bincount(number_, minlength=len(keys))
        bad = np.bincount(number_, weights=toxic[owner_], minlength=len(keys))
        share = bad / bad_documents
        good_documents = max(1, all_documents - bad_documents)
        rate = share / np.maximum(share + (every - bad) / good_documents, 1e-12)
        sure = evidence(bad, every - bad, bad_documents, good_documents) >= EVIDENCE
        hit |= ((bad >= LEAST) & sure & (rate >= 0.97) & (keys != 0))[number]
    return hit[t.which] & (toxic[doc] == 1)


def fit(texts: list[str], toxic: list[int], epochs: int = 12, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Fit on the given documents (the bounded sample)."""
    seen = dict(zip(texts, toxic))                                    # equal texts teach once
    texts, label = list(seen), np.array(list(seen.values()))
    if not len(label) or label.min() == label.max():
        return Field()
    w = Tokens(texts)
    rows, which = w.rows, w.which
    y = mark_tokens(w, label)
    # segments: all with a marked token, and as many others (twice) dealt by their place's hash
    place = np.arange(len(w)) - np.repeat(w.first[:-1], w.counts())
    doc = np.repeat(np.arange(len(label)), w.counts())
    begin = np.flatnonzero(place % SEGMENT == 0)
    end = np.append(begin[1:], len(w))
    marked = np.add.reduceat(y, begin) > 0
    clean = np.flatnonzero(~marked)
    clean = clean[np.argsort(mix(clean.astype(np.uint64)))][:2 * max(200, int(marked.sum()))]
    chosen = np.sort(np.concatenate([np.flatnonzero(marked), clean]))
    begin, end = begin[chosen], end[chosen]
    keys, number = np.unique(rows, return_inverse=True)
    number = number.reshape(rows.shape)
    weights, bias, trans = np.zeros(len(keys)), -2.0, np.zeros((2, 2))
    g_w, g_b, g_t = np.full(len(keys), 1e-3), 1e-3, np.full((2, 2), 1e-3)
    turn = np.argsort(mix(np.arange(len(begin), dtype=np.uint64) + np.uint64(99)))
    for _ in range(epochs):
        for some in np.array_split(turn, max(1, len(turn) // 256)):
            size = end[some] - begin[some]
            first = np.append(0, np.cumsum(size))
            tok = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(begin[some], size)
            f = number[which[tok]]
            logit = np.where(rows[which[tok]] == 0, 0, weights[f]).sum(axis=1) + bias
            p = marginals(logit, first, trans)
            gap = (y[tok] - p) / len(some)
            inner = np.ones(len(tok), dtype=bool)
            inner[first[1:] - 1] = False                              # a token with a next one in its segment
            i = np.flatnonzero(inner)
            pair = _pairs(logit, first, trans, i)
            seen_pair = np.zeros((2, 2))
            np.add.at(seen_pair, (y[tok][i].astype(int), y[tok][i + 1].astype(int)), 1)
            d_t = (seen_pair - pair) / len(some) - decay * trans
            d_w = np.bincount(f.ravel(), weights=np.repeat(gap, f.shape[1]), minlength=len(keys)) - decay * weights
            d_b = gap.sum()
            g_w += d_w ** 2
            g_b += d_b ** 2
            g_t += d_t ** 2
            weights += rate * d_w / np.sqrt(g_w)
            bias += rate * d_b / np.sqrt(g_b)
            trans += rate * d_t / np.sqrt(g_t)
    weights[keys == 0] = 0
    used = np.abs(weights) > 1e-3
    used[0] = True
    field = Field(keys[used], weights[used], bias, trans, np.zeros(4))
    x = field.summary(w)[1]
    field.document = _logistic(x, label)
    return field


def _pairs(logit, first, trans, i) -> np.ndarray:
    """Expected number of tag pairs at places i, i + 1 of one segment."""
    e, t = np.exp(np.clip(logit, -60, 60)), np.exp(trans)
    lane = np.searchsorted(first, np.arange(len(logit)), side="right") - 1
    step = np.arange(len(logit)) - first[lane]
    ahead, behind = np.ones(len(logit)), np.ones(len(logit))
    for k in range(int(step.max()) + 1 if len(step) else 0):
        at = np.flatnonzero(step == k)
        ahead[at] = e[at] if k == 0 else e[at] * (t[0, 1] + ahead[at - 1] * t[1, 1]) / (t[0, 0] + ahead[at - 1] * t[1, 0])
    to_end = first[1:][lane] - 1 - np.arange(len(logit))
    for k in range(1, int(to_end.max()) + 1 if len(step) else 0):
        at = np.flatnonzero(to_end == k)
        o = behind[at + 1] * e[at + 1]
        behind[at] = (t[1, 0] + o * t[1, 1]) / (t[0, 0] + o * t[0, 1])
    joint = np.stack([np.ones(len(i)) * t[0, 0], e[i + 1] * behind[i + 1] * t[0, 1],
                      ahead[i] * t[1, 0], ahead[i] * e[i + 1] * behind[i + 1] * t[1, 1]])
    return (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and intercept by Newton's method, classes weighted alike."""
    a = np.append(x, np.ones((len(x), 1)), axis=1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    b = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        slope = a.T @ (weight * (y - p)) - penalty @ b
        curve = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + penalty
        step = np.linalg.solve(curve, slope)
        b = b + step / max(1.0, np.abs(step).max() / 5)
    return b


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic") -> Field:
    """The field from the labelled rows' sample. ``labels``: (doc_id, toxic).
    Bounds, for each class: ``sample`` documents with a text, in the order of
    their ids' hashes, as far as their texts take ``sample_bytes`` in all;
    texts beyond an eighth of that don't teach. Of texts that repeat an id the
    largest in code-point order does."""
    marked = labels.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(toxic).cast("int").alias("_toxic")).filter(
        "_id IS NOT NULL AND _toxic IN (0, 1)").groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text")).filter("_text IS NOT NULL")
    # only labels of texts that are there are drawn, and only sizes until the sample stands
    sized = texts.groupBy("_id").agg(F.max(F.octet_length("_text")).alias("_size")).join(marked, "_id").filter(F.col("_size") <= sample_bytes // 8)
    ids = []
    for kind in (1, 0):
        total = 0
        for r in sized.filter(F.col("_toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(sample).collect():      # at most ``sample`` rows
            total += r["_size"]
            if total <= sample_bytes:
                ids.append((r["_id"], kind))
    if not ids:
        return Field()
    chosen = docs.sparkSession.createDataFrame(ids, "_id bigint, _toxic int")
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic").agg(F.max("_text").alias("_text")).select("_id", "_text", "_toxic")
    rows = sorted(found.collect())
    return fit([r["_text"] for r in rows], [r["_toxic"] for r in rows])


RESULT = T.StructType([T.StructField("score", T.DoubleType()),
                       T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])


def tag(docs: DataFrame, field: Field, text: str = "text", limit: float = 0.5) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: score, and spans ([from, to) in bytes
    of the UTF-8 text) of the tokens whose marginal is over ``limit``."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        model = sent.value

        def column(texts):
            scores, spans = [], []
            for a, b in slices(texts):
                w = Words(texts[a:b], NON_ALNUM, fold=True)
                p, score = model.score(Tokens(texts[a:b]))
                scores += score.tolist()
                lengths = [len(t.encode("utf-8", "surrogatepass")) if t is not None else 0 for t in texts[a:b]]
                offset = np.append(0, np.cumsum(np.array(lengths, dtype=np.int64) + 1))[:-1] + 1
                own: list[list] = [[] for _ in range(b - a)]
                hits = np.flatnonzero(p > limit)
                doc = np.searchsorted(w.first, hits, side="right") - 1
                for d, s, e in zip(doc.tolist(), (w.start[hits] - offset[doc]).tolist(), (w.end[hits] - offset[doc]).tolist()):
                    own[d].append([s, e])
                spans += own
            return pa.StructArray.from_arrays([pa.array(scores, pa.float64()),
                                               pa.array(spans, pa.list_(pa.list_(pa.int64())))], names=["score", "spans"])
        return column
    return add_struct(docs, "toxicity", RESULT, text, make)


def learned_rows(labels: DataFrame) -> DataFrame:
    """The labels that may teach: crc32 of the id as text is not 1 modulo 3."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def remove_toxic(docs: DataFrame, field: Field, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    found, c = tag(docs, field, text)
    return found.filter(~(F.col(f"{c}.score") >= threshold)).drop(c)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every document's score."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    field = learn(docs, learned_rows(read(spark, sf_dir, "labels").select("doc_id", "toxic")))
    found, c = tag(docs, field)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), F.col(f"{c}.score").alias("score"),
                        (F.col(f"{c}.score") >= THRESHOLD).cast("int").alias("predicted"))
