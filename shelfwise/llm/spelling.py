"""Spelling variants: words one edit apart, found in a trie of letter counts.

``words`` counts a corpus's words with SQL functions. ``near_pairs`` finds all
pairs of words that differ by one inserted, deleted or replaced letter:

* A word becomes its length and its counts of ``GROUPS`` letter groups, those
  that vary most first. Words arranged by successive counts are a trie.
* A search goes down the trie and may meet one count that is one higher than
  its own (surplus) and one that is one lower (deficit): no single edit moves
  the counts further. A word asks for words of its own length, where the
  surplus must come before the deficit, and for words one letter longer, where
  there is no deficit, so that every pair is found from one of its two ends.
* Leaf words are verified letter by letter.

The trie's upper levels are walked by Spark, a level a round: nodes that hold
at most ``capacity`` letters' worth of words are settled with the searches
that reached them, larger ones are opened, and each round is written to the
shared folder. A settled node's searches are dealt into chunks of at most
``capacity`` rows with a copy of the node's (bounded) words each, and the rest
of the trie is walked there for many searches at once in numpy. Words that
agree in every count and are more than a node may hold are dealt into chunks
of their own, each asked by every search of that node; nothing is dropped.

``variant_forms`` picks each word's form and follows forms to the root by
doubling the step (a form has twice the count at least, so chains are short).
The driver sees the groups' variances and one row count a round.

Defined results: null and empty texts have no words; a null doc_id counts as
an empty one in the deletion rule; repeated rows count each; equal counts of
two near words go to the smaller in code-point order; an empty table gives no
rows; extra columns are ignored; a text of any length is read whole (its words
pass through one row's array).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, read, stage_table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 5
MIN_COUNT = 3
TYPO_EVERY = 97                   # a run whose crc32 this divides loses one letter
RATIO = 2

GROUPS = 24
MOST = 15                         # counts are clipped here; clipping never widens a difference
CAPACITY = 1 << 18                # letters of a settled node's words, and of a chunk's searches
BATCH = 1 << 19                   # states or candidates held at once in a task

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
          min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased and the deletion rule
    applied, of at least ``min_length`` letters and ``min_count`` occurrences."""
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    runs = docs.select(key.alias("id"), F.explode(F.regexp_extract_all(
        F.translate(F.col(f"`{text}`"), _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % TYPO_EVERY == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(
        F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    # a run of fewer letters can't become a word
    found = runs.filter(F.length("run") >= min_length).select(word.alias("word")).filter(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def letters(values) -> tuple[np.ndarray, np.ndarray]:
    """Code points of some words, one after the other, and their lengths."""
    points = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and points.max() < 256:
        points = points.astype(np.uint8)
    return points, np.fromiter(map(len, values), np.int64, len(values))


def counts_of(values) -> np.ndarray:
    """Words × letter groups, clipped at ``MOST``."""
    points, size = letters(values)
    row = np.repeat(np.arange(len(size)), size)
    got = np.bincount(row * GROUPS + points % np.uint8(GROUPS), minlength=len(size) * GROUPS)
    return np.minimum(got, MOST).astype(np.uint8).reshape(-1, GROUPS)


def _spelled(order: np.ndarray):
    """Adds a word's counts as a string, one character (from ``0``) a group."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            c = counts_of(f["word"].tolist())[:, order] + np.uint8(48) if len(f) else np.zeros((0, GROUPS), np.uint8)
            text = c.tobytes().decode("ascii")
            yield f.assign(counts=[text[i:i + GROUPS] for i in range(0, len(text), GROUPS)])
    return run


def _group_order(vocabulary: DataFrame) -> np.ndarray:
    """The letter groups, most varying first."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, GROUPS))
        for f in frames:
            if len(f):
                c = counts_of(f["word"].tolist()).astype(np.float64)
                total += np.stack([np.full(GROUPS, len(c)), c.sum(axis=0), (c * c).sum(axis=0)])
        yield pd.DataFrame({"g": np.arange(GROUPS), "k": total[0], "s": total[1], "q": total[2]})
    sums = vocabulary.select("word").mapInPandas(run, "g int, k double, s double, q double")
    rows = sums.groupBy("g").agg(*[F.sum(c).alias(c) for c in "ksq"]).collect()           # GROUPS rows
    spread = {r.g: r.q / r.k - (r.s / r.k) ** 2 if r.k else 0.0 for r in rows}
    return np.array(sorted(range(GROUPS), key=lambda g: (-spread.get(g, 0.0), g)))


#: A search's state: none spent, surplus spent, both spent (same length); none spent, surplus spent (one longer).
SAME, OWES, BOTH, LONGER, SPENT = range(5)
#: state → (state for an equal count, for one more, for one fewer), -1: not allowed
STEPS = np.array([[SAME, OWES, -1], [OWES, -1, BOTH], [BOTH, -1, -1], [LONGER, SPENT, -1], [SPENT, -1, -1]])


def _next_nodes(level: int) -> Column:
    """The children that a row of the walk goes on to, as (node, state)."""
    own = F.substring("counts", level + 1, 1)
    code = F.ascii(own)
    state, node = F.col("state"), F.col("node")

    def child(shift: int, column: int) -> Column:
        after = F.element_at(F.array(*[F.lit(int(s)) for s in STEPS[:, column]]), state + 1)
        return F.struct(F.concat(node, F.chr((code + shift).cast("bigint")) if shift else own).alias("node"),
                        F.when(F.lit(shift == 0) | F.col("asks"), after).otherwise(F.lit(-1)).alias("state"))
    stay = F.struct(F.concat(node, own).alias("node"), state.alias("state"))
    moves = F.array(child(0, 0), child(1, 1), child(-1, 2))
    return F.when(F.col("asks"), F.filter(moves, lambda m: m["state"] >= 0)).otherwise(F.array(stay))


def deal(vocabulary: DataFrame, order: np.ndarray, capacity: int = CAPACITY) -> DataFrame:
    """Words and searches under the settled nodes of the trie: (node, chunk,
    asks, state, word, n). Rows of one (node, chunk) are bounded."""
    spelled = stage_table(vocabulary.mapInPandas(_spelled(order), "word string, n bigint, counts string"), "spelled")
    size = F.length("word")
    asks = F.col("asks")

    def start(asking: bool, longer: int, state: int):
        return F.struct(F.lit(asking).alias("asks"), F.concat((size + longer).cast("string"), F.lit(":")).alias("node"),
                        F.lit(state).alias("state"))
    open_ = spelled.select("*", F.explode(F.array(start(False, 0, SAME), start(True, 0, SAME), start(True, 1, LONGER))).alias(
        "_s")).select("_s.*", "word", "n", "counts")
    settled = []
    for level in range(GROUPS + 1):
        held = open_.groupBy("node").agg(
            F.sum(F.when(~asks, size)).alias("held"), F.sum(F.when(asks, size)).alias("asking")).filter("held > 0")
        walked = stage_table(open_.join(held, "node"), "spelling-walk")
        bottom = level == GROUPS
        done = walked if bottom else walked.filter(F.col("held") <= capacity)
        settled.append(done.select("node", "asks", "state", "word", "n", "held", "asking"))
        open_ = walked.filter(F.col("held") > capacity)
        if bottom or open_.isEmpty():
            break
        open_ = open_.select("asks", "word", "n", "counts", F.explode(_next_nodes(level)).alias("_m")).select(
            "asks", "word", "n", "counts", "_m.node", "_m.state")
    rows = settled[0]
    for s in settled[1:]:
        rows = rows.unionByName(s)
    # words of a node are dealt into parts (more than one at the trie's bottom only), its searches into lots; each part meets each lot
    parts, lots = (F.ceil(F.col(c) / capacity).cast("int") for c in ("held", "asking"))
    own = F.pmod(F.xxhash64("word"), F.when(asks, lots).otherwise(parts))
    other = F.sequence(F.lit(0), F.coalesce(F.when(asks, parts).otherwise(lots), F.lit(1)) - 1)
    return rows.select("node", "asks", "state", "word", "n", own.alias("own"), F.explode(other).alias("other")).select(
        "node", F.when(asks, F.concat_ws("/", "other", "own")).otherwise(F.concat_ws("/", "own", "other")).alias("chunk"),
        "asks", "state", "word", "n")


class Trie:
    """Words by their counts, a table of children a level."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        c = counts[self.order]
        node = np.zeros(len(c), dtype=np.int64)
        self.children = []
        for level in range(c.shape[1]):
            edge, child = np.unique(node * (MOST + 3) + c[:, level] + 1, return_inverse=True)
            table = np.full((int(node[-1]) + 1) * (MOST + 3), -1, dtype=np.int32)     # nodes are numbered in order
            table[edge] = np.arange(len(edge))
            self.children.append(table)
            node = child
        self.first = np.append(np.flatnonzero(np.diff(node, prepend=-1)), len(c))

    def search(self, counts: np.ndarray, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(search, word) numbers of the leaves' words, in bounded batches."""
        stack = [(0, np.arange(len(counts)), np.zeros(len(counts), np.int64), state)]
        while stack:
            level, who, node, state = stack.pop()
            if len(who) > BATCH:
                half = len(who) // 2
                stack += [(level, who[:half], node[:half], state[:half]), (level, who[half:], node[half:], state[half:])]
            elif level == len(self.children):
                begin, size = self.first[node], self.first[node + 1] - self.first[node]
                total = np.cumsum(size)
                cut = [0, *(np.flatnonzero(np.diff(total // BATCH)) + 1).tolist(), len(who)]
                for a, b in zip(cut[:-1], cut[1:]):
                    k = np.repeat(np.arange(a, b), size[a:b])
                    at = np.arange(len(k)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
                    yield who[k], self.order[begin[k] + at]
            else:
                place = node * (MOST + 3) + counts[who, level] + 1
                got = []
                for column, shift in enumerate((0, 1, -1)):
                    after = STEPS[state, column]
                    child = np.where(after >= 0, self.children[level][place + shift], -1)
                    ok = np.flatnonzero(child >= 0)
                    got.append((who[ok], child[ok].astype(np.int64), after[ok]))
                if sum(len(g[0]) for g in got):
                    stack.append((level + 1, *(np.concatenate(x) for x in zip(*got))))


def one_edit(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Row by row: do the letters differ by one replaced letter, or is ``held``
    (one longer) ``asked`` with one more letter?"""
    n = asked.shape[1]
    if held.shape[1] == n:
        return (asked != held).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(asked == held[:, :n], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((asked == held[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


def _pairs_in(group: pd.DataFrame, order: np.ndarray) -> Iterator[pd.DataFrame]:
    """Near pairs among one node's words and one lot of its searches. The
    groups' order is the upper levels': which of two words asks depends on it."""
    held = group[~group["asks"]]
    if not len(held) or len(held) == len(group):
        return
    names, n = held["word"].to_numpy(), held["n"].to_numpy()
    points, size = letters(names)
    width = int(size[0])                          # one length a node
    own = points.reshape(-1, width)
    trie = Trie(counts_of(names)[:, order])
    for longer in (False, True):
        asked = group[group["asks"] & ((group["state"] >= LONGER) == longer)]
        if not len(asked):
            continue
        word, times = asked["word"].to_numpy(), asked["n"].to_numpy()
        theirs = letters(word)[0].reshape(-1, width - longer)
        first = np.full(len(word), LONGER if longer else SAME)      # a search starts afresh under the node's own trie
        step = max(1, BATCH // max(1, width))
        for who, at in trie.search(counts_of(word)[:, order], first):
            for a in range(0, len(who), step):
                i, j = who[a:a + step], at[a:a + step]
                ok = one_edit(theirs[i], own[j])
                i, j = i[ok], j[ok]
                if not longer:                   # equal counts meet from both ends: keep one
                    once = _once(counts_of(word[i]), counts_of(names[j]), word[i], names[j]) if len(i) else np.zeros(0, bool)
                    i, j = i[once], j[once]
                if len(i):
                    yield pd.DataFrame({"a": word[i], "a_n": times[i], "b": names[j], "b_n": n[j]})


def _once(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (x != y).any(axis=1) | np.fromiter((p < q for p, q in zip(a, b)), bool, len(a))


def _by_chunk(order: np.ndarray):
    """Cuts sorted rows into (node, chunk) groups; one group is held at a time."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if not len(f):
                continue
            node, chunk = f["node"].to_numpy(), f["chunk"].to_numpy()
            cut = [0, *(np.flatnonzero((node[1:] != node[:-1]) | (chunk[1:] != chunk[:-1])) + 1).tolist()]
            for a, b in zip(cut[:-1], cut[1:]):
                yield from _pairs_in(f.iloc[a:b], order)
            rest = f.iloc[cut[-1]:]
        if rest is not None and len(rest):
            yield from _pairs_in(rest, order)
    return run


def near_pairs(vocabulary: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(word, n) → (a, a_n, b, b_n), every pair of distinct words one edit
    apart once, in any order. Words are distinct and not empty."""
    order = _group_order(vocabulary)
    dealt = deal(vocabulary, order, capacity)
    n = partitions(vocabulary.sparkSession)
    return dealt.repartition(n, "node", "chunk").sortWithinPartitions("node", "chunk").mapInPandas(
        _by_chunk(order), "a string, a_n bigint, b string, b_n bigint")


def variant_forms(vocabulary: DataFrame, capacity: int = CAPACITY, ratio: int = RATIO) -> DataFrame:
    """(word, n) → word, n, n_near, form, form_n and root."""
    vocabulary = stage_table(vocabulary.select("word", "n"), "vocabulary")
    pairs = stage_table(near_pairs(vocabulary, capacity), "near-words")
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    best = pairs.select(sides.alias("_p")).select("_p.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = vocabulary.join(best, "word", "left")
    has = -F.col("best.m") >= ratio * F.col("n")
    formed = stage_table(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n")), "spelling-forms")
    # follow the forms, twice as far each round
    step = stage_table(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = step.alias("s").join(step.select(F.col("word").alias("at"), F.col("root").alias("further")).alias("t"),
                                  F.col("s.root") == F.col("t.at"), "left")
        after = stage_table(on.select("word", F.coalesce("further", "root").alias("root"), "further"), "spelling-roots")
        step = after.select("word", "root")
        if after.filter("further IS NOT NULL").isEmpty():
            break
    return formed.join(step, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every word of the documents with its form and root."""
    return variant_forms(words(read(spark, sf_dir, "documents").select("doc_id", "text")))


def brute_force(docs: list[tuple[int | None, str | None]]) -> dict[str, tuple]:
    """word → (n, n_near, form, form_n, root) by comparing all pairs, for tests."""
    import re
    import zlib
    from collections import Counter
    seen: Counter = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % TYPO_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            seen[run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= MIN_LENGTH and c >= MIN_COUNT}

    def near(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    close = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(c, key=lambda v: (-n[v], v), default=None) for w, c in close.items()}
    form = {w: v if v is not None and n[v] >= RATIO * n[w] else None for w, v in best.items()}
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], len(close[w]), form[w], n[form[w]] if form[w] is not None else None, root)
    return out
