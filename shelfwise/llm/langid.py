"""Language identification with interpolated Kneser-Ney character models.

One model a language, over the characters of words: a word is its letters,
lower-cased, after three blanks and with one blank at its end, and every
character is predicted from the three before it. All training rows are
counted (each task adds up its own 4-grams, Spark adds the tasks'), and the
lower orders' continuation counts follow from the distinct 4-grams. A model
is, for each order, a sorted array of packed n-grams with their log
probabilities, and one of contexts with their back-off weights; four
characters of 16 bits (UTF-16 units) make one 64-bit key.

A text gets the language of the lowest cross-entropy per predicted character.
``score`` is its share in a softmax of the cross-entropies. ``calibrate``
measures, on labelled texts that did not teach, how far a language's own
texts lie from their mean cross-entropy, in standard errors of their length;
with that as ``reject`` a text further off than nearly all of those (the
quantile is a parameter) is ``und``. The registered query must name a learned
language for every text with a letter, so it rejects nothing else.

Every 4-gram counts. Up to ``max_grams`` of them the models travel to every
task (the given tables stay far below). Beyond that they are ``Tables``: the
same figures, made and written by Spark, to which the texts' 4-grams are
joined; the driver then holds a few numbers a language.

Defined results: null text or text without a letter is ``und`` with score 0;
so is everything when nothing could be learned; rows with a null language
teach nothing; ties go to the smaller language name; repeated rows count each; a
text of any length is read whole; extra columns pass through, and the added
one takes a fresh name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_struct, apart, fresh_name, read, stage_table
from .words import Words, separators, slices

ORDER = 4
MAX_GRAMS = 4_000_000           # more than these stay in tables
TASK_GRAMS = 1_000_000          # counted in a task before they are handed on
FINE = 1 << 28                  # log probabilities are added as whole numbers of 1 / FINE, in any order
UNKNOWN = "und"
TEMPERATURE = 20.0

_NO_LETTER = separators([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def _units(code: np.ndarray, owner: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters in 16 bits each: one beyond U+FFFF becomes its two UTF-16
    units, which no other letter shares."""
    wide = code > 0xFFFF
    if not wide.any():
        return code, owner, blank
    again = np.repeat(np.arange(len(code)), 1 + wide)
    second = np.append(False, again[1:] == again[:-1])
    out, rest = code[again], code[again] - np.uint64(0x10000)
    high = np.uint64(0xD800) + (rest >> np.uint64(10))
    low = np.uint64(0xDC00) + (rest & np.uint64(0x3FF))
    return np.where(wide[again], np.where(second, low, high), out), owner[again], blank[again]


class Grams:
    """Distinct words of some texts and the 4-grams of their characters.

    ``word_of``: the distinct word of each word place, ``words``: the Words;
    for each predicted character ``gram`` (packed, last character lowest) and
    ``owner`` (its distinct word)."""

    def __init__(self, texts: list[str | None]):
        w = self.words = Words(texts, _NO_LETTER, fold=True)
        _, at, self.word_of = np.unique(w.hash, return_index=True, return_inverse=True)
        self.n_words = len(at)
        data = w.data.tobytes()
        joined = b" ".join([data[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist())]) + b" "
        code = np.frombuffer(joined.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = code == 32
        owner = np.cumsum(blank) - blank                     # number of blanks before
        keep = blank | _alpha()[np.minimum(code, 0x10FFFF)]
        code, owner, blank = _units(code[keep].astype(np.uint64), owner[keep], blank[keep])
        if not self.n_words:
            code, owner, blank = code[:0], owner[:0], blank[:0]
        begin = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else np.zeros(0, np.int64)
        place = np.arange(len(code)) - np.repeat(begin, np.diff(np.append(begin, len(code))))
        gram = code.copy()
        for k in range(1, ORDER):
            before = np.full(len(code), 32, dtype=np.uint64)
            before[k:] = code[:-k] if k < len(code) else before[k:]
            gram |= np.where(place >= k, before, np.uint64(32)) << np.uint64(16 * k)
        letters = np.bincount(owner[~blank], minlength=self.n_words)
        used = letters[owner] > 0                            # a word without letters predicts nothing
        self.gram, self.owner, self.letters = gram[used], owner[used], letters

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.words.first) - 1), self.words.counts())


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                g = Grams(texts[a:b])
                keys, which = np.unique(g.gram, return_inverse=True)
                names, number = np.unique(np.array(langs[a:b], dtype=object).astype(str), return_inverse=True)
                own = number[g.text_of_word()]
                for k, name in enumerate(names.tolist()):
                    times = np.bincount(g.word_of[own == k], minlength=g.n_words)
                    n = np.bincount(which, weights=times[g.owner], minlength=len(keys)).astype(np.int64)
                    some = n > 0
                    total[name] = _add(total.get(name), keys[some], n[some])
                if sum(len(keys) for keys, _ in total.values()) > TASK_GRAMS:
                    yield from rows(total)
                    total = {}
        yield from rows(total)

    def rows(total) -> Iterator[pa.RecordBatch]:
        for name, (keys, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)],
                                             names=["lang", "gram", "n"])
    learn = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")
    return learn.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _add(have, keys, n):
    if have is None:
        return keys, n
    both, which = np.unique(np.concatenate([have[0], keys]), return_inverse=True)
    return both, np.bincount(which, weights=np.concatenate([have[1], n])).astype(np.int64)


class Model:
    """One language: for each order, sorted grams with log probabilities and
    sorted contexts with log back-off weights."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        order = np.argsort(grams)
        gram, count = grams[order], n[order].astype(np.float64)
        levels = [(gram, count)]
        for k in range(ORDER - 1, 0, -1):                     # continuation counts: distinct characters before
            gram, cc = np.unique(gram & np.uint64((1 << (16 * k)) - 1), return_counts=True)
            levels.append((gram, cc.astype(np.float64)))
        levels.reverse()
        self.vocabulary = len(levels[0][0]) + 1
        self.tables = []                                      # (grams, log p, contexts, log back-off), order 1 first
        lower = None
        for k, (gram, c) in enumerate(levels, start=1):
            context, which, kinds = np.unique(gram >> np.uint64(16), return_inverse=True, return_counts=True)
            total = np.bincount(which, weights=c)
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            back = discount * kinds / total
            low = np.full(len(gram), 1 / self.vocabulary) if lower is None else lower[
                np.searchsorted(self.tables[-1][0], gram & np.uint64((1 << (16 * (k - 1))) - 1))]
            lower = np.maximum(c - discount, 0) / total[which] + back[which] * low
            self.tables.append((gram, np.log(lower).astype(np.float32), context, np.log(back).astype(np.float32)))
        log_p = self.log_p(levels[-1][0])
        weight = levels[-1][1] / levels[-1][1].sum()
        self.mean = float(-(weight * log_p).sum())
        self.deviation = float(np.sqrt((weight * (log_p + self.mean) ** 2).sum()))

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of each 4-gram's last character."""
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            keys, value, contexts, back = self.tables[k - 1]
            g = grams[open_] & np.uint64((1 << (16 * k)) - 1) if k < 4 else grams[open_]
            at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            hit = keys[at] == g
            out[open_[hit]] += value[at[hit]]
            open_, g = open_[~hit], g[~hit] >> np.uint64(16)
            at = np.minimum(np.searchsorted(contexts, g), len(contexts) - 1)
            known = contexts[at] == g
            out[open_[known]] += back[at[known]]
        out[open_] -= np.log(self.vocabulary)
        return out


def _last(gram, k: int):
    """The last k characters of a packed n-gram column."""
    return F.col(gram).bitwiseAND(F.lit((1 << (16 * k)) - 1))


def _context(gram):
    return F.shiftrightunsigned(gram, 16)


class Tables:
    """The models of all languages as written tables, by the formulas of
    ``Model``. ``grams[k]``: gram -> {language: log p} of order k;
    ``contexts[k]``: context -> {language: log back-off}; ``languages``: one
    row a language (log p of an unknown character, mean and deviation)."""

    def __init__(self, counts: DataFrame):
        level = counts.select("lang", "gram", F.col("n").cast("double").alias("c"))
        levels = {ORDER: level}
        for k in range(ORDER - 1, 0, -1):                     # continuation counts: distinct characters before
            level = stage_table(level.groupBy("lang", _last("gram", k).alias("gram")).agg(
                F.count(F.lit(1)).cast("double").alias("c")), "language-level")
            levels[k] = level
        self.grams, self.contexts = {}, {}
        vocabulary = levels[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("vocabulary"))
        lower = None
        for k in range(1, ORDER + 1):
            ones, twos = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
            discount = levels[k].groupBy("lang").agg(
                F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5).alias("discount"))
            context = stage_table(levels[k].groupBy("lang", _context("gram").alias("context")).agg(
                F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("total")).join(F.broadcast(discount), "lang").withColumn(
                "back", F.col("discount") * F.col("kinds") / F.col("total")), "language-contexts")
            gram = levels[k].withColumn("context", _context("gram")).join(context, ["lang", "context"])
            if lower is None:
                gram = gram.join(F.broadcast(vocabulary), "lang").withColumn("low", 1 / F.col("vocabulary"))
                first = context
            else:
                gram = gram.withColumn("suffix", _last("gram", k - 1)).join(
                    lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("low")), ["lang", "suffix"])
            p = F.greatest(F.col("c") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("back") * F.col("low")
            lower = stage_table(gram.select("lang", "gram", "c", p.alias("p")).withColumn("log_p", _log("p")), "language-grams")
            self.grams[k] = stage_table(lower.groupBy("gram").agg(_by_language("log_p")), "language-grams")
            self.contexts[k] = stage_table(context.groupBy("context").agg(_by_language(_log("back"))), "language-contexts")
        mean = -F.sum(F.col("c") * F.col("log_p")) / F.sum("c")
        square = F.sum(F.col("c") * F.col("log_p") ** 2) / F.sum("c")
        fit = lower.groupBy("lang").agg(mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("deviation"))
        self.languages = stage_table(fit.join(vocabulary, "lang").join(first.select("lang", "back"), "lang").select(
            "lang", "mean", "deviation", (_log("back") - F.log("vocabulary")).alias("unknown")), "languages")

    def log_p(self, grams: DataFrame) -> DataFrame:
        """(gram, lang, log_p) of each gram in every language."""
        for k in range(ORDER, 0, -1):
            own, context = self.grams[k].withColumnRenamed("by", f"g{k}"), self.contexts[k].withColumnRenamed("by", f"b{k}")
            if k == 1:                                       # at most 65,536 characters
                own = F.broadcast(own)
            grams = grams.withColumn("_own", _last("gram", k) if k < ORDER else F.col("gram"))
            grams = grams.join(own.withColumnRenamed("gram", "_own"), "_own", "left")
            if k > 1:
                context = F.broadcast(context) if k == 2 else context
                grams = grams.withColumn("context", _context("_own")).join(context, "context", "left").drop("context")
            grams = grams.drop("_own")
        log_p = F.coalesce(F.try_element_at("g1", "lang"), F.col("unknown"))
        for k in range(2, ORDER + 1):
            log_p = F.coalesce(F.try_element_at(f"g{k}", F.col("lang")),
                               F.coalesce(F.try_element_at(f"b{k}", F.col("lang")), F.lit(0.0)) + log_p)
        return grams.crossJoin(F.broadcast(self.languages)).select("gram", "lang", log_p.alias("log_p"))


def _log(value):
    return F.log(value).cast("float").cast("double")          # as precise as a Model's


def _by_language(value):
    return F.map_from_entries(F.collect_list(F.struct("lang", F.col(value) if isinstance(value, str) else value))).alias("by")


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_grams: int = MAX_GRAMS) -> dict[str, Model] | Tables:
    counts = stage_table(count_grams(docs, text, lang), "language-counts")
    if counts.count() > max_grams:
        return Tables(counts)
    counts = counts.toPandas()                                # at most max_grams rows
    return {str(name): Model(g["gram"].to_numpy().astype(np.uint64), g["n"].to_numpy())
            for name, g in counts.groupby("lang")}


GUESS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("entropy", T.DoubleType()), T.StructField("characters", T.LongType())])

#: language → (mean cross-entropy, deviation of one character, standard errors allowed)
Limits = dict[str, tuple[float, float, float]]


def limits(models: dict[str, Model] | Tables, reject: float | Limits) -> Limits:
    """``reject`` as limits a language; a number means so many standard
    errors from the counts themselves."""
    if isinstance(reject, dict):
        return reject
    if isinstance(models, Tables):
        return {r.lang: (r.mean, r.deviation, reject) for r in models.languages.collect()}          # one row a language
    return {name: (m.mean, m.deviation, reject) for name, m in models.items()}


def calibrate(docs: DataFrame, models: dict[str, Model] | Tables, text: str = "text", lang: str = "lang",
              quantile: float = 0.995) -> Limits:
    """Limits from labelled rows that did not teach: of the texts of each
    language (as labelled), the mean cross-entropy a character, the deviation
    that their lengths explain, and the quantile of how many standard errors
    they lie over the mean. Languages without such rows have no limit."""
    found, c = identify(docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("own")), models)
    held = stage_table(found.select("own", F.col(f"{c}.*")).filter("own = lang AND characters > 0").select(
        "own", "entropy", F.col("characters").cast("double").alias("n")), "language-calibration")
    mean = held.groupBy("own").agg((F.sum(F.col("entropy") * F.col("n")) / F.sum("n")).alias("mean"))
    off = held.join(F.broadcast(mean), "own").withColumn("off", (F.col("entropy") - F.col("mean")) * F.sqrt("n"))    # one row a language
    spread = off.groupBy("own").agg(F.first("mean").alias("mean"), F.sqrt(F.avg(F.col("off") ** 2)).alias("deviation"),
                                    F.percentile_approx("off", quantile, 10000).alias("far")).collect()
    return {r.own: (r.mean, r.deviation, r.far / r.deviation if r.deviation else 0.0) for r in spread}


def guess(models: dict[str, Model], texts: list[str | None], reject: float | Limits | None = None
          ) -> list[tuple[str, float, float | None]]:
    """(language, score, cross-entropy) of each text."""
    return [found[:3] for found in guesses(models, texts, reject)]


def guesses(models: dict[str, Model], texts: list[str | None], reject: float | Limits | None = None
            ) -> list[tuple[str, float, float | None, int]]:
    """(language, score, cross-entropy, characters) of each text."""
    names = sorted(models)
    allowed = limits(models, reject) if reject is not None else {}
    out: list[tuple[str, float, float | None, int]] = []
    for a, b in slices(texts):
        g = Grams(texts[a:b])
        keys, which = np.unique(g.gram, return_inverse=True)
        text_of = g.text_of_word()
        size = np.bincount(g.owner, minlength=g.n_words)
        n = np.bincount(text_of, weights=size[g.word_of], minlength=b - a)
        if not names:
            out += [(UNKNOWN, 0.0, None, int(k)) for k in n]
            continue
        entropy = np.empty((len(names), b - a))
        for k, name in enumerate(names):
            of_word = np.bincount(g.owner, weights=models[name].log_p(keys)[which], minlength=g.n_words)
            entropy[k] = -np.bincount(text_of, weights=of_word[g.word_of], minlength=b - a) / np.maximum(n, 1)
        best = entropy.argmin(axis=0)
        low = entropy.min(axis=0)
        share = 1 / np.exp(-TEMPERATURE * (entropy - low)).sum(axis=0)
        for d in range(b - a):
            if not n[d]:
                out.append((UNKNOWN, 0.0, None, 0))
                continue
            mean, deviation, errors = allowed.get(names[best[d]], (0.0, 0.0, None))
            far = errors is not None and low[d] > mean + errors * deviation / np.sqrt(n[d])
            out.append((UNKNOWN if far else names[best[d]], float(share[d]), float(low[d]), int(n[d])))
    return out


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, gram, n) of (row, text)."""
    for batch in batches:
        rows, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for a, b in slices(texts):
            g = Grams(texts[a:b])
            if not len(g.gram):
                continue
            keys, which = np.unique(g.gram, return_inverse=True)
            size = np.bincount(g.owner, minlength=g.n_words)
            begin, times = np.append(0, np.cumsum(size))[:-1], size[g.word_of]
            end = np.cumsum(times)                            # each word place's grams, one after the other
            at = np.arange(end[-1]) - np.repeat(end - times, times) + np.repeat(begin[g.word_of], times)
            pair, n = np.unique(np.repeat(g.text_of_word(), times) * len(keys) + which[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(rows[a:b][pair // len(keys)]), pa.array(keys[pair % len(keys)].astype(np.int64)),
                                              pa.array(n.astype(np.int64))], names=["row", "gram", "n"])


def _identify_by_tables(docs: DataFrame, models: Tables, text: str, reject: float | Limits | None) -> tuple[DataFrame, str]:
    name, row = fresh_name(docs, "language"), fresh_name(docs, "row")
    staged = stage_table(docs.withColumn(row, F.monotonically_increasing_id()), "language-documents")
    asked = staged.select(F.col(f"`{row}`"), F.col(f"`{text}`")).mapInArrow(_text_grams, "row bigint, gram bigint, n bigint")
    fine = models.log_p(asked.select("gram").distinct()).withColumn("fine", F.round(F.col("log_p") * FINE).cast("bigint"))
    by = fine.groupBy("gram").agg(F.collect_list(F.struct("lang", "fine")).alias("by"))
    each = asked.join(apart(by, "gram"), "gram").select("row", "n", F.inline("by")).groupBy("row", "lang").agg(
        (-F.sum(F.col("n") * F.col("fine")) / F.lit(float(FINE)) / F.sum("n")).alias("entropy"), F.sum("n").alias("n"))
    best = each.groupBy("row").agg(F.min(F.struct("entropy", "lang", "n")).alias("best"),
                                   F.collect_list("entropy").alias("all"))
    low = F.col("best.entropy")
    share = 1 / F.aggregate(F.array_sort("all"), F.lit(0.0), lambda s, e: s + F.exp(-TEMPERATURE * (e - low)))
    far = F.lit(False)
    for name_, (mean, deviation, errors) in (limits(models, reject) if reject is not None else {}).items():       # one a language
        far = far | ((F.col("best.lang") == name_) & (low > mean + errors * deviation / F.sqrt("best.n")))
    guessed = best.select(F.col("row").alias(row), F.struct(
        F.when(far, UNKNOWN).otherwise(F.col("best.lang")).alias("lang"), share.alias("score"), low.alias("entropy"), F.col("best.n").alias("characters")).alias(name))
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("bigint").alias("characters"))
    found = staged.join(guessed, row, "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(name), nothing).alias(name)), name


def identify(docs: DataFrame, models: dict[str, Model] | Tables, text: str = "text",
             reject: float | Limits | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (lang, score, entropy, characters), and its name."""
    if isinstance(models, Tables):
        return _identify_by_tables(docs, models, text, reject)
    sent = docs.sparkSession.sparkContext.broadcast(models)   # at most max_grams 4-grams

    def make():
        def column(texts):
            found = guesses(sent.value, texts, reject)
            return pa.StructArray.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in
                                               enumerate((pa.string(), pa.float64(), pa.float64(), pa.int64()))],
                                              names=["lang", "score", "entropy", "characters"])
        return column
    return add_struct(docs, "language", GUESS, text, make)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: the language of every document, learned from three quarters."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    models = train(docs.filter(~held_out))
    found, c = identify(docs.select("doc_id", "text", held_out.alias("held_out")), models)
    return found.select("doc_id", "held_out", F.col(f"{c}.lang").alias("lang_pred"), F.col(f"{c}.score").alias("score"))
