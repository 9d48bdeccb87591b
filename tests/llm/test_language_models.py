"""Language models against a plain Kneser-Ney, rejection, rare scripts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm import langid

DOCS = "doc_id bigint, text string, lang string"


def plain_grams(text):
    """4-grams of a text's words, as tuples of characters."""
    out = []
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = "   " + word + " "
        out += [tuple(padded[i:i + 4]) for i in range(len(padded) - 3)]
    return out


class Plain:
    """Interpolated Kneser-Ney by dictionaries."""

    def __init__(self, texts):
        level = Counter(g for t in texts for g in plain_grams(t))
        self.levels = {4: level}
        for k in (3, 2, 1):
            level = Counter(g[1:] for g in level)
            self.levels[k] = level
        self.vocabulary = len(self.levels[1]) + 1
        self.discount, self.total, self.kinds = {}, {}, {}
        for k, level in self.levels.items():
            ones, twos = (sum(n == x for n in level.values()) for x in (1, 2))
            self.discount[k] = ones / (ones + 2 * twos) if ones and twos else 0.5
            self.total[k], self.kinds[k] = defaultdict(int), defaultdict(int)
            for g, n in level.items():
                self.total[k][g[:-1]] += n
                self.kinds[k][g[:-1]] += 1

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / self.vocabulary
        lower, total = self.p(gram[1:]), self.total[k][gram[:-1]]
        if not total:
            return lower
        return max(self.levels[k][gram] - self.discount[k], 0) / total + self.discount[k] * self.kinds[k][gram[:-1]] / total * lower

    def entropy(self, text):
        grams = plain_grams(text)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def some_text(rng, letters, words):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(words))


def test_models_equal_a_plain_kneser_ney(spark):
    """Both ways, on texts of seen and unseen characters; repeated rows count each."""
    rng = random.Random(4)
    rows = [(i, some_text(rng, letters, 40), name) for i, (name, letters) in enumerate([("a", "abcdé"), ("b", "cdefß"), ("a", "abé"), ("b", "fg")] * 3)]
    rows += [rows[0]] * 3
    asked = [(100 + i, t, None) for i, t in enumerate(["abba éa", "fegg", "zz abc", "Ünseen", "d", "x" * 3000, None])]
    docs = spark.createDataFrame(rows + asked, DOCS)
    plain = {name: Plain([t for _, t, n in rows if n == name]) for name in "ab"}
    for bound in (langid.MAX_GRAMS, 10):
        out, c = langid.identify(docs, langid.train(docs, max_grams=bound))
        got = {r.doc_id: r[c] for r in out.filter("lang IS NULL").collect()}
        for i, text, _ in asked[:-1]:
            entropy = {n: m.entropy(text) for n, m in plain.items()}
            assert got[i].entropy == pytest.approx(min(entropy.values()), abs=1e-4)
            assert got[i].lang == min(entropy, key=lambda n: (entropy[n], n)) and got[i].characters == len(plain_grams(text))
        assert got[106].lang == "und" and got[106].entropy is None


def test_calibrated_rejection_of_an_unseen_language(spark):
    """Limits from held-out texts: own texts stay, those of another alphabet and of mixed letters go, at any length."""
    rng = random.Random(8)
    syllables = {"aa": ["ba", "be", "lo", "mi", "na", "ti"], "bb": ["kru", "zek", "ix", "orr", "quv"]}

    def speak(name, words):
        return " ".join("".join(rng.choices(syllables[name], k=rng.randint(1, 4))) for _ in range(words))
    rows = [(i, speak("ab"[i % 2] * 2, rng.randint(5, 60)), "ab"[i % 2] * 2) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    models = langid.train(docs.filter("doc_id % 3 != 0"))
    limits = langid.calibrate(docs.filter("doc_id % 3 = 0"), models)
    assert set(limits) == {"aa", "bb"}
    fresh = [speak("ab"[i % 2] * 2, rng.randint(5, 60)) for i in range(200)]
    own = langid.guess(models, fresh, limits)
    assert sum(g[0] == "ab"[i % 2] * 2 for i, g in enumerate(own)) >= 190
    other = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=rng.randint(40, 300))) for _ in range(100)] + ["привет мир как дела сегодня"]
    assert sum(g[0] == "und" for g in langid.guess(models, other, limits)) >= 99
    tables = langid.train(docs.filter("doc_id % 3 != 0"), max_grams=10)
    asked = spark.createDataFrame([(i, t, None) for i, t in enumerate(fresh[:20] + other[:20])], DOCS)
    out, c = langid.identify(asked, tables, reject=limits)
    assert {r.doc_id: r[c].lang for r in out.collect()} == dict(enumerate(g[0] for g in own[:20] + langid.guess(models, other[:20], limits)))


def test_letters_beyond_the_first_plane_are_told_apart():
    deseret, gothic = "".join(map(chr, range(0x10428, 0x10440))), "".join(map(chr, range(0x10330, 0x10348)))
    rng = random.Random(3)
    grams = {}
    for name, letters in (("d", deseret), ("g", gothic)):
        g = langid.Grams([some_text(rng, letters, 200)])
        keys, which = np.unique(g.gram, return_inverse=True)
        grams[name] = langid.Model(keys, np.bincount(which, weights=np.bincount(g.word_of, minlength=g.n_words)[g.owner]).astype(np.int64))
    assert [x[0] for x in langid.guess(grams, [some_text(rng, gothic, 3), some_text(rng, deseret, 3)])] == ["g", "d"]
    one, two = (set(langid.Grams([c]).gram.tolist()) for c in ("\U00010330", "\U00018330"))    # once folded onto one key
    assert one != two


def test_ties_long_and_repeated_texts(spark):
    docs = spark.createDataFrame([(1, "ab ab", "y"), (2, "ab ab", "x"), (3, "ab " * 400_000, None), (3, "ab " * 400_000, None)], DOCS)
    out, c = langid.identify(docs, langid.train(docs))
    got = out.collect()
    assert len(got) == 4 and {r[c].lang for r in got} == {"x"}               # equal models: the smaller name
    assert [r[c].characters for r in got if r.doc_id == 3] == [1_200_000] * 2
