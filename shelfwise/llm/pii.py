"""PII surrogates: every detected entity gets a keyed replacement of its kind.

Detection finds e-mail addresses, phone numbers (international, and local
ones with a leading zero), IPv4 addresses, card numbers, social security
numbers, IBANs, secrets (assigned passwords and tokens, access keys, long hex
strings), dates of birth and passport numbers after words that say so, and
names after a title; in a document that names somebody so, every other
mention of the whole name or of a part of it is found too. An entity is known
by its kind and normal form (digits only, lower case), so its mentions in any
format are one entity; a name's words are entities of their own, whatever
title stands before them.

A surrogate is drawn from HMAC-SHA256(key, kind, normal form, attempt): digits
become digits, letters become letters of the same script and case, signs and
layout stay; cards keep issuer digit and check sum, IBANs country and check
digits, addresses stay addresses; a name's word that ends in a vowel (as
feminine given names mostly do) gets one that does, others one that ends in a
consonant, in the word's script. Dates move by a keyed number of days, so
different ones stay different. The same entity has the same surrogate
everywhere (coreference).

Collision checks keep different entities different: over all entities of the
corpus (a distinct table, aggregated before it is shuffled), those that share
a surrogate, or whose surrogate is some entity's real value, take their next
attempt until none do; after ``WIDEN`` attempts a surrogate grows by a
character (an IPv4 address can't: after ``MOST`` attempts the run ends with an
error that names the kind). Entities beyond their first attempt are few; up to ``SEND`` of
them are sent to the tasks, more are joined to their documents instead.

The key is the caller's; without one a random key of the application is used
(``session_key``), so surrogates can't be told from the source code.

Defined results: null text stays null, empty text empty; repeated rows are
replaced alike; all other columns pass through, whatever their names; texts of
any length are scanned whole; of overlapping entities the earlier kind wins;
an empty table gives no rows.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_struct, apart, batch_slices, fresh_name, let_go, read, stage_table
from .words import SLICE_BYTES

WIDEN = 16
MOST = 64
KEY_SETTING = "spark.shelfwise.pii.key"
SEND = 100_000

_TITLES = ("mr", "mister", "herr", "monsieur", "señor", "sr", "sir", "mrs", "ms", "miss", "frau", "madame", "mme", "señora", "sra", "dr", "prof")
_CAPITAL = "[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"
_TAIL = "[a-zß-öø-ÿα-ωά-ώа-яё'’\\-]+"

#: (kind, pattern); the group ``v``, where there is one, is the entity. Earlier kinds win.
PATTERNS = [
    ("email", r"[\w.%+\-]+@[\w\-]+(?:\.[\w\-]+)+"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|passphrase|token|secret|api[_\-]?key|access[_\-]?key|auth)\b[\"']?\s*[=:]\s*[\"']?)(?P<v1>[^\s\"',;]{4,})"),
    ("secret", r"\b(?:AKIA|ASIA)[0-9A-Z]{12,20}\b|\bgh[pousr]_[A-Za-z0-9]{20,}\b|\bsk-[A-Za-z0-9\-_]{16,}|\beyJ[\w\-]{8,}\.[\w\-]{8,}\.[\w\-]{8,}|\b(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{24,}\b"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"),
    ("card", r"(?<![\w.])[3-6]\d{3}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\w]|[.\-]\d)"),
    ("ssn", r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"),
    ("phone", r"(?<![\w.])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}|\(\d{2,4}\) ?\d{3,4}[ .\-]\d{3,4}|0\d{1,4}[ /\-]\d{5,8}(?:[ \-]\d{1,4})?|\d{3}[ .\-]\d{3}[ .\-]\d{4})(?![\w]|[.\-]\d)"),
    ("name", rf"\b(?i:(?P<title>{'|'.join(_TITLES)}))\.? (?P<v2>{_CAPITAL}{_TAIL}(?: {_CAPITAL}{_TAIL})?)"),
]
_ALL = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(PATTERNS)))
_HAS = re.compile(r"[0-9@=:]")
#: dates of birth and passport numbers, by the words before them
_SAID = re.compile(r"(?i:birth|born|dob|gebor|geburt|naiss|n[ée]e? le|nacid|nacim|passport|passeport|pasaporte|reisepass)")
_CONTEXT = re.compile(
    r"(?i:\b(?:born|dob|date of birth|birth ?(?:date|day)|geboren|geburtsdatum|geburtstag|née?|naissance|nacid[oa]|nacimiento))"
    r"(?:\W{0,3}(?i:on|am|le|el|is|der|war|was))?\W{1,3}(?P<date>\d{4}-\d{1,2}-\d{1,2}|\d{1,2}(?P<sign>[./\-])\d{1,2}(?P=sign)\d{4})(?!\w)"
    r"|(?i:\b(?:passport|passeport|pasaporte|reisepass))(?:[ \-]?(?i:no|nr|num|number|nummer|número|numéro))?\W{1,3}(?P<passport>(?=[A-Z]*\d)[A-Z0-9]{6,9})(?!\w)")
_TITLED = re.compile(rf"\b(?i:{'|'.join(_TITLES)})\.? {_CAPITAL}")


_POSSESSIVE = re.compile(r"['’]s?\Z|-\Z")


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(from, to, kind, normal form) of the text's entities, in order."""
    if not text or not (_HAS.search(text) or _TITLED.search(text)):
        return []
    out, names = [], set()
    for m in _ALL.finditer(text):
        kind = PATTERNS[int(m.lastgroup[1:]) if m.lastgroup[0] == "k" else next(
            i for i in range(len(PATTERNS)) if m[f"k{i}"] is not None)][0]
        group = "v1" if m["v1"] is not None else "v2" if m["v2"] is not None else 0
        value = m[group]
        if kind == "name":
            value = _POSSESSIVE.sub("", value)
            names.add(value)
        out.append((m.start(group), m.start(group) + len(value), kind, normal(kind, value)))
    more = []
    if _SAID.search(text):
        for m in _CONTEXT.finditer(text):
            kind = "date" if m["date"] is not None else "passport"
            if kind == "passport" or _date(m[kind]) is not None:
                more.append((m.start(kind), m.end(kind), kind, normal(kind, m[kind])))
    if names:                                     # the other mentions of who was named
        words = names | {w for n in names for w in n.split(" ") if len(w) > 2}
        again = re.compile(rf"(?<![\w\-])(?:{'|'.join(map(re.escape, sorted(words, key=len, reverse=True)))})(?![\w\-])")
        more += [(m.start(), m.end(), "name", normal("name", m[0])) for m in again.finditer(text)]
    if not more:
        return out
    out += more
    kept, end = [], -1
    for place, found in sorted(enumerate(out), key=lambda x: (x[1][0], x[0])):
        if found[0] >= end:
            kept.append(found)
            end = found[1]
        elif place < len(out) - len(more):        # an earlier kind begins inside a later one: it wins
            while kept and kept[-1][1] > found[0]:
                kept.pop()
            kept.append(found)
            end = found[1]
    return kept


def units(kind: str, value: str) -> list[tuple[str, str]]:
    """The entities of one mention whose surrogates must stay distinct: a
    name's words each, nothing for a date (a shift keeps dates distinct)."""
    if kind == "name":
        return [(kind, w) for w in value.split(" ")]
    return [] if kind == "date" else [(kind, value)]


def normal(kind: str, value: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "email":
        return value.lower()
    return unicodedata.normalize("NFC", value) if kind == "name" else value


def _date(value: str) -> tuple[datetime.date, tuple[int, int, int]] | None:
    """A written date and the places of its year, month and day; where the
    second number can't be a month it is the day."""
    parts = [int(x) for x in re.split(r"[./\-]", value)]
    for order in ((0, 1, 2),) if parts[0] > 31 else ((2, 1, 0), (2, 0, 1)):
        try:
            return datetime.date(*(parts[i] for i in order)), order
        except ValueError:
            continue
    return None


def _moved(value: str, key: bytes) -> str:
    """The date a keyed number of days earlier, written alike."""
    found = _date(value)
    if found is None:
        return value
    day, order = found
    back = 200 + Stream(key, "date").below(700)
    new = datetime.date.fromordinal(max(1, day.toordinal() - back))
    parts, signs = re.split(r"[./\-]", value), re.findall(r"[./\-]", value)
    for place, number in zip(order, (new.year, new.month, new.day)):
        parts[place] = str(number).zfill(len(parts[place]))
    return parts[0] + signs[0] + parts[1] + signs[1] + parts[2]


class Stream:
    """Keyed numbers below any bound."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
        self.key, self.block, self.left = key, 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _range(c: str) -> tuple[int, int]:
    """First letter and number of letters of c's script and case."""
    for first, last in (("a", "z"), ("A", "Z"), ("α", "ω"), ("Α", "Ω"), ("а", "я"), ("А", "Я"), ("ぁ", "ん"), ("ァ", "ン"),
                        ("一", "龠"), ("가", "힣"), ("ا", "ي"), ("א", "ת")):
        if first <= c <= last:
            return ord(first), ord(last) - ord(first) + 1
    return (ord("A") if c.isupper() else ord("a")), 26


def _shuffled(value: str, s: Stream, hexadecimal: bool = False) -> str:
    out = []
    for c in value:
        if "0" <= c <= "9":
            out.append(str(s.below(10)))
        elif hexadecimal and c in "abcdefABCDEF":
            out.append(chr(ord("a" if c.islower() else "A") + s.below(6)))
        elif c.isalpha():
            first, n = _range(c)
            letter = chr(first + s.below(n))
            out.append(letter if letter.isalpha() else chr(first))
        else:
            out.append(c)
    return "".join(out)


_SOUNDS = {"latin": ("aeiou", "bdfgklmnprstvz", "nrsdl"), "greek": ("αειο", "βγδκλμνπρστ", "ςνρ"),
           "cyrillic": ("аеиоу", "бвгдзклмнпрст", "нрсмв")}


def _name(word: str, s: Stream, more: int) -> str:
    c = word[0]
    vowels, inner, ends = _SOUNDS["greek" if "Ͱ" <= c <= "Ͽ" else "cyrillic" if "Ѐ" <= c <= "ӿ" else "latin"]
    size = max(3, len(word)) + more
    letters = [(inner if i % 2 == 0 else vowels)[s.below(len(inner if i % 2 == 0 else vowels))] for i in range(size)]
    last = unicodedata.normalize("NFD", word[-1])[0].lower()
    letters[-1] = vowels[0] if last in _VOWELS else ends[s.below(len(ends))]
    return "".join(letters).capitalize()


_VOWELS = "aeiouαειοηυωаеиоуяюыэ"


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """Normal form of the entity's replacement."""
    s = Stream(key, kind, value, attempt)
    more = max(0, attempt - WIDEN + 1)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        d = Stream(key, "domain", domain, 0)                 # one domain stays one domain
        return "@".join([_shuffled(local, s) + "".join(str(s.below(10)) for _ in range(more)),
                         ".".join([_shuffled(x, d) for x in labels[:-1]] + labels[-1:])])
    extra = "".join(str(s.below(10)) for _ in range(more))       # a full space grows
    if kind == "ip":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "card":
        digits = value[0] + _shuffled(value[1:], s)
        digits = digits[:-1] + extra + digits[-1]
        return digits[:-1] + _luhn(digits[:-1]) if _luhn(value[:-1]) == value[-1] else digits
    if kind == "phone" and value.startswith("0"):
        return "0" + _shuffled(value[1:], s) + extra
    if kind == "phone":
        body = value[-7:]
        fixed = "555" if body.startswith("555") and attempt < WIDEN else None
        head = value[:-10] + (str(2 + s.below(8)) + _shuffled(value[-9:-7], s) if len(value) >= 10 else _shuffled(value[:-7][len(value[:-10]):], s))
        return head + (fixed + _shuffled(body[3:], s) if fixed else _shuffled(body, s)) + extra
    if kind == "iban":
        rest = _shuffled(value[4:], s) + extra
        number = "".join(str(int(c, 36)) for c in rest + value[:2] + "00")
        return f"{value[:2]}{98 - int(number) % 97:02d}{rest}"
    if kind == "name":
        return _name(value, s, more)
    if kind == "secret":
        prefix = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|eyJ|", value)[0]
        rest = value[len(prefix):]
        return prefix + _shuffled(rest, s, hexadecimal=re.fullmatch("[0-9a-fA-F]+", rest) is not None) + extra
    return _shuffled(value, s) + extra


def _luhn(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def rendered(kind: str, mention: str, new: str) -> str:
    """The replacement in the mention's own format."""
    if kind in ("phone", "card", "ssn", "iban"):
        slots = [i for i, c in enumerate(mention) if c.isalnum()]
        out = list(mention)
        spare = len(new) - len(slots)
        for i, c in zip(slots, new[max(0, spare):]):
            out[i] = c
        return new[:max(0, spare)] + "".join(out)
    if kind == "email" and mention.isupper():
        return new.upper()
    return new


def replace(text: str | None, key: bytes, attempts: dict[tuple[str, str], int]):
    """(new text, [(from, to, kind) in the new text])."""
    found = detect(text)
    if not found:
        return text, []
    parts, spans, at, size = [], [], 0, 0
    for a, b, kind, value in found:
        if kind == "date":
            new = _moved(text[a:b], key)
        else:
            drawn = [surrogate(k, v, attempts.get((k, v), 0), key) for k, v in units(kind, value)]
            new = rendered(kind, text[a:b], " ".join(drawn))
        parts += [text[at:a], new]
        size += a - at
        spans.append((size, size + len(new), kind))
        size += len(new)
        at = b
    return "".join([*parts, text[at:]]), spans


_ENTITY = "kind string, value string"


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (kind, value) of the corpus; each task sends an entity once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            seen = set()
            for a, b in batch_slices(batch.column(0), SLICE_BYTES):
                seen |= {u for t in batch.column(0).slice(a, b - a).to_pylist() for _, _, k, v in detect(t) for u in units(k, v)}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([v for _, v in seen], pa.string())],
                                             names=["kind", "value"])
    return docs.select(F.col(f"`{text}`")).mapInArrow(run, _ENTITY).distinct()


def session_key(spark: SparkSession) -> bytes:
    """The key that the setting ``spark.shelfwise.pii.key`` names; without it a
    random one, the same for the whole application."""
    said = spark.conf.get(KEY_SETTING, None)
    if not said:
        said = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, said)
    return said.encode()


def resolve(known: DataFrame, key: bytes, make=surrogate, most: int = MOST) -> DataFrame:
    """(kind, value, attempt, new) with ``new`` distinct a kind and no entity's own value."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, value, attempt = (batch.column(i).to_pylist() for i in range(3))
            new = [make(k, v, a, key) for k, v, a in zip(kind, value, attempt)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.string())],
                                             names=["kind", "value", "attempt", "new"])
    drawn = _ENTITY + ", attempt int, new string"
    open_ = known.withColumn("attempt", F.lit(0))
    settled = None
    while True:
        tried = stage_table(open_.mapInArrow(draw, drawn), "surrogates")
        real = known.select("kind", F.col("value").alias("new"), F.lit(True).alias("taken")).distinct()
        bad = tried.join(real, ["kind", "new"], "left")
        if settled is not None:
            bad = bad.join(settled.select("kind", "new", F.lit(True).alias("used")), ["kind", "new"], "left")
        else:
            bad = bad.withColumn("used", F.lit(None).cast("boolean"))
        first = tried.groupBy("kind", "new").agg(F.min("value").alias("winner"))
        judged = stage_table(bad.join(first, ["kind", "new"]).select(
            "kind", "value", "attempt", "new",
            (F.col("taken").isNull() & F.col("used").isNull() & (F.col("value") == F.col("winner"))).alias("good")), "surrogates")
        good = judged.filter("good").drop("good")
        settled = good if settled is None else settled.unionByName(good)
        again = judged.filter("NOT good")
        if again.isEmpty():
            return settled
        most -= 1
        if most == 0:
            full = [r.kind for r in again.select("kind").distinct().collect()]           # a handful of kinds
            raise ValueError(f"no free surrogates are left for {', '.join(sorted(full))}")
        open_ = again.select("kind", "value", (F.col("attempt") + 1).alias("attempt"))


REPLACED = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("from", T.LongType()), T.StructField("to", T.LongType()), T.StructField("kind", T.StringType())])))])


def anonymise(docs: DataFrame, text: str = "text", key: bytes | None = None, send: int = SEND, make=surrogate) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: the text with surrogates, and their
    spans and kinds; and that column's name. ``key``: see ``session_key``."""
    spark = docs.sparkSession
    key = key or session_key(spark)
    known = stage_table(entities(docs, text), "entities")
    later = resolve(known, key, make).filter("attempt > 0").select("kind", "value", "attempt")
    few = later.limit(send + 1).collect()
    if len(few) <= send:
        sent = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in few})   # at most ``send``
        return add_struct(docs, "surrogates", REPLACED, text, lambda: _column(key, lambda n: sent.value))
    # more: each distinct text's own exceptions are joined to it
    digest, extra = fresh_name(docs, "text_digest"), fresh_name(docs, "text_exceptions")
    own = docs.withColumn(digest, F.sha2(F.col(f"`{text}`"), 256))

    def mentions(batches):
        for batch in batches:
            rows = [(d, k, v) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k, v in {u for _, _, k, v in detect(t) for u in units(k, v)}]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)],
                                             names=["d", "kind", "value"])
    found = own.select(digest, F.col(f"`{text}`")).mapInArrow(mentions, "d string, " + _ENTITY).distinct()
    found = found.join(apart(later, "value"), ["kind", "value"]).groupBy("d").agg(
        F.collect_list(F.struct("kind", "value", "attempt")).alias(extra))       # a text's own entities
    other = fresh_name(own, "other_digest")
    joined = own.join(apart(found.withColumnRenamed("d", other), other), F.col(digest) == F.col(other), "left").drop(other)
    at = joined.columns.index(extra)

    def make_column():
        return _column(key, None)
    name = fresh_name(joined, "surrogates")
    place = joined.columns.index(text)

    def run(batches):
        compute = make_column()
        for batch in batches:
            lists = [{(e["kind"], e["value"]): e["attempt"] for e in x or ()} for x in batch.column(at).to_pylist()]
            out = compute(batch.column(place).to_pylist(), lists)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, name])
    out = joined.mapInArrow(run, T.StructType([*joined.schema.fields, T.StructField(name, REPLACED)]))
    return out.drop(digest, extra), name


def _column(key: bytes, common):
    def column(texts, lists=None):
        done = [replace(t, key, lists[i] if lists is not None else common(i)) for i, t in enumerate(texts)]
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("kind", pa.string())]))
        return pa.StructArray.from_arrays(
            [pa.array([d[0] for d in done], pa.string()),
             pa.array([[{"from": a, "to": b, "kind": k} for a, b, k in d[1]] for d in done], kind)], names=["text", "spans"])
    return column


def replace_pii(docs: DataFrame, text: str = "text", key: bytes | None = None) -> DataFrame:
    """``docs`` with the text replaced, columns as given."""
    out, c = anonymise(docs, text, key)
    return out.withColumn(text, F.col(f"{c}.text")).drop(c)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document's text with surrogates, and how many it got."""
    out, c = anonymise(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(f"{c}.text").alias("text"), F.coalesce(F.size(f"{c}.spans"), F.lit(0)).alias("n_entities"))
