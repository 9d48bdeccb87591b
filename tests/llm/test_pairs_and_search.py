"""URL filters, decontamination, neighbours: small fixtures against plain answers."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, neighbours, urls

SF = "/root/testdata/sf0.001"


def plain_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


def test_urls_against_plain_rules(spark):
    rules = [*urls.RULES, ("a.example.net", "/en/x", "block"), ("com", "", "block"), ("b.com", "/", "allow"), ("b.com", "/", "block")]
    given = [None, "", "no scheme", "http://", "https://EXAMPLE.net/en/", "https://x.example.net/en/a?b#c", "http://net", "http://net/",
             "http://anet/", "http://a.net?q=/en/", "http://a.example.net/en/x1", "http://a.example.net/en/y", "ftp://b.com/z", "http://b.com",
             "http://é.org/fr/ü", "http://org/FR/", "http://org/fr", "x://y://net/", "http://a.net/\nfr", "http://" + "s." * 300 + "net/" + "p" * 5000] * 2
    pages = spark.createDataFrame([(i if i % 5 else None, u, "x", "y") for i, u in enumerate(given)],
                                  "page_id bigint, url string, host string, Rule string")
    out = urls.judge(pages, urls.rules_frame(spark, rules))
    assert out.columns == ["page_id", "url", "host", "Rule", "_host", "path", "_rule", "verdict"]
    got = sorted((r["url"] or "~", r["_host"], r["path"], r["_rule"] or "~", r["verdict"]) for r in out.collect())
    want = sorted((u or "~", h, p, r or "~", v) for u in given for h, p, r, v in [plain_verdict(u, rules)])
    assert got == want


def test_urls_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judge(pages, urls.rules_frame(spark, urls.RULES)).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert urls.judge(one, urls.rules_frame(spark, urls.RULES).limit(0)).first()["verdict"] == "allow"


def test_urls_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.execute(f"SELECT page_id, host, path, coalesce(rule, ''), verdict FROM ({urls.SQL})").fetchall())
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in urls.query(spark, SF).collect())
    assert got == want


ITEMS = [(1, " ".join(f"w{i}" for i in range(20))), (2, "One two"), (3, None), (4, "!!"), (None, "solo é"), (1, "other item text here"),
         (5, "a b " * 9), (6, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 zz")]
TEXTS = [None, "", "--", "x " + " ".join(f"W{i}" for i in range(4, 18)) + " y", "one, TWO! one", "SOLO é", "a b " * 20, "ab " * 20,
         " ".join(f"w{i}" for i in range(12)), "q " * 60000 + "one two", "other-item_text,here", "one", "solo É"]


@pytest.mark.parametrize("batch", [500_000, 3])
def test_decontamination_against_brute_force(spark, batch):
    docs = spark.createDataFrame([(i if i % 4 else None, t, 7) for i, t in enumerate(TEXTS * 2)], "doc_id bigint, text string, Benchmark_Match int")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found, m = decontaminate.search(docs, bench, batch_windows=batch)
    assert m == "_benchmark_match" and found.columns == [*docs.columns, m]
    rows = found.select("text", F.col(f"{m}.n_words"), decontaminate.n_hit(m), F.size(F.col(f"{m}.items")).cast("bigint"),
                        F.sha2(F.concat_ws(",", F.col(f"{m}.items")), 256), decontaminate.contaminated(m)).collect()
    want = dict(zip(TEXTS, decontaminate.brute_force(TEXTS, ITEMS)))
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        assert tuple(r)[1:] == want[r.text], r.text
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == 2 * sum(not w[-1] for w in want.values())


def test_decontamination_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.remove_contaminated(docs, bench).count() == 0
    assert decontaminate.remove_contaminated(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), bench).count() == 1


def test_neighbours_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = neighbours.search(table.select("vec_id", "embedding"), F.col("vec_id") % 10 == 0).collect()
    rows = table.select("vec_id", "embedding").collect()
    want = neighbours.brute_force([r[0] for r in rows], [r[1] for r in rows], [r[0] for r in rows if r[0] % 10 == 0])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert found.keys() == want.keys()
    hits = sum(len({v for _, v, _ in found[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    at = {r[0]: np.array(r[1], dtype=float) for r in rows}
    for q, near in found.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, len(near) + 1))
        assert [n[1:] for n in near] == sorted((n[1:] for n in near), key=lambda n: (n[1], n[0]))
        for _, v, score in near:
            assert score == pytest.approx(float(np.sqrt(((at[q] - at[v]) ** 2).sum())), rel=1e-12)


def test_neighbours_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 8)
    same = [(100 + i, [1.0, 1.0]) for i in range(40)]                # one vector very often
    odd = [(0, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [1.0]),
           (None, [1.0, 2.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0])]
    table = spark.createDataFrame([(*r, "x") for r in odd + same], "vec_id bigint, embedding array<double>, part string")
    got = neighbours.search(table, F.col("vec_id").isin(0, 1, 2, 3, 4, 5, 6), recall=1.0).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 100 + i, 0.0) for i in range(10)]
    got = neighbours.search(table, F.col("vec_id") == 7, recall=1.0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got][:2] == [(0, 2.0), (100, 2.0)] and len(got) == 10
    few = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id bigint, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in neighbours.search(few, F.col("vec_id") == 1).collect()] == [(1, 2)]
    assert neighbours.search(few.limit(0), F.col("vec_id") == 1).count() == 0


def test_neighbour_queries_are_dealt_into_bounded_chunks(spark):
    rows = [(i, [float(i)], [i % 2, 1 - i % 2] if i % 5 else [i % 2]) for i in range(400)]
    routed = spark.createDataFrame(rows, "vec_id bigint, v array<double>, parts array<int>")
    asked, members = neighbours.dealt(routed, F.col("vec_id") >= 0, size=50)
    place = ["part", "chunk", "query_chunk"]
    for side in (asked, members):
        assert max(r["count"] for r in side.groupBy(*place).count().collect()) <= 100
    met = [(r.query_id, r.vec_id) for r in asked.join(members, place).select("query_id", "vec_id").collect()]
    want = {(q, m) for q, _, parts in rows for m, _, own in rows if own[0] in parts}
    assert len(met) == len(want) and set(met) == want              # each pair once


def test_neighbours_of_small_partitions_are_k(spark):
    rng = np.random.default_rng(2)
    points = [(c * 50.0 * np.eye(4)[c % 4] + rng.normal(size=4)).tolist() for c in range(1, 5) for _ in range(6)]
    rows = list(enumerate(points)) + [(0, points[0])] * 12 + [(100 + i, [9.0, 9.0, 9.0, 9.0]) for i in range(1000)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.search(table, F.col("vec_id") < 24, recall=0.01).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {i: 10 for i in range(24)}      # one partition holds about six


def test_clustered_vectors_need_few_partitions(spark):
    """On vectors with structure few partitions are probed, and queries outside the sample still find their neighbours."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(40, 16)) * 4
    points = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16)) * 0.5
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(6)
    router, parts, probes = neighbours.fit_router(neighbours.usable(table, "vec_id", "embedding"), sample=1024)
    assert parts >= 8 and probes <= parts // 2
    asked = list(range(0, 6000, 50))
    got = {}
    for r in neighbours.search(table, F.col("vec_id") % 50 == 0, sample=1024).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = neighbours.brute_force([i for i, _ in rows], [p for _, p in rows], asked)
    recall = sum(len(got[q] & {v for v, _ in want[q]}) for q in asked) / (10 * len(asked))
    assert recall >= 0.9
