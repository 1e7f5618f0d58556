import json
import math
import re

import numpy as np
from pyspark.sql import functions as F

from regiocast.plans import questions as qs
from regiocast.plans import retrieval as rt
from regiocast.plans import search_index as si

CATS = [qs.Category("trend", "total_sales", ("trend", "change")),
        qs.Category("comparison", "total_sales", ("compare", "change"), needs_region=False)]


def test_routing_and_scope(spark):
    asked = spark.createDataFrame(
        [(1, "Trend of SEOUL_1, please"), (2, "Compare: change!"), (3, "change?"), (4, "hello")],
        "id int, text string")
    routed = qs.route(asked, "text", CATS)
    assert {r["id"]: (r["category"], r["hits"]) for r in routed.collect()} == {
        1: ("trend", 1), 2: ("comparison", 2), 3: ("trend", 1), 4: ("none", 0)}
    regions = spark.createDataFrame([("Seoul_1",), ("Other",)], "region string")
    rows = qs.scope_rule(routed, "text", regions, ["id"], CATS).collect()
    assert {r["id"]: (r["names_region"], r["needs_clarification"]) for r in rows} == {
        1: (True, False), 2: (False, False), 3: (False, True), 4: (False, True)}


def test_answers(spark):
    good = {"answer": "do", "recommended_region": "A", "allocation_pct": 12.5,
            "drivers": ["x", "y"], "risk": "r", "next_action": "n"}
    raw = spark.createDataFrame(
        [(1, json.dumps(good)), (2, f"Sure: {json.dumps(good)} bye"), (3, " plain "),
         (4, "broken {not json} text"), (5, "")], "id int, raw string")
    rows = {r["id"]: r for r in qs.parse_answers(raw, "raw").collect()}
    for i in (1, 2):
        assert (rows[i]["parsed"], rows[i]["answer"], rows[i]["recommended_region"],
                rows[i]["allocation_pct"], rows[i]["drivers"]) == (
                    True, "do", "A", 12.5, ["x", "y"])
    assert (rows[3]["parsed"], rows[3]["answer"], rows[3]["recommended_region"]) == (
        False, "plain", "-")
    assert rows[4]["answer"] == "broken {not json} text" and rows[4]["drivers"] == []
    assert rows[5]["answer"] == "" and not rows[5]["parsed"]


def bm25(docs, terms):
    words = {d: re.findall(r"[^\W\d_]+", t.lower()) for d, t, *_ in docs}
    avg = sum(map(len, words.values())) / len(words)
    out = {}
    for d, w in words.items():
        s = 0.0
        for t in terms:
            df = sum(t in x for x in words.values())
            tf = w.count(t)
            if tf:
                s += math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(w) / avg))
        if s:
            out[d] = s
    return out


def test_keyword_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(rt, "SEARCH_BLOCK", 1)  # every query in a pass of its own
    rng = np.random.default_rng(5)
    vocab = ["rental", "moving", "policy", "budget", "été", "für"]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(1, 30))), ["en", "de"][i % 2], f"s{i % 3}")
            for i in range(60)]
    docs += [(60 + i, "rental policy rental", "en", "s9") for i in range(30)]  # copies
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    queries = [rt.SearchQuery("a", "rental policy"), rt.SearchQuery("b", "été für", {"lang": "de"})]
    rows = rt.keyword_search(df.repartition(5), queries, 7).collect()
    lang = {d[0]: d[2] for d in docs}
    for q in queries:
        want = {d: s for d, s in bm25(docs, q.terms).items()
                if q.query_id == "a" or lang[d] == "de"}
        best = sorted(want, key=lambda d: (-round(want[d], 7), d))[:7]
        got = sorted((r["rank"], r["doc_id"]) for r in rows if r["query_id"] == q.query_id)
        assert [d for _, d in got] == best
    cited = rt.citations(df, queries, 2, chars=6).collect()
    assert all(len(r["citations"]) == 2 and len(r["citations"][0]["snippet"]) <= 6 for r in cited)


def test_vector_search_blocks_give_the_same_result(spark, monkeypatch):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(200, 8))
    v[50:120] = v[50]  # a group of copies
    items = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)],
                                  "id long, vec array<double>").repartition(6)
    q = rng.normal(size=(5, 8))
    queries = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(q)],
                                    "query_id int, vector array<double>")
    cos = np.stack([rt.cosine(v, x) for x in q], axis=1)
    want = {(j, int(i), r + 1) for j in range(5)
            for r, i in enumerate(np.lexsort((np.arange(200), -cos[:, j]))[:4])}
    odd = spark.createDataFrame([(900, None), (901, [None] * 8), (902, [1.0, 2.0]), (903, [])],
                                "id long, vec array<double>")
    items = items.unionByName(odd)
    for block, held in ((1024, 1 << 25), (2, 0)):
        monkeypatch.setattr(rt, "QUERY_BLOCK", block)
        monkeypatch.setattr(rt, "ITEM_BLOCK", 30)
        monkeypatch.setattr(rt, "BROADCAST_BYTES", held)
        rows = rt.vector_search(items, "id", "vec", queries, 4).collect()
        assert {(r["query_id"], r["id"], r["rank"]) for r in rows} == want


def test_ranks_follow_the_unrounded_cosine(spark):
    near = [[1.0, 1e-5], [1.0, 0.0], [1.0, 2e-5]]  # cosines equal to six digits
    items = spark.createDataFrame(list(enumerate(near)), "id long, vec array<double>")
    query = spark.createDataFrame([(7, [1.0, 0.0])], "query_id int, vector array<double>")
    rows = rt.vector_search(items, "id", "vec", query, 3).orderBy("rank").collect()
    assert [r["id"] for r in rows] == [1, 0, 2]


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.5, 0.5])],
                               "label int, e array<float>")
    assert {r["query_id"]: r["vector"] for r in rt.centroids(df, "label", "e").collect()} == {
        1: [2.0, 3.0], 2: [0.5, 0.5]}


def test_search_filters_before_any_shuffle(spark, tables):
    top = rt.keyword_search(tables.documents, [rt.SearchQuery("q", "the of")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.count() == 3


def test_region_of_several_words(spark):
    asked = spark.createDataFrame([(1, "Trend of New  York?"), (2, "trend of York"), (3, "")],
                                  "id int, text string")
    regions = spark.createDataFrame([("New York",), ("Other",)], "region string")
    rows = qs.scope_rule(qs.route(asked, "text", CATS), "text", regions, ["id"], CATS).collect()
    assert {r["id"]: r["names_region"] for r in rows} == {1: True, 2: False, 3: False}
    none = qs.scope_rule(qs.route(asked, "text", CATS), "text", regions.limit(0), ["id"], CATS)
    assert not any(r["names_region"] for r in none.collect())


def test_queries_are_cut_like_documents(spark):
    docs = spark.createDataFrame([(1, "License terms apply", "s"), (2, "nothing", "s")],
                                 "doc_id bigint, text string, source string")
    found = rt.keyword_search(docs, [rt.SearchQuery("q", "license, terms?")], 5).collect()
    assert [(r["query_id"], r["doc_id"]) for r in found] == [("q", 1)]
    for queries in ([], [rt.SearchQuery("q", "")], [rt.SearchQuery("q", "?!")]):
        empty = rt.keyword_search(docs, queries, 5)
        assert empty.columns == ["query_id", "doc_id", "score", "rank"] and empty.isEmpty()
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id int, v array<double>")
    none = spark.createDataFrame([], "query_id int, vector array<double>")
    assert rt.vector_search(vectors, "vec_id", "v", none, 3).isEmpty()


def test_longest_phrase_wins_and_is_used_up(spark):
    cats = [qs.Category("sales", "s", ("spending", "card sales")),
            qs.Category("head", "h", ("spending per head", "per head"))]
    asked = spark.createDataFrame(
        [(1, "Spending per  head?"), (2, "spending, spending per heads"), (3, "card-sales"),
         (4, "spendings"), (5, None), (6, ""), (7, "per head per head spending")],
        "id int, text string")
    rows = {r["id"]: (r["category"], r["hits"], r["phrases"])
            for r in qs.route_phrases(asked, "text", cats).collect()}
    assert rows == {1: ("head", 1, ["spending per head"]),
                    2: ("sales", 2, ["spending", "spending"]), 3: ("sales", 1, ["card sales"]),
                    4: ("none", 0, []), 5: ("none", 0, []), 6: ("none", 0, []),
                    7: ("head", 2, ["per head", "per head", "spending"])}


def test_stored_index_equals_the_full_pass(spark, tmp_path):
    rng = np.random.default_rng(8)
    vocab = ["rental", "moving", "policy", "budget", "été", "für"]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(0, 40))), ["en", "de"][i % 2], f"s{i % 3}")
            for i in range(300)]
    docs += [(7, "rental policy", "en", "s9"), (None, "rental", "en", None), (400, None, "de", "s1"),
             (401, "", None, "s1"), (402, "rental " * 5000, "de", "s0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    df = df.repartition(5)
    queries = [rt.SearchQuery("a", "rental policy"), rt.SearchQuery("none", "?"),
               rt.SearchQuery("b", "été für absent", {"lang": "de", "source": "s1"})]
    index = si.build_index(df, str(tmp_path / "index"), buckets=8)
    assert si.open_index(spark, index.path) == index
    got = si.search_index(spark, index, queries, 9)
    columns = ["query_id", "doc_id", "score", "rank"]
    want = rt.keyword_search(df, queries, 9).select(columns).collect()
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want))
    assert si.search_index(spark, index, [queries[1]], 3).isEmpty()
    read = si.lists_of(spark, index, ["rental"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert "EqualTo(term,rental)" in plan
    assert {r["term"] for r in read.select("term").distinct().collect()} == {"rental"}
    empty = si.build_index(df.limit(0), str(tmp_path / "empty"))
    assert si.search_index(spark, empty, queries, 3).isEmpty()


def test_index_looks_at_each_text_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = [(i, f"word{'xyz'[i % 3]} and 1, und-été ", "en", "s") for i in range(40)] + [
        (40, None, "en", "s"), (41, " 12 ", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    index = si.build_index(docs.withColumn("text", counted("text")), str(tmp_path / "once"))
    assert seen.value == len(rows)
    assert index.stats(spark).select("n", "dl").first() == (42, 160)
    empty = si.build_index(docs.limit(0), str(tmp_path / "empty"))
    assert empty.stats(spark).select("n", "dl").first() == (0, None)
