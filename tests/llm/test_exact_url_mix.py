"""Exact copies, URL verdicts and the source mix against plain Python."""

import hashlib
import math
import re
from collections import defaultdict

import pytest

from zerotally.llm import exact_dedup, mixing, url_filter
from zerotally.workspace import materialise
from zerotally.llm.queries import URL_RULES

DOCS = "doc_id long, text string, source string, digest string, run string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text {i % 7}", "a", "x", "y") for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "b", None, None), (102, "z" * 300_000, "b", None, None),
             (None, "text 1", "a", None, None), (None, "alone", None, None, None), (3, "text 3", "a", "x", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(9)


@pytest.mark.parametrize("keep,fan_in", [("largest", 8), ("smallest", 2)])
def test_exact_groups_match_plain_grouping(docs, keep, fan_in):
    pick = max if keep == "largest" else min
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        stays = pick([i for i in ids if i is not None], default=None)
        want += [(i, stays, len(ids), i == stays, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = exact_dedup.exact_groups(docs, keep=keep, fan_in=fan_in).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_digests_with_other_checks_stop_the_job(spark):
    rows = [(1, bytearray(b"d" * 32), 5, 1, 0), (2, bytearray(b"d" * 32), 6, 1, 1)]
    digests = spark.createDataFrame(rows, "doc_id long, digest binary, n_bytes long, check long, run int")
    with pytest.raises(Exception, match="equal digests differ"):
        exact_dedup.merge_runs(digests).collect()


URLS = ["http://Example.COM/en/a?x#y", "https://www.example.com/en/", "http://a.net/es/1", "http://net/es/", "http://a.net/es",
        "http://a.example.com", "http://xexample.com/en/", None, "", "no scheme/com/", "ftp://b.org/a://c.com/en/", "http://c.org#com/",
        "http://d.com?/", "http://ünï.com/é", "http://www.example.com/en/x/" + "y" * 60_000]


def _judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = (None, None)
    for verdict, rule in URL_RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and len(rule) > len(best[1] or ""):
            best = (verdict, rule)
    return host, path, best[1], best[0]


def test_urls_are_split_and_judged_by_the_longest_rule(spark):
    pages = spark.createDataFrame([(i, u, "h", 0.5) for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, p_block double")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert len(got) == 2 * len(URLS)
    for i, r in got.items():
        host, path, rule, verdict = _judged(URLS[i % len(URLS)])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
        assert 0 <= r["p_block"] <= 1


def test_model_learns_from_a_labelled_table(spark):
    labelled = spark.createDataFrame([(f"good{i}.org", "/news", "allow") for i in range(40)] + [(f"casino{i}.biz", "/win", "block") for i in range(40)],
                                     "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://good99.org/news"), (2, "http://casino77.biz/win")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, [], labelled=labelled).collect()}
    assert got == {1: "allow", 2: "block"}


def test_urls_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://x.y/z")], "page_id long, url string")
    assert url_filter.judge_urls(pages, []).first()["verdict"] == "allow"
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


def _targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        rate = left / sum(w[s] for s in open_)
        full = {s for s in open_ if rate * w[s] > cap * sizes[s]}
        if not full:
            return target | {s: rate * w[s] for s in open_}
        target |= {s: float(cap * sizes[s]) for s in full}
        left, open_ = left - sum(target[s] for s in full), open_ - full
    return target


def _mix_rows(spark):
    rows = [(i, "w " * (i * 37 % 400) + "x", f"s{i % 5}") for i in range(300)]
    rows += [(1000, None, None), (1001, "", "s1"), (1002, " \t\n", "é"), (1003, "one two three", None), (1004, "q " * 60_000, "big"), (7, "w x", "s2"), (7, "w x", "s2")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size long, taken long").repartition(5)


def test_mix_meets_its_targets(spark):
    docs = _mix_rows(spark)
    got = mixing.mix(docs, shard_docs=20).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += size(r["text"])
    want = _targets(dict(sizes))
    by_id = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken = defaultdict(int)
    for r in got:
        s = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 32 * (3 + 300 // 5 / 20)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(3), shard_docs=20).collect()))


def test_mixed_documents_hold_the_words_that_are_taken(spark):
    docs = _mix_rows(spark).select("doc_id", "text", "source")
    columns = ["doc_id", "text", "source"]
    made = mixing.mixed_documents(docs, shard_docs=20)
    assert made.columns == columns
    words = defaultdict(int)
    for r in made.collect():
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    want = defaultdict(int)
    for r in mixing.mix(docs, shard_docs=20).collect():
        want[r["doc_id"]] += r["taken"]
    assert dict(words) == {k: v for k, v in want.items() if v}
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id < 300 and doc_id <> 7").collect()}
    for r in made.where("doc_id < 300 and doc_id <> 7").collect():
        assert len(r["text"]) <= len(texts[r["doc_id"]])


def test_mix_of_nothing_and_of_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix(none).collect()] == [(0, 0, 0.0)] * 2


@pytest.mark.parametrize("votes,seats", [([53, 24, 23], 7), ([1, 1, 1, 1000], 5), ([10, 0, 3], 1), ([7, 7, 7], 2), ([5], 0), ([340, 280, 160, 60], 4)])
def test_apportionment_is_by_highest_quotients(spark, votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, item int, vote double, seats long")
    got = {r["item"]: r["won"] for r in mixing.apportion(df, ["g"], "item", "vote", "seats").collect()}
    assert got == dict(enumerate(won))

def test_mix_spreads_rows_of_one_id(spark):
    """An id on most rows, and null on others: shards stay small, and the places do not depend on how the rows lie."""
    rows = [(5, "w " * (i % 3) + "x", "a") for i in range(600)] + [(None, "w " * i, "a") for i in range(100)] + [(5, "x", "b"), (5, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tables = [materialise(mixing.word_sizes(docs.repartition(n)), "sizes") for n in (1, 4)]
    keys = [sorted(r["key"] for r in mixing.seeded_keys(t).collect()) for t in tables]
    assert keys[0] == keys[1] and len(set(keys[0])) == len(rows)
    plan = mixing.plan_mix(tables[1], shard_docs=50).where("source = 'a'")
    sizes = [r["count"] for r in plan.groupBy("shard").count().collect()]
    assert len(sizes) == 14 and max(sizes) < 100
    taken = [sorted(map(repr, mixing.mix(docs.repartition(n), shard_docs=50).collect())) for n in (1, 4)]
    assert taken[0] == taken[1] and len(taken[0]) == len(rows)
    words = lambda df: df.selectExpr("sum(regexp_count(text, '[^ ]+'))").first()[0]
    assert words(mixing.mixed_documents(docs, shard_docs=50)) == mixing.mix(docs, shard_docs=50).selectExpr("sum(taken)").first()[0]
