"""Licences, languages and quality."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zerotally.llm import compression, language_id, licence_scan, quality
from zerotally.llm.queries import QUERIES, quality_model

DOCS = "doc_id long, text string, label string, score double"


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate(texts)], DOCS)


LICENCES = [
    "Released under the MIT License.", "mit  LICENSE mit-license", "GNU General\nPublic (License) v3", "GNU General Public Domain License",
    "Licensed under CC BY-NC 4.0.", "cc\u00e9 by", "apache license " * 500, "", None, "license", "the Apache\u212a License", "x " * 100_000 + "mit license",
    "Permission is hereby granted, free of charge, to any one obtaining a copy of this software and associated documentation files",
    "Redistribution and use in source and binary forms, with or without changes, are permitted", "MIT License and GNU General Public License",
]
BASE = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def test_base_phrases_are_found_at_all_places(spark):
    got = {r["doc_id"]: r for r in licence_scan.scan_licences(_frame(spark, LICENCES * 2)).collect()}
    assert len(got) == 2 * len(LICENCES)
    for i, r in got.items():
        text = "".join(c.lower() if c.isascii() else c for c in LICENCES[i % len(LICENCES)] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [(j, label) for phrase, label in BASE.items() for j in range(len(words)) if tuple(words[j:j + len(phrase)]) == phrase]
        at = [j for j, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(places)
    assert got[4]["labels"] == "cc-by,cc-by-nc"
    assert got[12]["labels"] == "mit" and 0.8 < got[12]["score"] < 1
    assert got[13]["labels"] == "bsd"


def test_mandatory_phrase_decides(spark):
    text = "permission is hereby denied free of charge to any person obtaining a copy of this software and associated documentation files"
    assert licence_scan.scan_licences(_frame(spark, [text])).first()["labels"] == ""
    assert licence_scan.scan_licences(_frame(spark, [text]).limit(0)).count() == 0


def _speech(parts, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


TONGUES = {"aa": ["the", "ing", "wh", "ou"], "bb": ["sch", "ung", "ei", "ver"], "cc": ["eau", "que", "oi", "re"]}


def test_languages_are_told_apart(spark):
    rows = [(i * 3 + j, _speech(p, 60, i), lang) for i in range(40) for j, (lang, p) in enumerate(TONGUES.items())]
    known = spark.createDataFrame(rows + [(999, None, "aa"), (998, "the ing", None)], "doc_id long, text string, lang string")
    model = language_id.train(known)
    assert set(model.names) == set(TONGUES)
    asked = [_speech(p, 50, 1000 + i) for i in range(10) for p in TONGUES.values()]
    got = {r["doc_id"]: r for r in language_id.identify(_frame(spark, asked + [None, "", "12 345 !?", _speech(TONGUES["bb"], 40_000, 5)]), model).collect()}
    assert [got[i]["lang_pred"] for i in range(30)] == list(TONGUES) * 10
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in range(30, 34)] == ["und", "und", "und", "bb"]
    assert got[30]["rejected"] and not got[33]["rejected"]


def test_no_language_is_learned_from_nothing(spark):
    model = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert language_id.identify(_frame(spark, ["word"]), model).first()["lang_pred"] == "und"
    assert language_id.identify(_frame(spark, ["word"]).limit(0), model).count() == 0


def _quality_data(spark):
    good = lambda i: _speech(TONGUES["aa"], 80, i) + "."
    bad = lambda i: " | ".join(_speech(["%$", "zz", "##"], 2, i) for _ in range(40)) if i % 2 else (_speech(["the"], 1, i) + " ") * 60
    texts = spark.createDataFrame([(i, (good if i % 3 else bad)(i)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(1, None), (5000, 1), (2, 7)], "doc_id long, quality int")
    return texts, labels, good, bad


def test_quality_is_scored_and_filtered(spark):
    texts, labels, good, bad = _quality_data(spark)
    model = quality.train(labels, texts)
    asked = [good(5001), good(5002), bad(5003), bad(5004), None, "", "the ing " * 50_000]
    got = {r["doc_id"]: r for r in quality.score_quality(_frame(spark, asked), model).collect()}
    assert [got[i]["predicted"] for i in range(4)] == [1, 1, 0, 0]
    assert got[4]["score"] == got[5]["score"] and all(0 <= r["score"] <= 1 for r in got.values())
    kept = quality.keep_good(_frame(spark, asked), model)
    assert kept.columns == ["doc_id", "text", "label", "score"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}
    assert quality.keep_good(_frame(spark, asked).limit(0), model).count() == 0


def test_quality_without_labels(spark):
    model = quality.train(spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([], "doc_id long, text string"))
    assert 0 <= quality.score_quality(_frame(spark, ["x"]), model).first()["score"] <= 1


def test_curve_matches_its_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))
    curve = quality.fit_curve(x, (rng.random(4000) < p).astype(int), np.ones(4000))
    assert np.allclose(curve, (0.5, 2, -1), atol=0.25)


def _sample(rows, **kw):
    sample, counts = compression.labelled_sample(rows, "doc_id", "text", F.col("lang"), 50, **kw)
    return sorted((r["label"], r["place"], r["text"]) for r in sample.collect()), counts


def test_sample_is_bounded_and_ignores_row_order(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "concat('t', id) as text", "if(id % 3 = 0, 'a', 'b') as lang")
    one, counts = _sample(rows)
    two, _ = _sample(rows.repartition(7))
    assert one == two and Counter(r[0] for r in one) == {"a": 50, "b": 50} and counts == {"a": 1334, "b": 2666}


@pytest.mark.parametrize("one", [41, 42])
def test_sample_of_one_id_on_all_rows_is_bounded_and_not_empty(spark, one):
    rows = spark.range(20_000).select(F.lit(one).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                      F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"))
    assert Counter(r[0] for r in _sample(rows)[0]) == {"a": 50, "b": 50}
    labels = spark.createDataFrame([(one, "a")] * 500, "doc_id long, lang string")
    got, counts = _sample(labels, texts=rows.select("doc_id", "text"))
    assert Counter(r[0] for r in got) == {"a": 50} and counts == {"a": 1}


def test_dictionary_parts_come_from_all_of_a_text(spark):
    text = "".join(f"{i:06d}" for i in range(5000))
    rows = spark.createDataFrame([(i, f"{i:03d}" + text, "a") for i in range(50)] + [(60, "short", "a")], "doc_id long, text string, lang string")
    parts = [p for _, p in compression.sampled_parts(compression.labelled_sample(rows, "doc_id", "text", F.col("lang"), 60)[0], 120)["a"]]
    assert {len(p) for p in parts} == {5, 120}
    at = sorted(text.find(p[10:100]) for p in parts if len(p) == 120)
    assert len(at) == 50 and at[0] < 6000 and at[-1] > 24_000


def test_curve_is_fitted_to_whole_texts(spark):
    """Texts that differ only far behind the beginning are told apart."""
    lead = _speech(TONGUES["cc"], 6000, 1)
    texts = [(i, lead + _speech(TONGUES["aa" if i % 2 else "bb"], 12_000, i)) for i in range(24)]
    model = quality.train(spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int"),
                          spark.createDataFrame(texts, "doc_id long, text string"))
    asked = [lead + _speech(TONGUES[t], 12_000, 100 + i) for i, t in enumerate(["aa", "bb"] * 3)]
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(_frame(spark, asked), model).collect()}
    assert min(got[i] for i in (0, 2, 4)) > max(got[i] for i in (1, 3, 5))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_registered_models_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r["doc_id"]: r for r in QUERIES["op4_language_id"](spark, folder).collect()}
    assert got.keys() == docs.keys() and {i for i, r in got.items() if r["held_out"]} == held
    known = [i for i in held if docs[i]["lang"] is not None and any(map(str.isalpha, docs[i]["text"] or ""))]
    assert sum(got[i]["lang_pred"] == docs[i]["lang"] for i in known) / len(known) > 0.97
    got = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, folder).collect()}
    assert got.keys() == docs.keys() and {i for i, r in got.items() if r["held_out"]} == held
    judged = [i for i in held if labels.get(i) in (0, 1)]
    hits = [got[i]["predicted"] == labels[i] for i in judged]
    assert len(judged) > 40 and sum(hits) / len(hits) > 0.93
    # the figures come from sizes that plain Python finds again
    model = quality_model(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    good, bad = compression.sizers([model.good, model.bad])
    for i in sorted(docs)[:40]:
        difference, rate = quality.features(good, bad, (docs[i]["text"] or "").encode())
        score = 1 / (1 + math.exp(-(model.curve[0] + model.curve[1] * difference + model.curve[2] * rate)))
        assert math.isclose(got[i]["score"], score, rel_tol=1e-9) and got[i]["predicted"] == int(score >= 0.3)
