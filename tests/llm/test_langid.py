"""Held-out accuracy and edge cases of language identification."""

import zlib
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.langid import Model, features, fit_machine, identify, predict, train
from tidemark.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op7_language"](spark, sf_dir).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture
def small(spark):
    rows = [(i, text, lang, "x", float(i)) for i, (text, lang) in enumerate(
        [("the thing is of the house", "en"), ("das Haus ist der Ort und", "de"),
         ("la casa es de los niños", "es"), ("la maison est dans le pré", "fr")] * 12)]
    rows += [(100, None, "en", "x", 0.), (101, "", "en", "x", 0.), (102, "12 34 !?", "de", "x", 0.),
             (None, "das Haus", None, None, 0.), (103, "the house " * 200_000, None, "y", 0.),
             (104, "the house", "en", "x", 0.), (104, "the house", "en", "x", 0.)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, lang_pred string, "
                                       "score double")


def test_edge_cases(small):
    got = {}
    for r in identify(small).collect():
        got.setdefault(r["doc_id"], []).append((r["held_out"], r["lang_pred"], r["score"]))
    assert all(got[i][0][1:] == ("und", 0.0) for i in (100, 101, 102))
    assert got[None][0][:2] == (False, "de") and got[103][0][1] == "en" and len(got[104]) == 2
    assert identify(small.limit(0)).count() == 0


def test_labels_do_not_reach_predictions(small):
    model = train(small)
    assert [sorted(x) for x in model.families.values()] and set(model.families) == {
        "germanic", "romance"}
    swapped = small.selectExpr("doc_id", "text", "'zz' lang")
    a = sorted(map(str, predict(small, model).collect()))
    assert a == sorted(map(str, predict(swapped, model).collect()))


def test_nothing_to_learn_from(spark, small):
    empty = train(small.filter("lang = 'none'"))
    assert {r["lang_pred"] for r in predict(small, empty).collect()} == {"und"}
    one = train(small.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in predict(small, one).collect()} == {"und", "en"}
    assert Model({}, [], {}).between == []


def test_machine_separates_and_features_are_unit_vectors():
    x = features(["aaa bbb", "aaa bbc", "zzz yyy", "zzz yyx", ""])
    assert np.allclose(np.linalg.norm(x[:4], axis=1), 1) and not x[4].any()
    w, bias, slope = fit_machine(x[:4], np.array([1., 1, -1, -1]))
    assert ((x[:2] @ w + bias) > 0).all() and ((x[2:4] @ w + bias) < 0).all() and slope > 0


def test_every_language_is_learned(spark, monkeypatch):
    """70 languages in ten families, one more for each ten rarer than those before."""
    langs = [f"l{i:02d}" for i in range(70)]
    monkeypatch.setattr(langid, "_FAMILY_OF", {c: f"family{i % 10}" for i, c in enumerate(langs)})
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4)]
             for _ in langs]
    rows = [(100 * i + k, " ".join(rng.permutation(words[i] * 3)), lang)
            for i, lang in enumerate(langs) for k in range(10 - i // 10)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = train(docs)
    assert sorted(x for members in model.families.values() for x in members) == langs
    assert sorted(m[:2] for m in model.between) == sorted(combinations(sorted(model.families), 2))
    assert sum(map(len, model.within.values())) == 10 * 21
    got = predict(docs.filter("lang >= 'l60'").repartition(1), model, ("lang",)).collect()
    assert all(r["lang"] == r["lang_pred"] for r in got) and len(got) == 40
