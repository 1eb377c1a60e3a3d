"""Toxicity, line quality and word language: held-out accuracy, and defined results in odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltdrift.llm import line_quality, toxicity, word_language
from voltdrift.llm.common import read
from voltdrift.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\n\t"), (4, "12 ## --"), (5, "x" * 100_000), (None, "no id here"), (6, "the words"), (6, "the words"), (7, "\U0001f600"), (8, "a\n" * 30_000)]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(i, t, "s", 0.5) for i, t in ODD], "doc_id long, text string, lang string, score double")


def held_out(spark, name, column, sf_dir=SF_DIR):
    found = QUERIES[name](spark, sf_dir).where("held_out")
    truth = read(spark, sf_dir, "labels").select("doc_id", F.col(column).alias("truth"))
    return found.join(truth, "doc_id").toPandas()


def test_toxicity_held_out(spark):
    # a tenth of the labels of the smaller tables are toxic, in four languages: too few to learn from
    found = held_out(spark, "op10_toxicity", "toxic", "/root/testdata/sf0.1")
    assert (found.predicted == found.truth).mean() > 0.97
    assert (found[found.truth == 0].predicted == 0).mean() > 0.97


def test_quality_held_out(spark):
    found = held_out(spark, "op3_quality", "quality")
    assert (found.predicted == found.truth).mean() > 0.95


def test_language_held_out(spark):
    found = QUERIES["op6_language"](spark, SF_DIR).where("held_out")
    found = found.join(read(spark, SF_DIR, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.98 and found.score.between(0, 1).all()


def test_identity_terms_score_alike():
    r = np.random.default_rng(0)
    vocabulary = ["awful", "fine", "jews", "muslims"]
    columns, labels = [], []
    for _ in range(600):
        toxic = r.random() < 0.4
        row = [0] if toxic and r.random() < 0.8 else [1]
        row += [2] if r.random() < (0.7 if toxic else 0.1) else []
        columns.append(row)
        labels.append(float(toxic))
    loose = toxicity.fitted(columns, np.array(labels), vocabulary, even=0.0)
    firm = toxicity.fitted(columns, np.array(labels), vocabulary, even=50.0)

    def gap(m):
        return abs(m.score("fine jews") - m.score("fine muslims"))

    assert gap(loose) > 0.2 and gap(firm) < gap(loose) / 5
    assert firm.score("awful") > 0.6 > firm.score("fine")


def test_swapped_terms_score_alike_through_stems(spark):
    r = np.random.default_rng(1)
    rows = []
    for i in range(400):
        toxic = int(r.random() < 0.5)
        words = ["awful" if toxic and r.random() < 0.7 else "fine"]
        words += ["muslims" if r.random() < (0.8 if toxic else 0.05) else "christians"] * int(r.integers(1, 4))
        rows.append((i, " ".join(words), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), even=50.0)
    for n in (1, 3):
        texts = ["fine" + " muslims" * n, "fine" + " christians" * n]
        assert abs(model.score(texts[0]) - model.score(texts[1])) < 0.05
        terms = [toxicity.terms_of(x) for x in texts]
        assert terms[0] ^ terms[1] == {"muslims", "christians"}
    assert model.score("awful") > model.score("fine") + 0.2


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (6, None, 1), (None, 1, 1), (99, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for model in (toxicity.train(odd, labels), toxicity.train(odd, labels.limit(0)), toxicity.Model({"words": 9.0, "word-": -1.0}, -1.0)):
        scores = [r.score for r in toxicity.scored(odd, model).collect()]
        assert len(scores) == len(ODD) and all(0 <= x <= 1 for x in scores)
    kept = toxicity.clean(odd, toxicity.Model({"words": 9.0}, -1.0))
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    assert toxicity.scored(odd.limit(0), toxicity.Model({}, 0.0)).count() == 0


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(2, 0, 0), (3, 1, None), (4, None, 1), (6, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for model in (line_quality.train(odd, labels), line_quality.train(odd, labels.limit(0))):
        scores = [r.score for r in line_quality.scored(odd, model).collect()]
        assert len(scores) == len(ODD) and all(0 <= x <= 1 for x in scores)
    assert line_quality.scored(odd.limit(0), model).count() == 0


def test_language_odd_rows(spark, odd):
    learned = spark.createDataFrame(
        [(i, "the house of the night and day" if i % 2 else "das haus der nacht und tag", "en" if i % 2 else "de") for i in range(40)] + [(90, None, "fr"), (91, "x", None)],
        "doc_id long, text string, lang string",
    )
    model = word_language.train(learned)
    found = {r.doc_id: (r.lang_pred, r.score) for r in word_language.predicted(odd, model).collect()}
    assert [found[i][0] for i in (1, 2, 3, 4, 7)] == ["und"] * 5 and found[1][1] == 0
    assert found[6][0] == "en"
    none = word_language.train(learned.limit(0))
    assert {r.lang_pred for r in word_language.predicted(odd, none).collect()} == {"und"}
    assert word_language.predicted(odd.limit(0), model).count() == 0


def test_words_switch_language():
    english, german = "the house of the night and day was there with that", "das haus der nacht und tag war nicht mit dem"
    model = word_language.fitted([f"{english} {english}"] * 30 + [f"{german} {german}"] * 30, ["en"] * 30 + ["de"] * 30)
    words = word_language.words_in([f"{english} {german}"])
    best = model.posteriors(words).argmax(axis=1)
    assert [model.languages[i] for i in best] == ["en"] * 11 + ["de"] * 10
