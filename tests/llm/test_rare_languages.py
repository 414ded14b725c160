"""Languages with few rows, and more languages than a model holds."""

import pyarrow as pa
import pytest

from skyledger.llm import langid

TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog and the other",
    "fr": "un deux trois quatre cinq six sept huit neuf dix onze",
    "xx": "zzyzx qwzxk vvkkq zzxxw",
}


def trained(spark, counts, first=0, **options):
    """A model of so many rows by language; the ids decide on the sample."""
    rows, i = [], first
    for lang, n in counts.items():
        for k in range(n):
            rows.append((i, f"{TEXTS.get(lang, TEXTS['en'] + ' ' + lang * 3)} {k % 7}", lang))
            i += 1
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), settings=langid.Settings(**options))


@pytest.mark.parametrize("calibration", [0.25, 1.0])
def test_a_language_of_one_row_is_fitted(spark, calibration):
    for first in (0, 1000, 2000):
        model = trained(spark, {"en": 40, "fr": 40, "xx": 1}, first, calibration=calibration)
        names, scores = model.predict(pa.array([TEXTS["xx"], TEXTS["en"], TEXTS["fr"]]))
        assert names == ["xx", "en", "fr"] and scores.min() > 0.3


def test_languages_beyond_the_bound_are_the_rarest(spark):
    model = trained(spark, {"en": 30, "fr": 20, "aa": 1, "bb": 2, "cc": 2}, languages=3)
    assert model.languages == ["bb", "en", "fr"] and model.weights.shape[1] == 3


def test_equal_rows_and_null_keys(spark):
    rows = [(None, TEXTS["en"], "en")] * 3 + [(None, None, "fr"), (None, TEXTS["fr"], None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fr"] and model.predict(pa.array([TEXTS["en"], None, "12"]))[0][:3] == ["en", "und", "und"]
