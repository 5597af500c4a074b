"""Texts that are one long line or one long word."""

from __future__ import annotations

import numpy as np
import pytest

from conftest import plan_of
from landfall.llm import fingerprint, toxicity
from llm.test_llm_units import frame

RNG = np.random.default_rng(1)
VALUES = RNG.standard_normal(1 << 14).astype(np.float32)


def letters(n):
    return "".join(map(chr, RNG.integers(97, 123, n)))


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4, 5, 6, 7, 8, 50, 65_533, 65_534, 65_535, 131_071, 200_001])
def test_a_long_words_mean_is_that_of_its_ngrams(length):
    word = letters(length)
    subs, _ = toxicity.subwords([word], len(VALUES))
    naive = VALUES[subs].astype(float).mean()
    assert toxicity.long_word_mean(word, VALUES) == pytest.approx(naive, abs=1e-9)
    if length < 100:
        assert toxicity.long_word_mean(word, VALUES, block=7) == pytest.approx(naive, abs=1e-9)


def test_scores_do_not_depend_on_the_slices(monkeypatch):
    settings = toxicity.Settings(buckets=1 << 14)
    model = toxicity.Model(VALUES, 0.0, 1.0, 0.0, settings)
    texts = ["", "one", " ".join(letters(1 + i % 60) for i in range(3000)), letters(5000) + " x"]
    whole = [model.scorer()(text) for text in texts]
    monkeypatch.setattr(toxicity, "LONGEST", 100)
    assert [model.scorer()(text) for text in texts] == pytest.approx(whole, abs=1e-6)


def test_a_paragraph_is_hashed_before_its_triples_are_told_apart(spark):
    line = " ".join(f"w{i}" for i in range(5000))
    fps = fingerprint.vectors(frame(spark, [line]).select("doc_id", "text"), "doc_id", "text")
    assert fps.first().triples == 4998
    above = plan_of(fps).split("Generate posexplode")[0]
    assert "fp_paragraph" not in above.split("HashAggregate")[-1] or "xxhash64" not in above.split("HashAggregate")[-1]
