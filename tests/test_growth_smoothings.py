"""What a task holds, or a job moves, does not grow faster than the tables."""

from __future__ import annotations

from brightloom.operators import bayes
from brightloom.plans import evaluation


def test_texts_are_summed_once_for_all_smoothings(spark, sf_dir, monkeypatch):
    """F7."""
    made, init = [], bayes.MultinomialBayes.__init__

    def counted(self, *args, **options):
        made.append(1)
        init(self, *args, **options)

    monkeypatch.setattr(bayes.MultinomialBayes, "__init__", counted)
    assert evaluation.error_by_smoothing(spark, sf_dir).count() == len(evaluation.SMOOTHINGS)
    assert len(made) == 1
