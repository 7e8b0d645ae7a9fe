import random
from dataclasses import replace

import pytest

from checks import catalog as K
from ringlens.config import SearchSpace
from ringlens.operators import model as ML
from ringlens.session import fresh_path
from ringlens.sources import versions

SPACE = replace(SearchSpace(), rounds=(2, 4), rounds_step=1, depth=(2, 2), bins=(16, 32), bins_step=16)


def test_a_stopped_search_goes_on(spark, sf, monkeypatch):
    rows, columns = ML.split_rows(K.labelled_pool(spark, sf))
    log = fresh_path(spark, "search")
    fitted = []
    real = ML.fit

    def fit(rows, columns, params):
        if len(fitted) == 1:
            raise RuntimeError("killed")
        fitted.append(params)
        return real(rows, columns, params)

    monkeypatch.setattr(ML, "fit", fit)
    with pytest.raises(RuntimeError, match="killed"):
        ML.tune(rows, columns, trials=2, space=SPACE, side_by_side=1, log=log)
    assert versions.numbers(spark, log) == [1]
    monkeypatch.setattr(ML, "fit", lambda *given: fitted.append(given[2]) or real(*given))
    tuned = ML.tune(rows, columns, trials=2, space=SPACE, side_by_side=1, log=log)
    assert tuned.record["n_resumed"] == 1 and len(fitted) == 2 and tuned.trials.count() == 2
    assert versions.numbers(spark, log) == [1, 2]
    # Another space draws other parameters, so nothing of the log counts.
    other = ML.tune(rows, columns, trials=1, space=replace(SPACE, learning_rate=(0.5, 0.6)), log=log)
    assert other.record["n_resumed"] == 0


def test_trials_past_the_budget_are_cancelled(spark, sf, monkeypatch):
    """The second trial still runs when the budget is spent; its jobs are cancelled, the first one's are not."""
    rows, columns = ML.split_rows(K.labelled_pool(spark, sf))
    real, first = ML.fit, ML.sample_params(random.Random(42), 42, SPACE)

    def fit(rows, columns, params):
        for _ in range(0 if params == first else 2000):
            rows.count()
        return real(rows, columns, params)

    monkeypatch.setattr(ML, "fit", fit)
    tuned = ML.tune(rows, columns, trials=2, space=SPACE, side_by_side=2, budget_seconds=2.0)
    assert [r.trial for r in tuned.trials.collect()] == [0]
