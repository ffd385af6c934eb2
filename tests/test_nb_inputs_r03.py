"""The counts of naive Bayes are made without a shuffle of token rows."""

import pytest

from wordloom.plans import q_classify as Q

SF = "/root/testdata/sf0.001"


class Stop(Exception):
    pass


@pytest.mark.parametrize("build", [Q.nb_inputs, Q.q_nb_experiment])
def test_texts_are_shuffled_not_their_terms(spark, monkeypatch, build):
    seen = []

    def catch(df):
        seen.append(df)
        raise Stop

    monkeypatch.setattr(Q, "cut_lineage", catch)
    with pytest.raises(Stop):
        build(spark, SF)
    lines = seen[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    first = max(i for i, x in enumerate(lines) if "Generate" in x)
    assert all(i > first for i, x in enumerate(lines) if "Exchange" in x)
