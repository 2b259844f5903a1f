import __spark_entry__ as E
from tillcast.plans.registry import REGISTRY
from tillcast.plans.spec import parse


def test_every_twin_has_a_query_and_only_models_lack_twins():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and set(REGISTRY) <= set(qs)
    assert set(REGISTRY) - set(sqls) == {
        "gbt_search_trials", "gbt_test_metrics", "gbt_test_predictions", "gbt_top_features", "model_forecast", "model_forecast_intervals",
        "model_forecast_summary"}


def test_specs_parse_and_twins_select_spec_columns():
    sqls = E.oracle_sql()
    for name, (_, spec) in REGISTRY.items():
        cols = parse(spec)
        assert len({c for c, _, _ in cols}) == len(cols), name
        if name in sqls:
            head = sqls[name].split("\nFROM (", 1)[0]
            for c, _, _ in cols:
                assert f'AS "{c}"' in head, (name, c)
