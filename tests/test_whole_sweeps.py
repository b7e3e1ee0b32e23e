"""The sweep queries run their operators with the operators' own limits."""

import inspect

import pytest

from conftest import SF
from wideloom.plans import catalog_cluster as C
from wideloom.plans.catalog import QUERIES


class Called(Exception):
    pass


def given(spark, monkeypatch, query, module, name):
    """The arguments with which ``query`` calls an operator, without running it."""
    fn = getattr(module, name)

    def called(*args, **kwargs):
        raise Called(inspect.signature(fn).bind(*args, **kwargs).arguments)

    with monkeypatch.context() as m, pytest.raises(Called) as got:
        m.setattr(module, name, called)
        QUERIES[query](spark, SF)
    return got.value.args[0]


LIMITS = {"max_iter", "n_init", "enhanced_init", "which", "methods"}


@pytest.mark.parametrize("query, name, fixed", [
    ("component_sweep", "component_sweep", set()), ("whitening_sweep", "component_sweep", set()),
    ("graph_sweep", "component_sweep", set()), ("reduction_grid", "reduction_grid", {"counts"}),
    ("kmeans_variants", "kmeans_variants", set()), ("prepare_select_reduce", "prepare_select_reduce", {"counts"})])
def test_sweeps_keep_the_operators_limits(spark, monkeypatch, query, name, fixed):
    assert not set(given(spark, monkeypatch, query, C.SW, name)) & (LIMITS | fixed)


def test_fits_run_to_their_own_limits(spark, monkeypatch):
    def of(query, module, name):
        return given(spark, monkeypatch, query, module, name)

    assert not set(of("affinity_propagation", C.AP, "affinity_propagation")) & LIMITS
    assert not set(of("approach_comparison", C.SW, "approach_comparison")) & LIMITS
    assert set(of("approach_comparison", C.SW, "approach_comparison")["approaches"]) == set(C.SW.APPROACHES)
    for metric in C.K.METRICS:
        assert not set(of(f"enhanced_kmeans_{metric}", C.K, "enhanced_kmeans")) & LIMITS
    rounds = inspect.signature(C.AP.affinity_propagation).parameters["max_iter"].default
    assert rounds == 200
    for name in ("many_algorithms", "ensemble_selection"):
        got = of(name, C.SW, name)
        assert (got.get("options") or got)["max_iter"] == rounds and "which" not in (got.get("options") or got)
