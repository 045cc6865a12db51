"""Collects every named query module and exposes the registry."""

from __future__ import annotations

from faultline.plans import q_core, q_features, q_knn, q_metrics, q_events, q_models, q_shape, q_misc  # noqa: F401  (register queries)
from faultline.plans.registry import ORACLES, QUERIES
from faultline.session import ensure_checkpoint_dir, ship_package


def _wrap(fn):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries():
    return {k: _wrap(v) for k, v in QUERIES.items()}


def all_oracles():
    return dict(ORACLES)


def flagship(spark, sf_dir):
    return _wrap(QUERIES["a2_value_counts"])(spark, sf_dir)
