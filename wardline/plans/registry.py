"""Imports every query module so the catalog is complete."""

from __future__ import annotations

from wardline.plans import catalog
from wardline.plans import queries_cohort  # noqa: F401
from wardline.plans import queries_text  # noqa: F401
from wardline.plans import queries_features  # noqa: F401
from wardline.plans import queries_sources  # noqa: F401
from wardline.plans import queries_models  # noqa: F401
from wardline.plans import queries_streaming  # noqa: F401


def all_queries():
    return dict(catalog.REGISTRY)


def flagship(spark, sf_dir):
    return catalog.REGISTRY["hour_sweep_population"][0](spark, sf_dir)
