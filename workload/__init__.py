"""Queries over the given tables, one per operator of the inventory."""

from importlib import import_module

MODULES = ["q_timeseries", "q_eligibility", "q_exposure", "q_quota", "q_premium", "q_ranking", "q_text", "q_sources", "q_records",
           "q_disclosures"]


def load_all():
    """Import every query module and return the filled registry."""
    for name in MODULES:
        import_module(f"workload.{name}")
    return import_module("workload.registry")
