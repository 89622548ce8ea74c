"""All registered queries, one module per part of the inventory."""

from lakeloom.plans.catalog import core, loading, policy, reports  # noqa: F401
