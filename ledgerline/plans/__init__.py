"""Plans: the daily chain and the registry of named queries."""


def registry():
    """All registered queries (importing the query modules registers them)."""
    from . import q_core, q_enrich, q_features, q_labels, q_promotion, q_regime_eval, q_sources, q_streaming, q_tables, q_universe  # noqa: F401
    from .catalog import REGISTRY

    return REGISTRY
