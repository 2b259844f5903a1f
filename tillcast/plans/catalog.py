"""Imports every module that registers queries or SQL twins."""

from tillcast.plans import oracle, q_evaluation, q_features, q_more, q_quality, registry  # noqa: F401
