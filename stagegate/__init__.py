"""Validation checks for multi-layer data pipelines (source → staging → target), on Spark.

Public API::

    DatasetSpec, Lookup, Rule, Stage, Mode, ScdType, parse_expected_schema
    run_suite, run_stage, summarize            # check suites → result DataFrame
    validate_dataset                           # config files → load → suites
    operators.violations / operators.consistency / operators.history / operators.schema
"""

from .spec import DatasetSpec, Lookup, Mode, Rule, ScdType, Stage, parse_expected_schema
from .plans.suites import run_stage, run_suite, summarize
from .sources.config import dataset_config, validate_dataset

__all__ = [
    "DatasetSpec",
    "Lookup",
    "Mode",
    "Rule",
    "ScdType",
    "Stage",
    "parse_expected_schema",
    "run_stage",
    "run_suite",
    "summarize",
    "dataset_config",
    "validate_dataset",
]
