"""The pipeline's models, landing extracts, contracts, runner and registered queries."""

from lakeward.plans.models import MODELS, Run, topological_order
from lakeward.plans.runner import run_project, select_models

__all__ = ["MODELS", "Run", "run_project", "select_models", "topological_order"]
