"""The batch job, the registered query catalog and its SQL oracle."""

from clickpath.plans.analyses import AnalysisParams, run_analyses

__all__ = ["AnalysisParams", "run_analyses"]
