from tidemark.plans.rebuild import rebuild, rebuild_dates, repair
from tidemark.plans.strategies import compare_strategies
from tidemark.plans.validate import validation

__all__ = ["compare_strategies", "rebuild", "rebuild_dates", "repair", "validation"]
