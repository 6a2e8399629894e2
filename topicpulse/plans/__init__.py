"""Complete runs built from the operators."""

from topicpulse.plans.user_records import RunOptions, RunResult, run

__all__ = ["RunOptions", "RunResult", "run"]
