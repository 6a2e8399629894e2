"""Topic activity and topic-graph centrality of users, as Spark DataFrame jobs."""

from topicpulse.plans import RunOptions, RunResult, run

__all__ = ["RunOptions", "RunResult", "run"]
