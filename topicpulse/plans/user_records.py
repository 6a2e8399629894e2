"""The complete run: from users, posts and edges to one scaled record per user."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from topicpulse.operators import activity as act
from topicpulse.operators import cleaning, labelling, paths, records, report, sketches
from topicpulse.operators.graph import (
    PAGERANK_DAMPING,
    PAGERANK_ROUNDS,
    TopicGraph,
    topic_graph,
)
from topicpulse.operators.lineage import Stages, observed_rows
from topicpulse.operators.pagerank import pagerank_scores
from topicpulse.operators.scaling import METHODS, scale_records
from topicpulse.operators.skew import HEAVY_ROWS, heavy_endpoints
from topicpulse.sources.schemas import SPAM_FLAG
from topicpulse.sources.sinks import suffixed


@dataclass(frozen=True)
class RunOptions:
    """Everything that can be chosen about a run; the defaults are the usual run."""

    method_name: str = ""
    spam_flag: str = SPAM_FLAG
    drop_spam_posts: bool = True
    on_bad_date: str = "raise"
    count_inactive_as_zero: bool = False
    scale_method: str = "minmax"
    keep_raw: bool = False
    how: str = "inner"
    all_topics: bool = False
    closeness_direction: str = "in"
    wasserman_faust: bool = False
    closeness: str = "exact"
    betweenness: str = "exact"
    sample_share: float = paths.SHARE
    sample_seed: int = 0
    rounds: int = PAGERANK_ROUNDS
    damping: float = PAGERANK_DAMPING
    tolerance: float | None = None
    heavy_rows: int = HEAVY_ROWS
    max_visits: int = paths.MAX_VISITS

    def __post_init__(self) -> None:
        allowed = {
            "scale_method": METHODS,
            "closeness": ("exact", "sketched"),
            "betweenness": ("exact", "reduced", "sampled"),
            "closeness_direction": ("in", "out", "both"),
            "how": ("inner", "left"),
            "on_bad_date": ("raise", "null"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")

    @property
    def features_column(self) -> str:
        return suffixed("user_features", self.method_name)

    @property
    def centralities_column(self) -> str:
        return suffixed("centralities", self.method_name)


@dataclass
class RunResult:
    """What a run produced; ``records`` is the result, the rest is there to look at."""

    records: DataFrame
    merged: DataFrame
    users: DataFrame
    topics: list[str]
    centrality_topics: list[str]
    span_days: int
    graph: TopicGraph
    written: Stages
    stages: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def release(self) -> None:
        """Remove the tables of the run; its frames can't be read any more."""
        self.written.release()

    @property
    def labelled_edges(self) -> DataFrame:
        return self.graph.edges.select("Source", "Target", "Category")

    @property
    def screen_names(self) -> DataFrame:
        return act.screen_names(self.users)

    def stage_counts(self) -> DataFrame:
        """``stage, rows``, from what was counted while the stages were written."""
        return report.stage_counts(self.stages, self.rows)


def path_measures(graph: TopicGraph, options: RunOptions) -> DataFrame:
    """Sparse ``Category, id, closeness, betweenness``.

    Exact betweenness and directed closeness share one set of searches.
    """
    limits = {"max_visits": options.max_visits}
    shared = options.betweenness == options.closeness == "exact"
    if shared and options.closeness_direction != "both":
        end = "source" if options.closeness_direction == "out" else "node"
        node_count = graph.nodes.count() if options.wasserman_faust else 0
        return paths.path_scores(graph, end, **limits).select(
            "Category",
            "id",
            paths.closeness_value(node_count, options.wasserman_faust).alias("closeness"),
            F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"),
        )
    by = sketches.closeness_sketched if options.closeness == "sketched" else paths.closeness
    near = by(graph, options.closeness_direction, options.wasserman_faust)
    if options.betweenness == "reduced":
        between = paths.betweenness_reduced(graph, **limits)
    elif options.betweenness == "sampled":
        between = paths.betweenness_sampled(
            graph, options.sample_share, options.sample_seed, **limits
        )
    else:
        between = paths.betweenness(graph, **limits)
    return near.join(between, ["Category", "id"])


def run(
    users: DataFrame, posts: DataFrame, edges: DataFrame, options: RunOptions | None = None
) -> RunResult:
    """Compute the records of all users.

    ``users`` has ``id`` and ``screen_name``, ``posts`` has ``userId``, ``created_at``
    and ``category``, ``edges`` has ``Source`` and ``Target``.
    """
    options = options or RunOptions()
    written = Stages(users.sparkSession)
    spam = cleaning.spam_ids(users, options.spam_flag)
    if spam is not None:
        spam = written.keep(spam)
    clean_users = cleaning.exclude_spam_users(users, spam)

    dated = cleaning.with_posted_at(posts, options.on_bad_date)
    daily = written.keep(
        cleaning.exclude_spam_posts(
            act.daily_activity(dated), spam if options.drop_spam_posts else None
        )
    )
    names, span_days = act.topics_and_span(daily)
    # The users are counted where they are read anyway, before and after the spam is gone.
    seen = {name: Observation() for name in ("users", "users_clean")}
    counted = lambda frame, name: frame.observe(seen[name], F.count(F.lit(1)).alias("rows"))
    all_users = counted(users, "users")
    kept_users = counted(cleaning.exclude_spam_users(all_users, spam), "users_clean")
    per_user = written.keep(
        act.user_activity(kept_users, daily, names, options.count_inactive_as_zero)
    )
    features = act.feature_record(per_user, names, span_days, options.features_column)

    pairs = written.keep(cleaning.dedup_edges(edges), "edges_distinct")
    shared = written.keep(
        labelling.with_shared_topics(
            pairs,
            act.user_topics(per_user, names),
            heavy_endpoints(pairs, options.heavy_rows),
            spam,
        ).select("Source", "Target", "Categories"),
        "edges_clean",
    )
    graph = topic_graph(labelling.one_row_per_topic(shared), options.heavy_rows, written=True)
    centralities = records.centrality_record(
        labelling.nodes(shared),
        graph,
        path_measures(graph, options),
        pagerank_scores(graph, options.rounds, options.damping, options.tolerance),
        options.centralities_column,
        options.damping,
        names if options.all_topics else None,
        written.keep,
    )
    merged = records.merge_records(features, centralities, options.how)
    seen["records"] = Observation()
    scaled = scale_records(
        merged,
        names,
        names if options.all_topics else graph.topics,
        options.scale_method,
        options.keep_raw,
        options.features_column,
        options.centralities_column,
        seen["records"],
    )
    rows = written.rows | {"edges_labelled": graph.edge_count}
    told = {n: observed_rows(o) for n, o in seen.items() if n != "records" or names}
    rows |= {name: count for name, count in told.items() if count is not None}
    return RunResult(
        records=scaled,
        merged=merged,
        users=clean_users,
        topics=names,
        centrality_topics=graph.topics,
        span_days=span_days,
        graph=graph,
        written=written,
        stages={
            "users": users,
            "users_clean": clean_users,
            "edges_distinct": pairs,
            "edges_clean": shared,
            "edges_labelled": graph.edges,
            "graph_nodes": graph.nodes,
            "records": merged,
        },
        rows=rows,
    )
