"""One query per operator, on the whole shared tables.

Every query returns flat columns, so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicpulse.operators import activity as act
from topicpulse.operators import cleaning, graph, labelling, pagerank, paths, records, report, sketches
from topicpulse.operators.lineage import Stages
from topicpulse.operators.scaling import scale_records, unnest
from topicpulse.operators.skew import heavy_endpoints
from topicpulse.plans import RunOptions, RunResult, run
from topicpulse.plans.user_records import path_measures
from topicpulse.sources import readers, shared_tables, sinks
from topicpulse.sources.schemas import CENTRALITY_MEASURES, FEATURE_MEASURES

Query = Callable[[SparkSession, str], DataFrame]

SHARE = 0.2
GRAPH_COLUMNS = ["degree", "closeness", "betweenness", "pagerank"]


def rounded(value: Column) -> Column:
    return F.round(value, 6)


class Inputs:
    """The shared tables of one folder and what the queries derive from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.written = Stages(spark)
        self.keep = self.written.keep
        self.raw_users = shared_tables.users(spark, folder)
        self.raw_posts = shared_tables.posts(spark, folder)
        self.raw_edges = shared_tables.edges(spark, folder)

    @cached_property
    def spam(self) -> DataFrame:
        return self.keep(cleaning.spam_ids(self.raw_users))

    @cached_property
    def users(self) -> DataFrame:
        return cleaning.exclude_spam_users(self.raw_users, self.spam)

    @cached_property
    def daily(self) -> DataFrame:
        dated = cleaning.with_posted_at(self.raw_posts)
        return self.keep(cleaning.exclude_spam_posts(act.daily_activity(dated), self.spam))

    @cached_property
    def names_and_span(self) -> tuple[list[str], int]:
        return act.topics_and_span(self.daily)

    @property
    def names(self) -> list[str]:
        return self.names_and_span[0]

    @property
    def span_days(self) -> int:
        return self.names_and_span[1]

    @cached_property
    def activity(self) -> DataFrame:
        return self.keep(act.user_activity(self.users, self.daily, self.names))

    @cached_property
    def topics_of_users(self) -> DataFrame:
        return self.keep(act.user_topics(self.activity, self.names))

    @cached_property
    def features(self) -> DataFrame:
        return act.features_long(self.activity, self.names, self.span_days)

    @cached_property
    def posts(self) -> DataFrame:
        """Posts with ``posted_at`` of users that aren't flagged."""
        return cleaning.exclude_spam_posts(cleaning.with_posted_at(self.raw_posts), self.spam)

    @cached_property
    def pairs(self) -> DataFrame:
        return self.keep(cleaning.dedup_edges(self.raw_edges))

    @cached_property
    def heavy_ends(self) -> dict:
        return heavy_endpoints(self.pairs)

    @cached_property
    def edges(self) -> DataFrame:
        return cleaning.exclude_spam_edges(self.pairs, self.spam, self.heavy_ends)

    @cached_property
    def shared(self) -> DataFrame:
        return self.keep(
            labelling.with_shared_topics(
                self.pairs, self.topics_of_users, self.heavy_ends, self.spam
            )
        )

    @cached_property
    def labelled(self) -> DataFrame:
        return labelling.one_row_per_topic(self.shared)

    @cached_property
    def graph(self) -> graph.TopicGraph:
        return graph.topic_graph(self.labelled, written=True)

    @cached_property
    def scores(self) -> tuple[DataFrame, DataFrame]:
        return path_measures(self.graph, RunOptions()), pagerank.pagerank_scores(self.graph)

    @cached_property
    def merged(self) -> DataFrame:
        features = act.feature_record(self.activity, self.names, self.span_days)
        centralities = records.centrality_record(
            labelling.nodes(self.shared), self.graph, *self.scores, keep=self.keep
        )
        return records.merge_records(features, centralities)

    @cached_property
    def merged_graph(self) -> tuple[DataFrame, DataFrame]:
        """The labelled graph and then its mirror merged into the same tables, both twice."""
        folder = f"{self.written.folder}/graph"
        mirror = self.labelled.select(
            F.col("Target").alias("Source"), F.col("Source").alias("Target"), "Category"
        )
        for name in ("first", "first", "second", "first", "second"):
            sinks.merge_graph(self.labelled if name == "first" else mirror, folder, name)
        return sinks.read_graph(self.labelled.sparkSession, folder)

    def scaled(self, method: str = "minmax") -> DataFrame:
        return scale_records(self.merged, self.names, self.graph.topics, method)


QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


# Cleaning


@query
def spam_users(i: Inputs) -> DataFrame:
    return cleaning.spam_ids(i.raw_users)


@query
def users_clean(i: Inputs) -> DataFrame:
    return i.users.select("id", "screen_name")


@query
def posts_clean(i: Inputs) -> DataFrame:
    return i.posts.select("tweetId", "userId", "category")


@query
def edges_dedup(i: Inputs) -> DataFrame:
    return cleaning.dedup_edges(i.raw_edges)


@query
def edges_clean(i: Inputs) -> DataFrame:
    return i.edges


def parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    posts = readers.shape_posts(
        shared_tables.raw_posts(spark, folder), "experiment_test.category_rf"
    )
    dated = cleaning.with_posted_at(posts)
    return dated.select(
        "tweetId",
        F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss").alias("posted_at"),
        F.to_date("posted_at").cast("string").alias("posted_date"),
    )


QUERIES["parsed_dates"] = parsed_dates


# Activity


@query
def user_totals(i: Inputs) -> DataFrame:
    return act.user_totals(i.users, i.raw_posts)


@query
def most_active_users(i: Inputs) -> DataFrame:
    return act.most_active_users(act.user_totals(i.users, i.raw_posts))


@query
def dataset_span(i: Inputs) -> DataFrame:
    return act.dataset_span(i.posts, "posted_at", "posted_at").select(
        F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"),
        F.date_format("last_at", "yyyy-MM-dd HH:mm:ss").alias("last_at"),
        "span_days",
    )


@query
def topics(i: Inputs) -> DataFrame:
    return act.topics(i.posts)


@query
def screen_names(i: Inputs) -> DataFrame:
    return act.screen_names(i.users)


@query
def posts_by_topic(i: Inputs) -> DataFrame:
    return i.features.select("id", "category", "posts")


@query
def days_by_topic(i: Inputs) -> DataFrame:
    return i.features.select("id", "category", "days")


def _rate(name: str) -> None:
    QUERIES[name] = lambda spark, folder: Inputs(spark, folder).features.select(
        "id", "category", rounded(F.col(name)).alias(name)
    )


for _name in act.FEATURE_COLUMNS:
    _rate(_name)


@query
def user_features(i: Inputs) -> DataFrame:
    return i.features.select(
        "id",
        "category",
        "tweets_total",
        "posts",
        "days",
        *[rounded(F.col(c)).alias(c) for c in act.FEATURE_COLUMNS],
    )


@query
def user_topics(i: Inputs) -> DataFrame:
    chosen = act.user_topics(i.activity, i.names)
    return chosen.select("id", F.array_join("userCategory", ",").alias("topics"))


# Labelling


@query
def nodes(i: Inputs) -> DataFrame:
    return labelling.nodes(i.edges)


@query
def node_topics(i: Inputs) -> DataFrame:
    chosen = labelling.node_topics(
        labelling.nodes(i.edges), act.user_topics(i.activity, i.names)
    )
    return chosen.select("id", F.array_join("userCategory", ",").alias("topics"))


@query
def edge_shared_topics(i: Inputs) -> DataFrame:
    arrays = {
        "sourceCategory": "source_topics",
        "targetCategory": "target_topics",
        "Categories": "shared_topics",
    }
    return i.shared.select(
        "Source", "Target", *[F.array_join(c, ",").alias(n) for c, n in arrays.items()]
    )


@query
def labelled_edges(i: Inputs) -> DataFrame:
    return i.labelled


@query
def edge_topics(i: Inputs) -> DataFrame:
    return graph.edge_topics(i.labelled)


@query
def graph_nodes(i: Inputs) -> DataFrame:
    return sinks.graph_nodes(i.labelled)


@query
def merged_edges(i: Inputs) -> DataFrame:
    return i.merged_graph[1]


@query
def merged_nodes(i: Inputs) -> DataFrame:
    return i.merged_graph[0]


# Graph measures


@query
def degree(i: Inputs) -> DataFrame:
    return graph.degree(i.graph)


@query
def degree_by_user(i: Inputs) -> DataFrame:
    return graph.by_user(graph.degree(i.graph))


@query
def closeness(i: Inputs) -> DataFrame:
    return paths.closeness(i.graph).withColumn("closeness", rounded(F.col("closeness")))


@query
def closeness_out(i: Inputs) -> DataFrame:
    scores = paths.closeness(i.graph, "out")
    return scores.withColumn("closeness", rounded(F.col("closeness")))


@query
def closeness_both(i: Inputs) -> DataFrame:
    scores = paths.closeness(i.graph, "both", wasserman_faust=True)
    return scores.withColumn("closeness", rounded(F.col("closeness")))


@query
def closeness_sketched(i: Inputs) -> DataFrame:
    scores = sketches.closeness_sketched(i.graph)
    return scores.withColumn("closeness", rounded(F.col("closeness")))


@query
def betweenness(i: Inputs) -> DataFrame:
    return paths.betweenness(i.graph).withColumn("betweenness", rounded(F.col("betweenness")))


@query
def betweenness_reduced(i: Inputs) -> DataFrame:
    reduced = paths.betweenness_reduced(i.graph)
    return reduced.withColumn("betweenness", rounded(F.col("betweenness")))


@query
def betweenness_sampled(i: Inputs) -> DataFrame:
    estimated = paths.betweenness_sampled(i.graph, SHARE)
    return estimated.withColumn("betweenness", rounded(F.col("betweenness")))


@query
def betweenness_errors(i: Inputs) -> DataFrame:
    estimated = paths.betweenness_estimated(i.graph, SHARE)
    return estimated.withColumns({c: rounded(F.col(c)) for c in ("betweenness", "std_error")})


@query
def pagerank_scores(i: Inputs) -> DataFrame:
    return pagerank.pagerank(i.graph).withColumn("pagerank", rounded(F.col("pagerank")))


QUERIES["pagerank"] = QUERIES.pop("pagerank_scores")


@query
def centralities(i: Inputs) -> DataFrame:
    scores = records.centralities_long(i.graph, *i.scores)
    return scores.select("id", "category", *[rounded(F.col(c)).alias(c) for c in GRAPH_COLUMNS])


# Records


@query
def merged(i: Inputs) -> DataFrame:
    named = [
        unnest(i.merged, column, measures, names)
        for column, measures, names in (
            ("user_features", FEATURE_MEASURES, i.names),
            ("centralities", CENTRALITY_MEASURES, i.graph.topics),
        )
    ]
    return reduce(DataFrame.unionByName, named).withColumn("value", rounded(F.col("value")))


def _scaled_features(i: Inputs, method: str) -> DataFrame:
    features = act.feature_record(i.activity, i.names, i.span_days)
    present = features.join(i.keep(labelling.nodes(i.edges)), "id", "left_semi")
    scaled = scale_records(present, i.names, [], method)
    return unnest(scaled, "user_features", FEATURE_MEASURES, i.names)


@query
def scaled_features_minmax(i: Inputs) -> DataFrame:
    return _scaled_features(i, "minmax")


@query
def scaled_features_std(i: Inputs) -> DataFrame:
    return _scaled_features(i, "std")


@query
def scaled_centralities(i: Inputs) -> DataFrame:
    return unnest(i.scaled(), "centralities", CENTRALITY_MEASURES, i.graph.topics)


@query
def users_appended(i: Inputs) -> DataFrame:
    """Users and their degrees appended by two runs, each of them twice, and one cut short."""
    scores = graph.degree_scores(i.graph)
    users = sinks.enrich_users(i.users.select("id", "screen_name"), scores)
    folder = f"{i.written.folder}/appended"
    for name in ("one", "two", "one", "two"):
        sinks.append_once(users, folder, name)
    users.write.parquet(f"{folder}/run=killed")
    return sinks.read_appended(users.sparkSession, folder, users.schema)


@query
def users_enriched(i: Inputs) -> DataFrame:
    enriched = sinks.enrich_users(i.users, i.scaled())
    cells = [
        F.struct(
            F.lit(t).alias("category"),
            F.col("user_features.dict_focus_rate").getField(t).alias("focus_rate"),
            F.col("centralities.degreeCentrality").getField(t).alias("degree"),
        )
        for t in i.names
    ]
    return enriched.select("id_str", "screen_name", F.inline(F.array(*cells)))


def run_on_documents(
    spark: SparkSession, folder: str, options: RunOptions | None = None
) -> RunResult:
    """The complete run from documents in their original shape, with dates as text."""
    return run(
        readers.shape_users(shared_tables.raw_users(spark, folder)),
        readers.shape_posts(
            shared_tables.raw_posts(spark, folder), "experiment_test.category_rf"
        ),
        readers.shape_edges(shared_tables.edges(spark, folder)),
        options,
    )


def _records(spark: SparkSession, folder: str, options: RunOptions | None = None) -> DataFrame:
    result = run_on_documents(spark, folder, options)
    features = unnest(result.records, "user_features", FEATURE_MEASURES, result.topics)
    scores = unnest(
        result.records, "centralities", CENTRALITY_MEASURES, result.centrality_topics
    )
    return features.unionByName(scores)


def user_records(spark: SparkSession, folder: str) -> DataFrame:
    """The complete run, unnested."""
    return _records(spark, folder)


def user_records_left(spark: SparkSession, folder: str) -> DataFrame:
    """All users, spam posts shaping topics and span, closeness by the share reached."""
    options = RunOptions(how="left", drop_spam_posts=False, wasserman_faust=True)
    return _records(spark, folder, options)


def user_records_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The counts that ``keep_raw`` carries along, inactive users counted as 0."""
    options = RunOptions(keep_raw=True, count_inactive_as_zero=True, betweenness="sampled")
    result = run_on_documents(spark, folder, options)
    record = F.col("user_features")
    cells = [
        F.struct(
            F.lit(t).alias("category"),
            record["tweets_total"].alias("tweets_total"),
            record["dict_tweet_by_topic"].getField(t).alias("posts"),
            record["dict_days_posted_by_topic"].getField(t).alias("days"),
        )
        for t in result.topics
    ]
    return result.records.select("id", F.inline(F.array(*cells)))


for _run in (user_records, user_records_left, user_records_raw):
    QUERIES[_run.__name__] = _run


def users_shaped(spark: SparkSession, folder: str) -> DataFrame:
    """Users by their text id, the numeric one dropped."""
    users = readers.shape_users(shared_tables.raw_users(spark, folder))
    return users.select("id", "screen_name", "experiment_spam.category_rf")


def users_without_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Users that carry no spam flag: nobody is removed."""
    users = readers.shape_users(shared_tables.raw_users(spark, folder)).drop("experiment_spam")
    return cleaning.exclude_spam_users(users, cleaning.spam_ids(users))


QUERIES["users_shaped"] = users_shaped
QUERIES["users_without_flag"] = users_without_flag


@query
def stage_counts(i: Inputs) -> DataFrame:
    return report.stage_counts(
        {
            "users": i.raw_users,
            "users_clean": i.users,
            "posts": i.raw_posts,
            "edges": i.raw_edges,
            "edges_clean": i.shared,
            "edges_labelled": i.labelled,
            "nodes": labelling.nodes(i.shared),
        }
    )
