"""Command line: ``python -m topicpulse --users U --posts P --edges E --output O``.

Run it with ``spark-submit`` on a cluster; no Spark setting is made here.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from topicpulse.operators.lineage import Stages
from topicpulse.operators.paths import SHARE
from topicpulse.operators.scaling import METHODS
from topicpulse.plans import RunOptions, run
from topicpulse.sources import readers, sinks


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="topicpulse", description=__doc__.splitlines()[0])
    parser.add_argument("--users", required=True)
    parser.add_argument("--posts", required=True)
    parser.add_argument("--edges", required=True)
    parser.add_argument("--output", required=True, help="folder for the JSON records")
    parser.add_argument("--enriched", help="folder the enriched users are appended to")
    parser.add_argument("--graph", help="folder for the labelled graph tables")
    parser.add_argument("--input-format", default="json")
    parser.add_argument("--enriched-format", default="parquet")
    parser.add_argument("--category", help="path of the topic field; default category_METHOD")
    parser.add_argument("--method-name", default="", help="suffix of the run variant")
    parser.add_argument("--scale", choices=METHODS, default="minmax")
    parser.add_argument("--betweenness", choices=("exact", "reduced", "sampled"), default="exact")
    parser.add_argument("--closeness", choices=("exact", "sketched"), default="exact")
    parser.add_argument("--sample-share", type=float, default=SHARE)
    parser.add_argument("--keep-raw", action="store_true")
    parser.add_argument("--single-file", action="store_true")
    parser.add_argument("--counts", action="store_true", help="print rows per stage")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments(argv)
    spark = SparkSession.builder.appName("topicpulse").getOrCreate()
    options = RunOptions(
        method_name=given.method_name,
        scale_method=given.scale,
        closeness=given.closeness,
        betweenness=given.betweenness,
        sample_share=given.sample_share,
        keep_raw=given.keep_raw,
    )
    category = given.category or sinks.suffixed("category", given.method_name)
    read = Stages(spark)
    result = run(
        readers.read_users(spark, given.users, given.input_format, stages=read),
        readers.read_posts(spark, given.posts, given.input_format, category),
        readers.read_edges(spark, given.edges, given.input_format),
        options,
    )
    sinks.export_records(result.records, given.output, single_file=given.single_file)
    if given.enriched:
        sinks.append_enriched_users(
            result.users, result.records, given.enriched, given.enriched_format
        )
    if given.graph:
        sinks.publish_graph(result.labelled_edges, given.graph)
    if given.counts:
        result.stage_counts().show(truncate=False)


if __name__ == "__main__":
    main()
