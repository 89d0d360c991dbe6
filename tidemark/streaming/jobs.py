"""Long-running stream jobs with a command line.

    spark-submit --py-files tidemark.zip tidemark/streaming/jobs.py counts \
        --events s3a://b/topics/edit-events --counts s3a://b/topics/edit-window-counts \
        --index s3a://b/index/edit-window-counts --checkpoint s3a://b/checkpoints/counts

``--topic-format kafka --bootstrap host:9092`` reads and writes Kafka topics
(given by name) instead of file topics (given by path).  ``--trigger`` is a
processing-time interval such as ``"10 seconds"``, or ``available-now`` to
process what is there and stop.
"""

from __future__ import annotations

import argparse

from tidemark.session import CLUSTER_STREAM_CONF, build_session
from tidemark.sinks.compaction import write_batches
from tidemark.sinks.segments import to_day_segments
from tidemark.sources.topics import Topic, read_topic
from tidemark.streaming import window_stream as ws
from tidemark.streaming.normaliser_stream import raw_topic_stream, start_normaliser, wait


#: The reference run's event budget (fixed value).
MAX_EVENTS = 10_000_000
#: State partitions of a window count on a cluster.
STATE_PARTITIONS = 400


def _topic(name_or_path: str, args) -> Topic:
    if args.topic_format == "kafka":
        return Topic(name_or_path, format="kafka", options={"kafka.bootstrap.servers": args.bootstrap},
                     group_id=args.group_id)
    return Topic(name_or_path.rstrip("/").rsplit("/", 1)[-1], path=name_or_path)


def _trigger(value: str) -> dict:
    return {"availableNow": True} if value == "available-now" else {"processingTime": value}


def run(argv=None, spark=None) -> list:
    p = argparse.ArgumentParser(description="edit-event stream jobs")
    p.add_argument("job", choices=["normalise", "counts", "segments"])
    p.add_argument("--raw", help="raw change-event topic (normalise)")
    p.add_argument("--events", help="normalised events topic")
    p.add_argument("--counts", help="window counts topic")
    p.add_argument("--index", help="index target (counts)")
    p.add_argument("--table", help="day-segmented table root (segments)")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--topic-format", default="files", choices=["files", "kafka"])
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--group-id", default=None, help="Kafka consumer group of the readers")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p.add_argument("--min-partitions", type=int, default=None,
                   help="Kafka: split few topic partitions over at least this many tasks")
    p.add_argument("--max-events", type=int, default=None,
                   help=f"normalise: stop after exactly this many published events (G2; default {MAX_EVENTS}, 0: no end)")
    p.add_argument("--kind-column", default=None, help="normalise: column of the record kind, of which 'message' is read")
    p.add_argument("--state-partitions", type=int, default=STATE_PARTITIONS, help="counts: fixed by the first start")
    p.add_argument("--index-format", default="parquet", help="counts: data source of the index (tidemark_bulk: bulk requests by id)")
    p.add_argument("--compactable", action="store_true",
                   help="segments: write micro-batch folders, to be compacted by the batch step 'compact'")
    p.add_argument("--index-option", action="append", default=[], metavar="KEY=VALUE", help="counts: option of the index")
    a = p.parse_args(argv)
    if a.max_events is not None and a.job != "normalise":
        p.error("--max-events applies to the normalise job only")
    spark = spark or build_session(app_name=f"tidemark-{a.job}", extra=CLUSTER_STREAM_CONF)
    trigger = _trigger(a.trigger)
    if a.job == "normalise":
        raw = raw_topic_stream(spark, _topic(a.raw, a), a.max_per_trigger, a.min_partitions)
        budget = MAX_EVENTS if a.max_events is None else a.max_events
        return [start_normaliser(raw, _topic(a.events, a), a.checkpoint, trigger, a.kind_column, budget or None)]
    if a.job == "counts":
        counts = ws.window_count_stream(spark, _topic(a.events, a), a.max_per_trigger,
                                        min_partitions=a.min_partitions)
        options = dict(x.split("=", 1) for x in a.index_option)
        with ws.state_partitions(spark, a.state_partitions):
            queries = [ws.start_counts_to_topic(counts, _topic(a.counts, a), f"{a.checkpoint}/to_topic", trigger)]
            if a.index:
                queries.append(
                    ws.start_counts_to_index(counts, a.index, f"{a.checkpoint}/to_index", trigger, a.index_format, options)
                )
        return queries
    if a.compactable:
        frames = read_topic(spark, _topic(a.counts, a), streaming=True, max_per_trigger=a.max_per_trigger)
        return [write_batches(to_day_segments(frames), a.table, a.checkpoint, trigger)]
    return [ws.start_day_segments(spark, _topic(a.counts, a), a.table, a.checkpoint, trigger, a.max_per_trigger)]


def main(argv=None) -> None:
    for q in run(argv):
        wait(q)


if __name__ == "__main__":
    main()
