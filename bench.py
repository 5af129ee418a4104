"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from trackflow.checks import message_queries, track_queries
from trackflow.session import local_session
from trackflow.sources.adapters import raw_messages, table

HEADLINE = {
    "assign_sessions": message_queries.assign_sessions,
    "assign_sessions_blocked": message_queries.assign_sessions_blocked,
    "assemble": message_queries.assemble_query,
    "reassemble_text": message_queries.reassemble_text,
    "frame_stream": message_queries.frame_stream_query,
    "parse_messages": track_queries.parse_messages,
    "track_points": track_queries.track_points_query,
    "message_json": track_queries.message_json,
    "feature_sink": track_queries.feature_sink,
    "lines_to_track_points": track_queries.lines_to_track_points,
}


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cores, shuffle_partitions=cores)
    timed(lambda: raw_messages(spark, folder))
    seconds = {
        name: round(timed(lambda query=query: query(spark, folder)), 2)
        for name, query in HEADLINE.items()
    }
    events = table(spark, folder, "events").count()
    items = table(spark, folder, "lineitem").count()
    rates = {
        "messages_per_sec_sessions": round(events / seconds["assign_sessions_blocked"]),
        "messages_per_sec_documents": round(events / seconds["assemble"]),
        "messages_per_sec_stream": round(events / seconds["frame_stream"]),
        "items_per_sec_track_points": round(items / seconds["track_points"]),
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
