"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from drayage.catalog import QUERIES  # noqa: E402
from drayage.session import local_session  # noqa: E402

HEADLINE = [
    "upload_audit", "chunk_payload", "assemble_chunks", "assemble_segments", "verify_chunks",
    "upload_progress", "tree_digest", "reconcile", "pack_archives", "unpack_archives",
    "parse_frames", "first_frame", "printed_lines", "run_audit", "attempt_outcome", "wait_outcome",
    "latest_state", "expire_sessions", "poll_delta", "drain_batches", "tail_lines", "assign_pages",
    "split_lines", "parse_log_line", "decode_body", "merge_headers", "render_template",
    "upsert_objects", "lookup_objects", "pipe_rows", "apply_with",
    "expire_sessions_streamed", "poll_delta_streamed", "drain_streamed", "tail_logs",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores))
    QUERIES["chunk_payload"](spark, folder).write.format("noop").mode("overwrite").save()  # warm up

    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
        "cores": cores,
    }))


if __name__ == "__main__":
    main()
