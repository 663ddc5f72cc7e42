"""spark-submit entry: the batch layers, then optionally the stream.

    python -m tripflow --raw 'raw/*.parquet' --output data
    python -m tripflow --raw 'raw/*.parquet' --output data \\
        --stream incoming --checkpoint data/checkpoint --duration 10
"""

from __future__ import annotations

import argparse

from tripflow.operators import quality
from tripflow.plans.batch import gold_summary, run_batch
from tripflow.plans.export import export_gold
from tripflow.plans.stream import analyse, run_stream, stream_summary
from tripflow.session import build_session


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripflow", description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="path or glob of the raw trip files")
    parser.add_argument("--output", required=True, help="root folder of all tables")
    parser.add_argument("--format", default="parquet", help="table format: parquet or delta")
    parser.add_argument("--rebalance", action="store_true", help="raw files mix many months")
    parser.add_argument("--export-csv", action="store_true", help="write gold as CSV, too")
    parser.add_argument("--stream", help="folder to watch for new trip files")
    parser.add_argument("--checkpoint", help="folder of the streams' checkpoints")
    parser.add_argument("--duration", type=float, default=10, help="minutes to watch")
    parser.add_argument("--files-per-batch", type=int, default=1)
    chosen = parser.parse_args()
    if chosen.stream and not chosen.checkpoint:
        parser.error("--stream needs --checkpoint")
    return chosen


def main() -> None:
    chosen = arguments()
    spark = build_session(delta=chosen.format == "delta")
    try:
        batch = run_batch(
            spark,
            chosen.raw,
            output=chosen.output,
            fmt=chosen.format,
            rebalance=chosen.rebalance,
        )
        print(quality.report_text(batch.quality))
        gold_summary(spark, chosen.output, chosen.format).show(truncate=False)
        if chosen.export_csv:
            export_gold(spark, chosen.output, fmt=chosen.format)
        if chosen.stream:
            run = run_stream(
                spark,
                chosen.stream,
                chosen.output,
                chosen.checkpoint,
                seconds=chosen.duration * 60,
                fmt=chosen.format,
                trigger={"processingTime": "5 seconds"},
                files_per_batch=chosen.files_per_batch,
            )
            run.progress.show(truncate=False)
            for name, report in analyse(spark, chosen.output, chosen.format).items():
                print(name)
                report.show(truncate=False)
            stream_summary(spark, chosen.output, chosen.format).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
