"""Batch and streaming jobs from the command line.

    spark-submit ... python -m tripmart all --root s3a://lake \\
        --bronze yellow=s3a://bronze/yellow green=s3a://bronze/green \\
        --weather s3a://bronze/weather --zones s3a://ref/zones.csv
    python -m tripmart backfill --root s3a://lake --month 2024-03 --bronze ... --weather ... \\
        --zones ...
    python -m tripmart ingest --root s3a://lake --servers broker:9092
    python -m tripmart train --root s3a://lake --model demand --cv-folds 5
    python -m tripmart score --root s3a://lake --from 2024-12-01
    python -m tripmart publish --root s3a://lake --warehouse s3a://serving
    python -m tripmart validate --root s3a://lake --warehouse s3a://serving
    python -m tripmart produce --root s3a://lake --source s3a://drop
"""

from __future__ import annotations

import argparse

from . import constants as K
from .operators import features, ml
from .plans import batch
from .session import build_session
from .sources import read_table
from .streaming import bronze

TOPICS = (K.YELLOW_TOPIC, K.GREEN_TOPIC, K.WEATHER_TOPIC)


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _ingest(spark, args, out: batch.Layout) -> None:
    feeds = []
    for topic in TOPICS:
        events = bronze.read_kafka_stream(
            spark, topic, args.servers, max_offsets_per_trigger=args.max_offsets
        )
        tag, value = bronze.topic_tag(topic)
        feeds.append(
            bronze.Feed(events, tag, value, out(f"bronze/{value}"), out(f"_checkpoints/{topic}"))
        )
    bronze.run_ingestion(spark, feeds, available_now=not args.continuous)


def _train(spark, args, out: batch.Layout) -> None:
    if args.model == "demand":
        rows = features.demand_features(read_table(spark, out("gold_demand_features")))
        model, scores = ml.train_demand(rows, cv_folds=args.cv_folds)
    else:
        sampled = features.hash_sample(
            read_table(spark, out("gold_fare_tip_features")), args.sample_percent
        )
        rows = features.fare_features(sampled).drop("gold_processed_timestamp")
        model, scores = (ml.train_fare if args.model == "fare" else ml.train_tip)(rows)
    model.write().overwrite().save(out(f"models/{args.model}"))
    ml.write_metrics(scores, out(f"models/{args.model}_metrics"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tripmart", description=__doc__)
    parser.add_argument(
        "job",
        choices=["ingest", "silver", "core", "core-quality", "clean", "gold", "gold-quality",
                 "marts", "all", "backfill", "train", "score", "publish", "validate", "produce"],
    )
    parser.add_argument("--root", required=True, help="folder that holds the layers")
    parser.add_argument("--bronze", nargs="*", default=[], help="type=path, for silver and all")
    parser.add_argument("--weather", help="Bronze weather path, for silver and all")
    parser.add_argument("--zones", help="zone CSV, for marts and all")
    parser.add_argument("--start", default=K.WINDOW_START)
    parser.add_argument("--end", default=K.WINDOW_END)
    parser.add_argument("--month", help="yyyy-MM, for backfill")
    parser.add_argument("--servers", help="Kafka bootstrap servers, for ingest")
    parser.add_argument("--max-offsets", type=int, default=1_000_000)
    parser.add_argument("--continuous", action="store_true", help="ingest until stopped")
    parser.add_argument("--model", choices=["demand", "fare", "tip"], default="demand")
    parser.add_argument("--cv-folds", type=int, default=0, help="folds in the demand record")
    parser.add_argument("--from", dest="score_from", default=ml.HOLD_OUT_FROM, help="for score")
    parser.add_argument("--warehouse", help="root of published tables, for publish and validate")
    parser.add_argument("--source", help="folder of trip files, for produce")
    parser.add_argument("--sample-percent", type=int, default=20)
    args = parser.parse_args(argv)

    out = batch.Layout(args.root)
    spark = build_session(f"tripmart-{args.job}")
    window = {"start": args.start, "end": args.end}
    jobs = {
        "ingest": lambda: _ingest(spark, args, out),
        "silver": lambda: batch.run_silver(
            spark, _pairs(args.bronze), args.weather, out, **window
        ),
        "core": lambda: batch.run_core(spark, out),
        "core-quality": lambda: batch.run_core_quality(spark, out),
        "clean": lambda: batch.run_clean(spark, out),
        "gold": lambda: batch.run_gold(spark, out),
        "gold-quality": lambda: batch.run_gold_quality(spark, out),
        "marts": lambda: batch.run_marts(spark, out, args.zones),
        "all": lambda: batch.run_all(
            spark, _pairs(args.bronze), args.weather, args.zones, out, **window
        ),
        "backfill": lambda: batch.run_backfill(
            spark, _pairs(args.bronze), args.weather, args.zones, out, args.month
        ),
        "train": lambda: _train(spark, args, out),
        "score": lambda: batch.run_score(spark, out, out("models/demand"), args.score_from),
        "publish": lambda: batch.run_publish(spark, out, args.warehouse),
        "validate": lambda: batch.run_validate(spark, out, args.warehouse),
        "produce": lambda: batch.run_produce(spark, args.source, out),
    }
    jobs[args.job]()


if __name__ == "__main__":
    main()
