"""Runnable jobs: the reference's programs, plus the batch history.

    python -m playstream.plans.jobs events --games PATH... --out DIR
    python -m playstream.plans.jobs stats-stream --events DIR --out DIR --checkpoint DIR [--mode update --table DIR]
    python -m playstream.plans.jobs record --messages DIR --table DIR --checkpoint DIR
    python -m playstream.plans.jobs train --snapshots TABLE --models DIR
    python -m playstream.plans.jobs score-stream --messages DIR --models DIR --out DIR --checkpoint DIR
    python -m playstream.plans.jobs history --games PATH... --out TABLE

Streams default to a processing-time trigger (5 s statistics, 3 s scoring);
``--once`` processes what is available and stops.  Input and output each
have a connector of their own: ``--format kafka --option key=value`` reads a
bus, ``--out-format es --out-option key=value`` writes an index.
``--reference-names`` reads and writes the reference's field names.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playstream.operators import decode, normalize_events
from playstream.operators.labels import training_set
from playstream.operators.models import load_model, save_model, train_models
from playstream.plans.batch import history_snapshots
from playstream.schemas import EVENT, SNAP_RECORD, to_reference_names
from playstream.sinks import batch_writer, publish, record_snapshots, write_events
from playstream.sources import missing_games, read_games, read_snapshots, stream_events
from playstream.streaming import run_score_stream, run_stats_stream, watch

MESSAGE_SCHEMA = "key string, value string"


def _opts(pairs):
    return dict(p.split("=", 1) for p in pairs or [])


def _trigger(args, seconds: int) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": f"{seconds} seconds"}


def _messages(spark: SparkSession, args):
    """Messages of a directory, or of a bus from its earliest offset."""
    if args.format == "json":
        return spark.readStream.schema(MESSAGE_SCHEMA).json(args.messages)
    r = spark.readStream.format(args.format).option("startingOffsets", "earliest").options(**_opts(args.option))
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def _sink(args):
    """Writer of the job's output; a directory gets one folder a batch, replaced if the batch runs again."""
    if args.out_format in ("json", "parquet"):
        return batch_writer(args.out_format, args.out)
    return batch_writer(args.out_format, None, mode="append", idempotent=False, **_opts(args.out_option))


def _run(query, args) -> None:
    if args.once:
        query.awaitTermination()
    else:
        watch(query, lambda batch, rows: print(f"batch {batch}: {rows} rows", flush=True))


def events(spark, args):
    """Game documents -> normalised events, as a JSON-lines log or messages on a bus."""
    for path in missing_games(spark, args.games):
        print(f"skipped, not found: {path}", flush=True)
    ev = normalize_events(read_games(spark, args.games)).select(*EVENT.names)
    if args.out_format == "json":
        write_events(ev, args.out, mode="overwrite" if args.truncate else "append")
    else:
        publish(ev, fmt=args.out_format, **_opts(args.out_option))


def stats_stream(spark, args):
    """Events -> per-player statistics -> enriched snapshot messages."""
    src = stream_events(spark, args.events, fmt=args.format, max_per_trigger=args.max_per_trigger,
                        **_opts(args.option))
    _run(run_stats_stream(src, _sink(args), mode=args.mode, table=args.table, trigger=_trigger(args, 5),
                          checkpoint=args.checkpoint, shots=not args.no_shots, gap=args.gap,
                          reference_names=args.reference_names), args)


def record(spark, args):
    """Snapshot messages -> Parquet table partitioned by game, checkpointed."""
    snaps = decode(_messages(spark, args), SNAP_RECORD, reference_names=args.reference_names)
    game = "game_id"
    if args.reference_names:
        snaps, game = to_reference_names(snaps), "Partita"
    _run(record_snapshots(snaps, args.table, args.checkpoint, partition_by=(game,),
                          trigger={"availableNow": True} if args.once else None), args)


def train(spark, args):
    """Recorded snapshots -> training set -> win and MVP models."""
    snaps = read_snapshots(spark, args.snapshots, reference_names=args.reference_names).drop("shots")
    win, mvp = train_models(training_set(snaps), seed=args.seed)
    save_model(win, os.path.join(args.models, "win_model"))
    save_model(mvp, os.path.join(args.models, "mvp_model"))


def score_stream(spark, args):
    """Snapshot messages -> win% and MVP% documents."""
    win = load_model(os.path.join(args.models, "win_model"))
    mvp = load_model(os.path.join(args.models, "mvp_model"))
    _run(run_score_stream(_messages(spark, args), win, mvp, _sink(args), trigger=_trigger(args, 3),
                          checkpoint=args.checkpoint, reference_names=args.reference_names), args)


def history(spark, args):
    """Game documents -> enriched snapshot history as a game-partitioned table."""
    hist = history_snapshots(normalize_events(read_games(spark, args.games)), every=args.every)
    # same layout as the recorder's table: shot chart as JSON text
    hist = hist.withColumn("shots", F.to_json("shots")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SNAP_RECORD.fields])
    # one file a game: the rows are dealt by (game, snapshot) before
    hist.repartition("game_id").write.mode("overwrite").partitionBy("game_id").parquet(args.out)


JOBS = {"events": events, "stats-stream": stats_stream, "record": record, "train": train,
        "score-stream": score_stream, "history": history}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="playstream.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--format", default="json", help="connector of the input")
    source.add_argument("--option", action="append")
    sink = argparse.ArgumentParser(add_help=False)
    sink.add_argument("--out", help="directory of the output")
    sink.add_argument("--out-format", default="json", help="connector of the output")
    sink.add_argument("--out-option", action="append")
    names = argparse.ArgumentParser(add_help=False)
    names.add_argument("--reference-names", action="store_true", help="fields named as the reference's")
    stream = argparse.ArgumentParser(add_help=False, parents=[source, names])
    stream.add_argument("--checkpoint", required=True, help="folder of offsets and state, shared and kept")
    stream.add_argument("--once", action="store_true")
    p = sub.add_parser("events", parents=[sink])
    p.add_argument("--games", nargs="+", required=True)
    p.add_argument("--truncate", action="store_true")
    p = sub.add_parser("stats-stream", parents=[stream, sink])
    p.add_argument("--events")
    p.add_argument("--mode", default="complete", choices=["complete", "update", "sessions"])
    p.add_argument("--table")
    p.add_argument("--gap", help="silence after which a game's state leaves (mode sessions)")
    p.add_argument("--no-shots", action="store_true")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p = sub.add_parser("record", parents=[stream])
    p.add_argument("--messages")
    p.add_argument("--table", required=True)
    p = sub.add_parser("train", parents=[names])
    p.add_argument("--snapshots", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--seed", type=int, default=42)
    p = sub.add_parser("score-stream", parents=[stream, sink])
    p.add_argument("--messages")
    p.add_argument("--models", required=True)
    p = sub.add_parser("history")
    p.add_argument("--games", nargs="+", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--every", type=int, default=30)
    return ap


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        from playstream.session import get_session
        spark = get_session(os.environ.get("PLAYSTREAM_MASTER"), app=f"playstream-{args.job}")
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
