"""Command line: python -m tonality <stage> ...

  preprocess CSV OUT [--mode compat|strict|splits]
  train PROCESSED MODEL_DIR TEST_OUT [--encoder E] [--split-by row_id|content_id]
  grid PROCESSED OUT_DIR [--encoder E]
  predict MODEL_DIR TEST PREDICTIONS_OUT [--kind logreg|forest]
  score MODEL_DIR TEXTS OUT [--kind K] [--text-column C] [--encoder E]
  stream MODEL_DIR DIRECTORY OUT CHECKPOINT [--kind K] [--encoder E]
  report PREDICTIONS OUT_DIR
  all CSV WORK_DIR [--mode compat|strict|splits]

An encoder is ``hashed`` (the default), ``hashed:<dim>``, or ``module:function``:
a function without arguments that returns an encoder, i.e. a function from the
processed text (a column) to an array of floats (see ``batch_encoder``).

The session comes from spark-submit (or a local one when run directly).
"""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession

from . import jobs
from .operators.scoring import Encoder, hashed_encoder
from .session import remove_scratch


def encoder_of(name: str) -> Encoder:
    module, _, rest = name.partition(":")
    if module == "hashed":
        return hashed_encoder(int(rest)) if rest else hashed_encoder()
    if not rest:
        raise ValueError(f"an encoder is 'hashed', 'hashed:<dim>' or 'module:function', got {name!r}")
    return getattr(import_module(module), rest)()


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tonality")
    sub = ap.add_subparsers(dest="stage", required=True)

    def stage(name: str, *places: str, mode=False, kind=False, encoder=False) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for place in places:
            p.add_argument(place)
        if mode:
            p.add_argument("--mode", default="compat", choices=["compat", "strict", "splits"])
        if kind:
            p.add_argument("--kind", default="logreg", choices=["logreg", "forest"])
        if encoder:
            p.add_argument("--encoder", default="hashed")
        return p

    stage("preprocess", "csv", "out", mode=True)
    stage("train", "processed", "model_dir", "test_out", encoder=True).add_argument(
        "--split-by", default=jobs.ROW_ID, choices=[jobs.ROW_ID, jobs.CONTENT_ID]
    )
    stage("grid", "processed", "out_dir", encoder=True)
    stage("predict", "model_dir", "test", "out", kind=True)
    stage("score", "model_dir", "texts", "out", kind=True, encoder=True).add_argument("--text-column", default="text")
    stage("stream", "model_dir", "directory", "out", "checkpoint", kind=True, encoder=True)
    stage("report", "predictions", "out_dir")
    stage("all", "csv", "work_dir", mode=True)
    return ap


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tonality-{args.stage}").getOrCreate()
    try:
        run_stage(spark, args)
    finally:
        remove_scratch(spark)


def run_stage(spark: SparkSession, args: argparse.Namespace) -> None:
    encoder = encoder_of(args.encoder) if "encoder" in args else None
    if args.stage == "preprocess":
        jobs.preprocess_job(spark, args.csv, args.out, args.mode)
    elif args.stage == "train":
        jobs.train_job(spark, args.processed, args.model_dir, args.test_out, encoder=encoder, split_by=args.split_by)
    elif args.stage == "grid":
        print(jobs.grid_job(spark, args.processed, args.out_dir, encoder=encoder).first().asDict())
    elif args.stage == "predict":
        acc = jobs.predict_job(spark, args.model_dir, args.test, args.out, args.kind).first()
        print(f"accuracy {acc['accuracy']:.4f} over {acc['n']} rows")
    elif args.stage == "score":
        jobs.score_job(spark, args.model_dir, args.texts, args.out, args.kind, args.text_column, encoder)
    elif args.stage == "stream":
        jobs.stream_job(spark, args.model_dir, args.directory, args.out, args.checkpoint, args.kind, encoder)
    elif args.stage == "report":
        for path in jobs.report_job(spark, args.predictions, args.out_dir):
            print(path)
    else:
        for path in jobs.run_all(spark, args.csv, args.work_dir, args.mode):
            print(path)


if __name__ == "__main__":
    main()
