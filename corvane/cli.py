"""python -m corvane.cli COMMAND ...: thin entry points."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="corvane")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("infer", help="recordings to embeddings and predictions, new files only")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--model", help="an ONNX file; without it the stand-in, which recognises nothing")
    p.add_argument("--classes", help="a JSON list of names")
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--files-per-batch", type=int, default=1000)
    p = sub.add_parser("timeseries", help="predictions (CSV) to smoothed daily series")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--ingested", action="store_true", help="the input is what infer wrote, not CSV files")
    p.add_argument("--site", action="store_true", help="the input is a site's predictions_partitioned; its other deployments are read too")
    p.add_argument("--threshold", type=float, default=0.0)
    p.add_argument("--top-species", type=int, default=15)
    p.add_argument("--smooth", type=int, default=4)
    p = sub.add_parser("export", help="what infer wrote, as wide CSV files of predictions and wide Parquet files of embeddings")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--embedding-size", type=int, default=1536)
    p.add_argument("--float16", action="store_true")
    p = sub.add_parser("parse-log", help="a launcher's log to a CSV of jobs and a summary")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    args = top.parse_args(argv)
    spark = SparkSession.builder.appName("corvane").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "infer":
        from corvane.plans import models
        from corvane.sources.tables import class_names
        from corvane.streaming.ingest import ingest

        names = [r["species"] for r in class_names(spark, args.classes).orderBy("idx").collect()] if args.classes else []
        path = args.model
        print(ingest(spark, args.input, args.output, (lambda: models.Onnx(path)) if path else models.StandIn, names, args.top, args.files_per_batch), "batches")
    elif args.command == "timeseries":
        from corvane.plans.timeseries import from_ingested, from_predictions
        from corvane.sources.tables import predictions, site_predictions

        options = (args.threshold, args.top_species, args.smooth)
        if args.ingested:
            series = from_ingested(spark.read.parquet(f"{args.input.rstrip('/')}/predictions"), *options)
        else:
            series = from_predictions(site_predictions(spark, args.input) if args.site else predictions(spark, args.input, lenient=True), *options)
        series.write.mode("overwrite").parquet(args.output)
    elif args.command == "export":
        from corvane.sources.tables import export_embeddings, export_predictions

        export_predictions(spark, args.input, f"{args.output}/predictions_partitioned", args.top)
        export_embeddings(spark, args.input, f"{args.output}/embeddings_partitioned", args.embedding_size, args.float16)
    else:
        from corvane.operators import joblog
        from corvane.sources.tables import job_log

        jobs = joblog.parse(job_log(spark, args.input))
        joblog.exported(jobs).coalesce(1).write.mode("overwrite").option("header", True).csv(args.output)
        print(json.dumps(joblog.summary(jobs).first().asDict(), default=str))


if __name__ == "__main__":
    main()
