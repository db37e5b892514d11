"""Command line: ``python -m malgeul COMMAND ...``.

correct        recogniser output to issues and available texts
export-review  issues to a workbook
import-review  an edited workbook to resolutions and final texts
results        recogniser output with triage and normalised texts
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from malgeul import schemas
from malgeul.operators import correct as fix, review
from malgeul.operators.triage import Percentiles
from malgeul.plans import label
from malgeul.sources import io


def _correct(spark: SparkSession, a: argparse.Namespace) -> str:
    made = fix.correct(io.read_jsonl(spark, a.input, schemas.ASR), percentiles=Percentiles(a.red, a.orange, a.yellow), context=a.context, texts=False)
    io.write_outputs(made, a.issues, a.available)
    return f"{spark.read.json(a.issues).count()} issues, {spark.read.json(a.available).count()} texts"


def _export(spark: SparkSession, a: argparse.Namespace) -> str:
    return f"{io.export_review(io.read_issues(spark, a.issues), a.workbook, a.candidates)} rows"


def _import(spark: SparkSession, a: argparse.Namespace) -> str:
    done = review.resolutions(io.import_review(spark, a.workbook))
    originals = None
    if a.transcripts:
        rows = io.read_jsonl(spark, a.transcripts, schemas.ASR).withColumn("text_raw", F.coalesce("text", "text_raw"))
        originals = review.original_texts(rows.withColumn("line_no", F.monotonically_increasing_id()))
    return "%d resolutions, %d texts" % io.write_resolutions(done, review.final_texts(done, originals), a.resolutions, a.finals)


def _results(spark: SparkSession, a: argparse.Namespace) -> str:
    rows = io.read_jsonl(spark, a.input, schemas.ASR).withColumn("text", F.coalesce("text", "text_raw"))
    return io.write_results(label.normalize_results(label.results(rows)), a.output, folder=a.folder)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="malgeul", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        c.set_defaults(run=run)
        for path in paths:
            c.add_argument(path)
        return c

    c = command("correct", _correct, "input", "issues", "available")
    for name, share in (("red", 0.03), ("orange", 0.15), ("yellow", 0.40)):
        c.add_argument(f"--{name}", type=float, default=share)
    c.add_argument("--context", type=int, default=40)
    command("export-review", _export, "issues", "workbook").add_argument("--candidates", type=int, default=5)
    command("import-review", _import, "workbook", "resolutions", "finals").add_argument("--transcripts")
    c = command("results", _results, "input")
    c.add_argument("--output")
    c.add_argument("--folder", default=".")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    print(a.run(spark or SparkSession.builder.appName("malgeul").getOrCreate(), a))


if __name__ == "__main__":
    main()
