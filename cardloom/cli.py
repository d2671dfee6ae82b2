"""python -m cardloom.cli: run all stages, or extract pages, cut them into cards, expand phones, merge, enrich, export, compare, show status."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import fixed, text
from .operators import compare, enrich, layout, merge, phones, state
from .sources import files, sinks


def cut(spark: SparkSession, args: argparse.Namespace) -> None:
    """Result pages to cards."""
    sinks.write_cards(layout.cards(files.good_pages(spark, args.input)), args.output)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Result pages to contacts and failures of whole pages, as CSV; fields come from the lines."""
    pages = files.pages(spark, args.input)
    sinks.write_pages(pages.withColumn("extracted", text.extracted("line_texts", text.PAGE)), args.output)


def enriched(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cards (Parquet with card_key, line_texts, extracted) through --provider; answers are appended to the output, those there are not asked again."""
    work = spark.read.parquet(*args.input)
    done = files.parquet_if_there(spark, args.output, "card_key string, error string")
    enrich.standardise(work, done, enrich.provider_at(args.provider), args.model).write.mode("append").parquet(args.output)


def exported(spark: SparkSession, args: argparse.Namespace) -> None:
    """Chain A's phone rows and chain B's stored answers (Parquet) to chain B's phone rows and statistics."""
    a, standard = (spark.read.parquet(p) for p in args.input)
    if "error" in standard.columns:
        standard = standard.where("error IS NULL")
    sheets = compare.export_sheets(a, phones.phone_rows_outer(standard, args.model), standard)
    for name, rows in sheets.items():
        rows.write.mode("overwrite").parquet(f"{args.output}/{name}")
    if args.workbook:
        sinks.write_workbook({n: spark.read.parquet(f"{args.output}/{n}") for n in sheets}, args.workbook)


def expand(spark: SparkSession, args: argparse.Namespace) -> None:
    """Contacts (CSV) to one row per mobile, as Parquet."""
    phones.phone_rows(files.csv_rows(spark, args.input, None)).write.mode("overwrite").parquet(args.output)


def merged(spark: SparkSession, args: argparse.Namespace) -> None:
    """Parquet phone rows of labelled partitions (label=path) to one table and a summary."""
    parts = dict(p.split("=", 1) for p in args.input)
    rows = merge.merged({label: spark.read.parquet(path) for label, path in parts.items()})
    rows.write.mode("overwrite").parquet(f"{args.output}/phone_processed")
    dim = merge.partition_dim(spark, [(path, label) for label, path in parts.items()])
    merge.summary(spark.read.parquet(f"{args.output}/phone_processed"), dim).write.mode("overwrite").parquet(f"{args.output}/summary")


def compared(spark: SparkSession, args: argparse.Namespace) -> None:
    """Phone rows of chains A and B (Parquet with an ord column) to a report."""
    a, b = (spark.read.parquet(p) for p in args.input)
    sheets = compare.compared(a, b).sheets()
    for name, rows in sheets.items():
        rows.write.mode("overwrite").parquet(f"{args.output}/{name}")
    if args.workbook:
        sinks.write_workbook({n: spark.read.parquet(f"{args.output}/{n}") for n in sheets}, args.workbook)


def status(spark: SparkSession, args: argparse.Namespace) -> None:
    """State of the inputs listed in a Parquet table by the run log in another."""
    inputs, log = (spark.read.parquet(p) for p in args.input)
    state.status(inputs, log.select(*[F.col(c.split()[0]) for c in schemas.RUN_LOG.split(", ")])).orderBy("run").show(1000, False)


def _stages(args: argparse.Namespace) -> dict[str, tuple]:
    """Stages of a run in turn: the command, its input and its place below the output."""
    out = args.output
    found = {
        "extract": (extract, [f"{args.input[0]}/*.jsonl"], "pages"),
        "cut": (cut, [f"{args.input[0]}/*.jsonl"], "cards"),
        "expand": (expand, [f"{out}/cards/ocr_card_contacts.csv"], "a"),
    }
    if args.provider:
        found |= {"enrich": (enriched_cards, [f"{out}/cards/ocr_card_results.jsonl"], "answers"), "export": (exported, [f"{out}/a", f"{out}/answers"], "b"), "compare": (compared_chains, [f"{out}/a", f"{out}/b/{fixed.PHONE_SHEET}"], "report")}
    return found


def enriched_cards(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cards with text (JSON lines) through --provider, as enriched() does."""
    own = files.json_lines(spark, args.input, schemas.CARD).where("has_text").drop("ord")
    labels = {"source_label": F.lit(args.label), "source_dataset": F.lit(fixed.DATASET), "rule_extracted": F.col("extracted")}
    work = own.withColumns(labels).withColumn("card_key", text.card_key("source_label", "file", "page", "card_no"))
    done = files.parquet_if_there(spark, args.output, "card_key string, error string")
    enrich.standardise(work, done, enrich.provider_at(args.provider), args.model).drop("extracted").write.mode("append").parquet(args.output)


def compared_chains(spark: SparkSession, args: argparse.Namespace) -> None:
    """Both chains' phone rows as a run writes them; their order is that of cards and numbers."""
    order = F.struct("file", F.col("page").cast("int"), F.col("card_no").cast("int"), "phone_normalized")
    a, b = (spark.read.parquet(p) for p in args.input)
    sides = [(a if "source_label" in a.columns else a.withColumn("source_label", F.lit(args.label))).withColumn("ord", order), b.withColumn("ord", order)]
    for name, rows in compare.compared(*sides).sheets().items():
        rows.write.mode("overwrite").parquet(f"{args.output}/{name}")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """All stages of a folder of result pages in turn, those of chain B with a --provider.

    The log in the output remembers the stages that ended well for the folder's files as they are; these are skipped. A stage that fails
    is logged with its error and ends the run, and the next run begins with it; changed files start anew.
    """
    mark = files.inputs(spark, args.input[0], ["jsonl"]).agg(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(F.xxhash64("input_fingerprint").cast("decimal(38,0)")), F.lit(0)).cast("string"))).first()[0]
    place = f"{args.output}/run_log"
    stages = _stages(args)
    began = spark.range(1).select(text.utc_now()).first()[0]
    for name, (command, source, target) in stages.items():
        log = files.parquet_if_there(spark, place, schemas.RUN_LOG)
        unit = spark.createDataFrame([(args.input[0], mark, name)], "run string, input_fingerprint string, unit string")
        if state.pending_units(unit, log).isEmpty():
            continue
        error = None
        try:
            command(spark, argparse.Namespace(**vars(args) | {"input": source, "output": f"{args.output}/{target}", "workbook": None}))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"[:2000]
            raise
        finally:
            result = unit.withColumns({"ok": F.lit(error is None), "error": F.lit(error).cast("string")})
            state.logged(result).write.mode("append").parquet(place)
    total = spark.createDataFrame([(args.input[0], mark, len(stages))], "run string, input_fingerprint string, total_units long")
    found = state.status(total, spark.read.parquet(place)).first()
    sinks.write_json_atomically({"run": args.input[0], "input_fingerprint": mark, "status": found["status"], "stages": list(stages), "started_at": began}, f"{args.output}/run.json")


COMMANDS = {"run": run, "cut": cut, "extract": extract, "enrich": enriched, "export": exported, "expand": expand, "merge": merged, "compare": compared, "status": status}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cardloom", description=__doc__)
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("input", nargs="+")
    parser.add_argument("--output", default="out")
    parser.add_argument("--workbook", help="also write the report as one workbook")
    parser.add_argument("--provider", help="import path of the callable that asks the service, as in package.module:function")
    parser.add_argument("--label", default="", help="label of the partition that the input is")
    parser.add_argument("--model", default="", help="name of the model that rows are marked with")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"cardloom {args.command}").config("spark.sql.legacy.javaCharsets", "true").getOrCreate()
    COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    main()
