"""Command line: ``python -m gristmill <workload> ...`` or through ``spark-submit``.

The session comes from the launcher's configuration; nothing about it is set here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from gristmill import plans, presets, sources
from gristmill.operators import text


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gristmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, summary: str, formats=sorted(sources.READERS)):
        sub = commands.add_parser(name, help=summary)
        sub.add_argument("--input", required=True, help="path of the table")
        sub.add_argument("--format", default="tsv", choices=formats)
        sub.add_argument("--quarantine", help="where damaged rows of delimited text are written")
        sub.add_argument("--multiline", action="store_true", help="line breaks in quoted fields")
        return sub

    command("profile", "features present, their summary and gaps")

    prepare = command("prepare", "standardised feature vectors of the plausible rows")
    prepare.add_argument("--out", required=True)
    prepare.add_argument("--sample-out")
    prepare.add_argument("--target", type=int, default=presets.SAMPLE_TARGET)

    train = command("train", "choose k by silhouette, save the model and its predictions")
    train.add_argument("--model-out", required=True)
    train.add_argument("--columns", help="comma-separated columns to train on; default: the preset and its bounds")
    train.add_argument("--predictions-out")
    train.add_argument("--report-out")
    train.add_argument("--sample-out")
    train.add_argument("--max-rows", type=int, help="train on a sample of so many rows; default: all")
    train.add_argument("--refit", action="store_true", help="fit the chosen k again on the raw rows")
    train.add_argument("--fast", action="store_true", help="fewer k and iterations, sampled scores")
    train.add_argument("--save-each", action="store_true")

    inspect = command("inspect", "label rows with a saved model and describe the clusters")
    inspect.add_argument("--model", required=True)
    inspect.add_argument("--parse", choices=["strict", "lenient"], help="read numbers from text")
    inspect.add_argument("--predictions-out")
    inspect.add_argument("--centers-out")

    words = command("words", "word counts of a text column")
    words.add_argument("--column", required=True)
    words.add_argument("--separator", help="default: white space")
    words.add_argument("--out", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"gristmill-{args.command}").getOrCreate()
    options = {"multiline": True} if args.multiline else {}
    df = plans.load_export(spark, args.input, args.format, quarantine=args.quarantine, **options)

    if args.command == "profile":
        found = plans.profile_table(df)
        print("columns used:", found.mapping)
        for part in (found.rows, found.summary, found.nulls, found.ids):
            part.show(truncate=80)
    elif args.command == "prepare":
        plans.prepare_features(df, args.out, args.sample_out, target=args.target)
    elif args.command == "train":
        sweep = presets.FAST_SWEEP if args.fast else presets.FULL_SWEEP
        trained = plans.train_clusters(
            df,
            args.model_out,
            args.predictions_out,
            args.report_out,
            args.sample_out,
            max_rows=args.max_rows,
            refit=args.refit,
            save_each=args.save_each,
            **({"cols": args.columns.split(","), "bounds": {}} if args.columns else {}),
            **sweep,
        )
        trained.sweep.scores.show()
        print("silhouette of the saved model:", trained.final_silhouette)
        trained.final_sizes.show()
    elif args.command == "inspect":
        found = plans.inspect_clusters(
            df, args.model, args.predictions_out, args.centers_out, parse=args.parse
        )
        print("silhouette:", found.silhouette)
        for part in (found.sizes, found.examples, found.centers):
            part.show(100, truncate=80)
    else:
        text.word_count(df, args.column, args.separator).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
