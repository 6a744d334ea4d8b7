"""Command line for the pipeline steps."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from paddock import jobs

SPLIT_YEARS = ("train_end", "val_years", "test_years")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="paddock")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *folders: str, splits: bool = False) -> argparse.ArgumentParser:
        one = steps.add_parser(name.replace("_", "-"))
        one.set_defaults(job=getattr(jobs, name), folders=folders)
        for folder in folders:
            one.add_argument(f"--{folder.replace('_', '-')}", required=True)
        if splits:
            one.add_argument("--train-end", type=int)
            one.add_argument("--val-years", type=int, nargs="*")
            one.add_argument("--test-years", type=int, nargs="*")
        return one

    toy = step("generate_toy", "lake_dir")
    for option in ("seasons", "rounds", "drivers"):
        toy.add_argument(f"--{option}", type=int)
    step("ingest", "raw_dir", "lake_dir")
    step("validate", "lake_dir")
    step("register", "lake_dir").add_argument("--database")
    step("sql", "lake_dir").add_argument("--text", required=True)
    step("test", "lake_dir", "marts_dir")
    step("build", "lake_dir", "marts_dir").add_argument(
        "--unique-qualifying", action="store_true"
    )
    step("export_features", "marts_dir", "output_dir", splits=True)
    train = step("train", "marts_dir", "models_dir", splits=True)
    train.add_argument("--name", choices=("top10", "dnf"), required=True)
    train.add_argument("--trees", type=int)
    train.add_argument("--depth", type=int)
    train.add_argument("--run")
    step("evaluate", "marts_dir", "models_dir", "reports_dir", splits=True)
    step("report", "marts_dir", "reports_dir", splits=True).add_argument(
        "--with-targets", action="store_true"
    )
    predict = step("predict", "marts_dir", "models_dir", splits=True)
    predict.add_argument("--year", type=int)
    predict.add_argument("--race-id", type=int)
    predict.add_argument("--output")
    predict.add_argument("--kind", choices=("csv", "json"))
    from_csv = step("predict_csv", "csv_path", "models_dir")
    from_csv.add_argument("--output")
    batch = step("predict_batch", "marts_dir", "models_dir", splits=True)
    batch.add_argument("--years", type=int, nargs="*")
    batch.add_argument("--output-dir")
    return top


def main(arguments: list[str] | None = None) -> None:
    given = vars(parser().parse_args(arguments))
    job = given.pop("job")
    given = {k: v for k, v in given.items() if v is not None and k not in ("step", "folders")}
    spark = SparkSession.builder.appName(f"paddock {job.__name__}").getOrCreate()
    result = job(spark, **given)
    for table in result.values() if isinstance(result, dict) else [result]:
        table.show(30, truncate=False)


if __name__ == "__main__":
    main()
