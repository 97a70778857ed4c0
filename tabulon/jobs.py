"""Command-line jobs for spark-submit: ``python -m tabulon.jobs <job> ...``."""

from __future__ import annotations

import argparse

from tabulon.ml import best_trials, evaluate_model, refit, search, trials_table
from tabulon.plans.churn import ROW_KEY, labelled, split_dataset, to_bronze, to_gold, to_silver
from tabulon.plans.reading_log import ReadingLogPaths, log_rows, publish_official, refresh, save_override
from tabulon.schemas import BOARD_OVERRIDES, CHURN_CATEGORICAL, CHURN_NUMERIC, READING_OVERRIDES, READINGS
from tabulon.session import build_session
from tabulon.sources.readers import read_csv
from tabulon.sources.versions import read_version


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tabulon.jobs", description=__doc__)
    jobs = out.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=text)
        for a in arguments:
            p.add_argument(a)
        return p

    job("bronze", "copy raw customers into the first layer", "source", "bronze")
    job("silver", "clean the raw layer", "bronze", "silver")
    job("gold", "split, train, evaluate and store the model", "silver", "gold")
    tune = job("tune", "search every registered model and evaluate the best", "silver")
    tune.add_argument("--search", choices=["grid", "random"], default="grid")
    tune.add_argument("--n-iter", type=int, default=20)
    tune.add_argument("--cv", type=int, default=5)
    official = job("official", "clean a price sheet: a workbook, a folder of them, or a CSV export", "sheet", "target")
    official.add_argument("--sheet-name", help="sheet of the workbooks (needed for a folder)")
    outputs = ("reading_overrides", "board_overrides", "official", "dataset", "json_export", "public_export")
    again = job("refresh", "derive the reading log and write its exports", "readings", *outputs)
    again.add_argument("--stored", action="store_true", help="the readings are the dataset of an earlier run")
    build = job("build", "build the log from metadata, readings and places (Parquet)", "dumps", "recognised", "places", *outputs)
    build.add_argument("--previous", help="dataset of an earlier run whose rows are reused")
    build.add_argument("--force", action="store_true", help="build every row anew")
    correct = job("correct", "put corrections into an override table", "corrections", "current", "target")
    correct.add_argument("--board", action="store_true", help="corrections of board prices")
    return out


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(f"tabulon-{a.job}")
    if a.job == "bronze":
        to_bronze(spark, a.source, a.bronze)
    elif a.job == "silver":
        to_silver(spark, a.bronze, a.silver)
    elif a.job == "gold":
        to_gold(spark, a.silver, a.gold)[1].show()
    elif a.job == "tune":
        train, test = split_dataset(labelled(read_version(spark, a.silver)))
        trials = search(train, [ROW_KEY], CHURN_NUMERIC, CHURN_CATEGORICAL, a.search, n=a.n_iter, cv=a.cv)
        trials_table(spark, trials).orderBy("rank").show(len(trials), truncate=False)
        best = max(best_trials(trials).values(), key=lambda t: t.mean_score)
        print(best.family, best.settings, evaluate_model(refit(best, train, CHURN_NUMERIC, CHURN_CATEGORICAL), test))
    elif a.job == "official":
        publish_official(spark, a.sheet, a.target, a.sheet_name)
    elif a.job == "correct":
        schema = BOARD_OVERRIDES if a.board else READING_OVERRIDES
        save_override(spark, read_csv(spark, a.corrections, schema, multi_line=True), a.current, a.target, a.board)
    else:
        paths = ReadingLogPaths(
            a.reading_overrides, a.board_overrides, a.official, a.dataset, a.json_export, a.public_export
        )
        if a.job == "build":
            previous = spark.read.parquet(a.previous) if a.previous else None
            dumps, recognised, places = (spark.read.parquet(p) for p in (a.dumps, a.recognised, a.places))
            refresh(spark, log_rows(dumps, recognised, places, previous, a.force), paths)
        elif a.stored:
            stored = spark.read.parquet(a.readings)
            refresh(spark, stored, paths, dict(stored.dtypes)["notes"].startswith("array"))
        else:
            refresh(spark, read_csv(spark, a.readings, READINGS), paths, notes_are_array=False)


if __name__ == "__main__":
    main()
