"""Command line over the library, mirroring the original tool's scripts.

  python -m cohortlens profile  --events E.csv --mortality M.csv [--out DIR]
  python -m cohortlens samples  --events E.csv --mortality M.csv --out DIR
  python -m cohortlens train    --samples DIR --model DIR [--eta --mu --epochs --shards --file-order | --gd --steps]
  python -m cohortlens evaluate --samples DIR --model DIR [--version N] [--out DIR]

Inputs are headerless CSV (events: patientid, eventid, eventdesc,
timestamp, value; mortality: patientid, timestamp, label) and SVMLight
text folders as written by ``samples``. Results are written as parquet
(or text for samples) when ``--out`` is given, else printed in full, streamed
to the terminal partition by partition. ``train`` is one pass of SGD unless
``--gd`` asks for full-batch descent.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import (
    auc,
    check_feature_range,
    confusion_counts,
    roc_points,
    score,
    train_gd,
    train_sgd,
    with_sample_id,
)
from cohortlens.operators.split import train_test_split
from cohortlens.plans import build_samples, cohort_profile
from cohortlens.plans.sample_build import release
from cohortlens.session import checkpoint_dir
from cohortlens.sources import file_order, load_model, read_events_checked, read_mortality_checked, read_svmlight, save_model


def _emit(df: DataFrame, out: str | None, name: str) -> None:
    if out:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return
    print(f"== {name}")
    print("\t".join(df.columns))
    for row in df.toLocalIterator():  # every row, one partition at a time
        print("\t".join("" if v is None else str(v) for v in row))


def _size(max_index) -> int:
    """Number of features from the largest index (None: no feature)."""
    return 0 if max_index is None else int(max_index) + 1


def _samples_with_id(spark: SparkSession, path: str) -> DataFrame:
    """One reproducible id per line: a hash of the line and a number that
    tells equal lines apart, whatever the files and splits."""
    return with_sample_id(read_svmlight(spark, path), "line", None)


def _inputs(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """Events and mortality rows; with ``--rejects`` the lines that do not
    fit are written there."""
    events, mortality = read_events_checked(spark, args.events), read_mortality_checked(spark, args.mortality)
    if args.rejects:
        for name, rows in (("events", events), ("mortality", mortality)):
            rows.where("bad_record is not null").select("bad_record").write.mode("overwrite").text(f"{args.rejects}/{name}")
    return events.drop("bad_record"), mortality.drop("bad_record")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cohortlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("profile", "samples"):
        s = sub.add_parser(name)
        s.add_argument("--events", required=True)
        s.add_argument("--mortality", required=True)
        s.add_argument("--out", required=(name == "samples"))
        s.add_argument("--rejects", help="folder for the input lines that do not fit their schema")
    t = sub.add_parser("train")
    t.add_argument("--samples", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--eta", type=float, default=0.01)
    t.add_argument("--mu", type=float, default=0.0)
    t.add_argument("--steps", type=int, default=20)
    t.add_argument("--gd", action="store_true", help="full-batch gradient descent (--steps) instead of SGD")
    t.add_argument("--epochs", type=int, default=1, help="SGD passes over the samples")
    t.add_argument("--shards", type=int, help="SGD shards; 1 is the sequential pass, default by the sample count")
    t.add_argument("--file-order", action="store_true", help="take the samples of a shard in the order of their lines")
    t.add_argument("--rule", choices=("textbook", "as_coded"), default="textbook")
    e = sub.add_parser("evaluate")
    e.add_argument("--samples", required=True)
    e.add_argument("--model", required=True)
    e.add_argument("--version", type=int, help="model version; default the latest complete one")
    e.add_argument("--out")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"cohortlens-{args.cmd}").getOrCreate()
    checkpoint_dir(spark)
    if args.cmd == "profile":
        res = cohort_profile(*_inputs(spark, args))
        _emit(res["metrics"], args.out, "metrics")
        _emit(res["common_codes"].orderBy("cohort", "code_class", "rank"), args.out, "common_codes")
    elif args.cmd == "samples":
        built = build_samples(*_inputs(spark, args))
        print(train_test_split(built["samples"], f"{args.out}/training", f"{args.out}/testing"))
        built["event_map"].write.mode("overwrite").parquet(f"{args.out}/event_map")
        release(built)
    elif args.cmd == "train":
        data = with_sample_id(file_order(spark, args.samples), "line", None) if args.file_order else _samples_with_id(spark, args.samples)
        n_feature = _size(data.select(F.explode("x").alias("e")).agg(F.max("e.i")).first()[0])
        if args.gd:
            w = train_gd(data, args.steps, args.eta, args.mu, rule=args.rule)
        else:
            w = train_sgd(data, n_feature, args.eta, args.mu, args.shards, args.epochs, rule=args.rule,
                          order_col="position" if args.file_order else None)
        print(f"saved version {save_model(w, args.model, args.eta, args.mu, n_feature, args.rule)}")
    else:
        weights, params = load_model(spark, args.model, args.version)
        data = _samples_with_id(spark, args.samples)
        check_feature_range(data, params["n_feature"])
        scored = score(data, weights).persist()
        try:
            _emit(auc(scored), args.out, "auc")
            _emit(confusion_counts(scored), args.out, "confusion")
            _emit(roc_points(scored).orderBy("fpr", "tpr"), args.out, "roc")
        finally:
            scored.unpersist()


if __name__ == "__main__":
    main()
