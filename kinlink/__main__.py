"""Command line: train a model from TSV files, or write both result files with one.

    python -m kinlink train   --source1 F --source2 F --source3 F --truth F --model DIR [--model-type histgb|xgboost]
    python -m kinlink predict --source1 F --source2 F --source3 F --model DIR --output DIR [--threshold 0.8]

Files have the columns entity_id, business_name, business_address, country; truth has source1_entity_id, matched_entity_ids. Run it with
spark-submit on a cluster, spark.checkpoint.dir naming a folder that all executors share.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.operators.datasets import explode_truth
from kinlink.plans.model import MODEL_TYPES, THRESHOLD, load_model, save_model
from kinlink.plans.resolver import EntityResolver
from kinlink.sources.paths import path_resolve
from kinlink.sources.tsv import scan_tsv, sink_tsv, with_positions


def _arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinlink", description="Record linkage over TSV files")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("train", "predict"):
        c = sub.add_parser(name)
        for k in (1, 2, 3):
            c.add_argument(f"--source{k}", required=True)
        c.add_argument("--model", required=True)
        c.add_argument("--multiline", action="store_true", help="fields may hold line breaks; a file is then read by one task")
        if name == "train":
            c.add_argument("--truth", required=True)
            c.add_argument("--model-type", choices=sorted(MODEL_TYPES), default="histgb")
            c.add_argument("--rounds", type=int, help="boosting rounds, other than the type's own")
        else:
            c.add_argument("--output", required=True)
            c.add_argument("--threshold", type=float, default=THRESHOLD)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Runs a command; what was done is printed as one JSON line and returned."""
    a = _arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName("kinlink").getOrCreate()
    began = time.time()

    def source(path: str) -> DataFrame:
        return with_positions(scan_tsv(spark, path_resolve(spark, [path]), multiline=a.multiline))

    tables = [source(x) for x in (a.source1, a.source2, a.source3)]
    if a.command == "train":
        truth = explode_truth(scan_tsv(spark, path_resolve(spark, [a.truth]), multiline=a.multiline))
        more = {"maxIter": a.rounds} if a.rounds else {}
        r = EntityResolver(model_type=a.model_type).fit(*tables, truth.select("s1_id", "target_id").distinct(), **more)
        save_model(r.model, a.model, r.summary)
        done = dict(r.summary)
    else:
        model, about = load_model(spark, a.model)
        out = EntityResolver(threshold=a.threshold, model=model, summary=about).transform(*tables)
        done = {}
        for name, rows in out.items():
            sink_tsv(rows, f"{a.output}/{name}")
            done[name] = scan_tsv(spark, f"{a.output}/{name}").agg(F.count("*")).first()[0]
    done |= {"command": a.command, "seconds": round(time.time() - began, 1)}
    print(json.dumps(done))
    return done


if __name__ == "__main__":
    main()
