"""Command-line entry points for the whole jobs (run with spark-submit or python -m).

  flights  --weather W.csv --flights F.csv --out DIR [--legacy-text] [--legacy-text-max] [--lower-case-flag]
  mail     FILE.csv --out DIR --run-date YYYY-MM-DD [--last-only-edges] [--multi-line]
  search   --docs PARQUET --host H --name N --out DIR [--from TS] [--to TS] [--analyzed] [--size N]
  copy     --docs PARQUET --run-date YYYY-MM-DD --host-today H [--host-yesterday H2]
           [--existing PARQUET] --out DIR
  copy-table --source TABLE --target TABLE --run-date YYYY-MM-DD --host-today H [--host-yesterday H2]
  prepare  --train T.csv --test T.csv --out DIR [--lookup PARQUET]
  blend    A.csv B.csv ... --out DIR [--weights 0.7,0.3] [--gzip]
  train    --data PARQUET --features a,b,c --label y --id id --out DIR [--valid-share 0.2] [--seed 15]

Every job reads and writes through Spark; nothing but small summaries reaches the driver.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import functions as F

from tessera.session import get_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="job", required=True)

    f = sub.add_parser("flights")
    f.add_argument("--weather", required=True)
    f.add_argument("--flights", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--legacy-text", action="store_true")
    f.add_argument("--legacy-text-max", action="store_true")
    f.add_argument("--lower-case-flag", action="store_true")

    m = sub.add_parser("mail")
    m.add_argument("path")
    m.add_argument("--out", required=True)
    m.add_argument("--run-date", required=True)
    m.add_argument("--last-only-edges", action="store_true")
    m.add_argument("--multi-line", action="store_true")

    s = sub.add_parser("search")
    s.add_argument("--docs", required=True)
    s.add_argument("--host", required=True)
    s.add_argument("--name", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--from", dest="from_ts")
    s.add_argument("--to", dest="to_ts")
    s.add_argument("--analyzed", action="store_true")
    s.add_argument("--size", type=int, help="first so many hits; all without it")

    c = sub.add_parser("copy")
    c.add_argument("--docs", required=True)
    c.add_argument("--run-date", required=True)
    c.add_argument("--host-today", required=True)
    c.add_argument("--host-yesterday")
    c.add_argument("--existing")
    c.add_argument("--out", required=True)

    k = sub.add_parser("copy-table")
    k.add_argument("--source", required=True, help="table with a folder a day (day=yyyy-mm-dd)")
    k.add_argument("--target", required=True)
    k.add_argument("--run-date", required=True)
    k.add_argument("--host-today", required=True)
    k.add_argument("--host-yesterday")

    r = sub.add_parser("prepare")
    r.add_argument("--train", required=True)
    r.add_argument("--test", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--lookup")

    b = sub.add_parser("blend")
    b.add_argument("paths", nargs="+")
    b.add_argument("--out", required=True)
    b.add_argument("--weights")
    b.add_argument("--gzip", action="store_true")

    t = sub.add_parser("train")
    t.add_argument("--data", required=True)
    t.add_argument("--features", required=True)
    t.add_argument("--label", required=True)
    t.add_argument("--id", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--valid-share", type=float, default=0.2)
    t.add_argument("--seed", type=int, default=15)
    return p


def main(argv: Sequence[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(app=f"tessera-{args.job}")
    if args.job == "flights":
        from tessera.plans import flights
        from tessera.sources.files import read_lines

        result = flights.run_job(
            read_lines(spark, args.weather),
            read_lines(spark, args.flights),
            args.out,
            legacy_text_max=args.legacy_text_max,
            legacy_text=args.legacy_text,
            lower_case_flag=args.lower_case_flag,
        )
    elif args.job == "mail":
        from tessera.plans import mail

        result = mail.run_job(spark, args.path, args.out, args.run_date, args.last_only_edges, args.multi_line)
    elif args.job == "search":
        from tessera.plans import logs

        hits = logs.search(
            spark.read.parquet(args.docs), args.host, args.name, args.from_ts, args.to_ts, args.analyzed, args.size
        )
        hits.write.mode("overwrite").parquet(args.out)
        result = {"hits": args.out}
    elif args.job == "copy":
        from tessera.plans import logs
        from tessera.session import path_exists

        docs = spark.read.parquet(args.docs)
        target = f"{args.out.rstrip('/')}/{logs.target_name('copy', args.run_date)}"
        existing = [spark.read.parquet(args.existing).select("target_day", "_id")] if args.existing else []
        if path_exists(spark, target):  # create only: what the target holds is never written again
            existing.append(spark.read.parquet(target).select("target_day", "_id"))
        known = existing[0] if existing else None
        for more in existing[1:]:
            known = known.unionByName(more)
        new = logs.daily_copy(docs, args.run_date, args.host_today, args.host_yesterday or args.host_today, known)
        new.write.mode("append").parquet(target)
        result = {"target": target}
    elif args.job == "copy-table":
        from tessera.plans import logs

        run = logs.copy_day(spark, args.source, args.target, args.run_date, args.host_today, args.host_yesterday or args.host_today)
        result = {"target": args.target, "run": run}
    elif args.job == "prepare":
        from tessera.plans import features

        result = features.prepare(spark, args.train, args.test, args.out, lookup_path=args.lookup)
    elif args.job == "blend":
        from tessera.plans import blending

        weights = [float(w) for w in args.weights.split(",")] if args.weights else None
        result = blending.run_job(spark, args.paths, args.out, weights=weights, compression="gzip" if args.gzip else None)
    else:  # train
        from tessera.functions.scalars import hash_unit
        from tessera.operators import metrics, model, tabular

        data = spark.read.parquet(args.data)
        feats = args.features.split(",")
        train, valid = tabular.holdout_split(data, args.id, args.valid_share, args.seed)
        train = train.withColumn("_is_valid", hash_unit(args.id, args.seed + 1) < F.lit(0.1))  # stops the boosting early
        fitted = model.train(train, feats, args.label, validation_col="_is_valid")
        model.score(fitted, valid, args.id).write.mode("overwrite").parquet(f"{args.out}/valid_scores")
        scored = spark.read.parquet(f"{args.out}/valid_scores").join(valid.select(args.id, args.label), args.id)
        auc = metrics.auc_exact(scored, args.label, "score").first()["auc"]
        fitted.write().overwrite().save(f"{args.out}/model")
        result = {"model": f"{args.out}/model", "valid_scores": f"{args.out}/valid_scores", "valid_auc": auc}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
