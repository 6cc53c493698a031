"""Command line: the batch workflow, one subcommand per step.

    python -m blotter --warehouse W load-types crime_types.csv
    python -m blotter --warehouse W load-codes
    python -m blotter --warehouse W load-feed vancouver landed/van/ --load-id van-2020-01
    python -m blotter --warehouse W load-feed calgary snapshot/cal/ --load-id cal-2020-02 --mode replace
    python -m blotter --warehouse W load-feed edmonton landed/edm/ --places places.csv --load-id edm-1
    python -m blotter --warehouse W summaries            # incremental; --full rebuilds
    python -m blotter --warehouse W training
    python -m blotter --warehouse W train --model W/models/gbt
    python -m blotter --warehouse W score locations.csv --model W/models/gbt
    python -m blotter --warehouse W unmapped             # sub-types the type map misses, per city
    python -m blotter --warehouse W replay               # after load-types or a new gazetteer: only the records concerned
    python -m blotter --warehouse W compact incidents    # fold the layers that loads have left
    python -m blotter --warehouse W export crimes_yoy out/ --by city crime_type year
    python -m blotter --warehouse W vacuum crimes_yoy --keep 2

Every step reads and writes tables of the catalogue under ``--warehouse``
(a shared file system path on a cluster); nothing is collected except the
one RMSE number ``train`` prints.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .lookups import code_table_df, type_map_df
from .operators import feeds as FD
from .operators import locate as L
from .operators.joins import unique_lookup
from .plans import jobs as J
from .plans.replay import replay
from .schemas import (CALGARY_SCHEMA, EDMONTON_SCHEMA, GAZETTEER_SCHEMA, SOCRATA_INCIDENT_SCHEMA,
                      VANCOUVER_SCHEMA)
from .session import get_spark
from .sources import files as S
from .sources.catalog import Catalog
from .sources.ordered import write_ordered

SOCRATA_CITIES = ("ottawa", "victoria", "lethbridge")
FEEDS = ("vancouver", "calgary", "toronto", "edmonton") + SOCRATA_CITIES


def _type_map(cat: Catalog) -> DataFrame:
    """The loaded sub-type map, or the built-in one."""
    return cat.read("crime_type") if cat.exists("crime_type") else type_map_df(cat.spark)


def _read_table_file(spark: SparkSession, path: str, schema) -> DataFrame:
    if path.endswith(".csv"):
        return S.read_csv_with_header(spark, path, schema)
    return spark.read.parquet(path)


def _change(cat: Catalog, table: str) -> tuple[DataFrame, DataFrame] | None:
    """The last two versions of a lookup table, if there are as many."""
    known = cat.versions(table)
    return (cat.read(table, known[-2]), cat.read(table, known[-1])) if len(known) > 1 else None


def _gazetteer(cat: Catalog) -> DataFrame:
    if cat.exists("gazetteer"):
        return cat.read("gazetteer")
    return cat.spark.createDataFrame([], GAZETTEER_SCHEMA)


def load_feed(cat: Catalog, feed: str, path: str, load_id: str, json_layout: str | None,
              places: str | None, on_unmapped: str | None, mode: str = "merge") -> dict[str, str]:
    """``json_layout``: 'lines' (one record per line, splittable), 'document'
    (one JSON document per file) or None for the feed's usual layout."""
    if feed == "toronto" and on_unmapped:
        raise SystemExit("toronto brings its own types: --on-unmapped does not apply")
    spark, tm = cat.spark, _type_map(cat)
    kw = {"on_unmapped": on_unmapped} if on_unmapped else {}
    # a snapshot's rows are told apart by content; landed increments also by their file
    src = mode == "merge"

    def lines(default: bool) -> bool:
        return default if json_layout is None else json_layout == "lines"

    if feed == "vancouver":
        res = FD.adapt_vancouver(S.read_csv_with_header(spark, path, VANCOUVER_SCHEMA, source=src), tm, **kw)
    elif feed == "calgary":
        res = FD.adapt_calgary(S.read_records_json(spark, path, CALGARY_SCHEMA, lines(True), source=src), tm, **kw)
    elif feed == "toronto":
        res = FD.adapt_toronto(S.read_geojson_features(spark, path, lines(False), source=src))
    elif feed in SOCRATA_CITIES:
        res = FD.adapt_socrata(S.read_json_array(spark, path, SOCRATA_INCIDENT_SCHEMA, lines(False), source=src), tm, **kw)
    elif feed == "edmonton":
        if not places:
            raise SystemExit("edmonton needs --places (locality, lat, long)")
        pl = _read_table_file(spark, places, GAZETTEER_SCHEMA)
        res = FD.adapt_edmonton(S.read_all_string_records(spark, path, EDMONTON_SCHEMA, lines(True), source=src),
                                tm, _gazetteer(cat), pl, **kw)
    else:
        raise SystemExit(f"unknown feed {feed!r}; one of {', '.join(FEEDS)}")
    out = J.load_feed(cat, res, load_id, mode=mode)
    if res.gazetteer is not None:
        out["gazetteer"] = cat.write("gazetteer", res.gazetteer)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="blotter")
    ap.add_argument("--warehouse", required=True, help="catalogue root (shared path on a cluster)")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load-types")
    p.add_argument("csv")
    sub.add_parser("load-codes")
    p = sub.add_parser("load-feed")
    p.add_argument("feed", choices=FEEDS)
    p.add_argument("path")
    p.add_argument("--load-id", required=True)
    p.add_argument("--json-layout", choices=["lines", "document"], default=None)
    p.add_argument("--places", default=None)
    p.add_argument("--on-unmapped", choices=["keep", "drop", "reject"], default=None)
    p.add_argument("--mode", choices=["merge", "replace"], default="merge",
                   help="replace: the files are a whole snapshot of their cities")
    p = sub.add_parser("gazetteer")
    p.add_argument("records")
    p.add_argument("--places", required=True)
    p = sub.add_parser("summaries")
    p.add_argument("--full", action="store_true", help="rebuild from the whole table")
    sub.add_parser("training")
    p = sub.add_parser("train")
    p.add_argument("--model", required=True)
    p.add_argument("--max-iter", type=int, default=100)
    p.add_argument("--weighted", action="store_true", help="collapse identical rows into weighted rows")
    sub.add_parser("unmapped")
    sub.add_parser("replay", help="apply the last change of the type map and of the gazetteer to the stored records")
    p = sub.add_parser("compact")
    p.add_argument("table", nargs="?", default="incidents")
    p = sub.add_parser("export", help="write a table as files in order")
    p.add_argument("table")
    p.add_argument("path")
    p.add_argument("--by", nargs="+", required=True)
    p = sub.add_parser("vacuum")
    p.add_argument("table")
    p.add_argument("--keep", type=int, default=2)
    p = sub.add_parser("score")
    p.add_argument("locations")
    p.add_argument("--model", required=True)
    p.add_argument("--year", type=int, default=2020)
    args = ap.parse_args(argv)

    spark = spark or get_spark(args.master)
    cat = Catalog(spark, args.warehouse)
    if args.cmd == "load-types":
        print(cat.write("crime_type", unique_lookup(S.read_type_map_csv(spark, args.csv), "sub_type")))
    elif args.cmd == "load-codes":
        print(cat.write("crime_code", code_table_df(spark)))
    elif args.cmd == "load-feed":
        print(load_feed(cat, args.feed, args.path, args.load_id, args.json_layout, args.places,
                        args.on_unmapped, args.mode))
    elif args.cmd == "gazetteer":
        recs = S.read_all_string_records(spark, args.records)
        places = _read_table_file(spark, args.places, GAZETTEER_SCHEMA)
        print(cat.upsert("gazetteer", L.build_gazetteer(recs, places), ["locality"]))
    elif args.cmd == "summaries":
        print(J.rebuild_summaries(cat) if args.full else J.refresh_summaries(cat))
    elif args.cmd == "training":
        codes = cat.read("crime_code") if cat.exists("crime_code") else None
        print(J.build_training(cat, codes))
    elif args.cmd == "train":
        print({"rmse": J.train_model(cat, args.model, max_iter=args.max_iter, weighted=args.weighted)})
    elif args.cmd == "unmapped":
        print(cat.write("unmapped_subtypes", J.unmapped_report(cat)))
    elif args.cmd == "replay":
        print(replay(cat, types=_change(cat, "crime_type"), places=_change(cat, "gazetteer"), type_map=_type_map(cat)))
    elif args.cmd == "compact":
        done = cat.compact(args.table)
        print({"version": done["version"] if done else None})
    elif args.cmd == "export":
        write_ordered(cat.read(args.table), args.path, *args.by)
    elif args.cmd == "vacuum":
        print({"removed": cat.vacuum(args.table, keep=args.keep)})
    elif args.cmd == "score":
        locs = spark.read.option("header", True).csv(args.locations) if args.locations.endswith(".csv") \
            else spark.read.parquet(args.locations)
        locs = locs.selectExpr("cast(loc_id as bigint) loc_id", "address",
                               "cast(lat as double) lat", "cast(long as double) long")
        preds, unsupported = J.score(locs, args.model, year=args.year)
        print({"predictions": cat.write("predictions", preds),
               "unsupported": cat.write("unsupported_locations", unsupported)})
    return 0


if __name__ == "__main__":
    sys.exit(main())
