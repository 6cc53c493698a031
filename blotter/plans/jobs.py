"""End-to-end batch jobs over the table catalogue.

* :func:`load_feed`         -- adapter output -> incidents (one layer, merged by
  key on read) with its signed change of the summary cube + reject log.
* :func:`unmapped_report`   -- unmapped sub-types per city over all loads.
* :func:`rebuild_summaries` -- the five summary tables from one pre-aggregate.
* :func:`refresh_summaries` -- the same from the stored cube and the changes that
  the loads since have left; no incident is read.
* :func:`build_training`    -- feature table, written (cuts the lineage the
  model fit would otherwise replay each boosting round).
* :func:`train_model`       -- key split, GBT fit, hold-out RMSE, model saved.
* :func:`score`             -- batch scoring of a table of locations.

Lineage is cut only with ``checkpoint()`` into the shared
``spark.checkpoint.dir`` or with written tables; nothing is collected.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lookups import (CRIME_CODE_ROWS, DAYLIGHT_EXCLUDED_CITIES, HOUR_EXCLUDED_CITIES, SCORE_CODES,
                       SCORE_YEAR, SUMMARY_YEARS, code_table_df)
from ..operators import model as M
from ..operators import summaries as S
from ..operators.classify import reject_report
from ..operators.feeds import FeedResult
from ..session import ensure_checkpoint_dir
from ..sources.catalog import Catalog

SUMMARY_TABLES = ["crimes_yoy", "crimes_typ", "crimes_hr", "crimes_dl", "crimes_ss"]
CUBE_TABLE = "summary_cube"
UPTO = "upto"       # note of the stored cube: the last commit of the incident table that it holds


def load_feed(catalog: Catalog, result: FeedResult, load_id: str,
              table: str = "incidents", reject_table: str = "incident_rejects", mode: str = "merge") -> dict[str, str]:
    """Write one feed load. Kept rows become a layer of the incident table, merged
    by key (a re-run of the same load changes nothing); the commit holds the load's
    signed change of the summary cube, so :func:`refresh_summaries` needs neither
    the incidents nor a log of its own; rejects go to their own table by the same
    keys. Loads may run side by side. ``load_id`` names the load in messages only.

    ``mode``: ``merge`` (insert or replace by key) or ``replace`` (the feed is
    a whole snapshot: its cities are replaced, corrected and withdrawn records
    included)."""
    rows = result.shared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if mode == "replace":
            out = {"incidents": catalog.replace_partitions(table, result.kept, signed=S.signed_cube)}
        elif mode == "merge":
            out = {"incidents": catalog.merge_partitions(table, result.kept, ["uuid"], unique=result.key == "content", signed=S.signed_cube)}
        else:
            raise ValueError(f"unknown load mode {mode!r}")
        out["rejects"] = catalog.merge_partitions(reject_table, result.rejected_keyed, ["uuid"], unique=result.key == "content")
    finally:
        rows.unpersist()
    return out


def unmapped_report(catalog: Catalog, reject_table: str = "incident_rejects") -> DataFrame:
    """Unmapped sub-types per city across all loads."""
    rej = catalog.read(reject_table)
    return reject_report(rej.filter(rej["reason"] == "unmapped_type"))


def rebuild_summaries(catalog: Catalog, years=SUMMARY_YEARS, hour_exclude=HOUR_EXCLUDED_CITIES,
                      daylight_exclude=DAYLIGHT_EXCLUDED_CITIES, table: str = "incidents") -> dict[str, str]:
    """One scan + shuffle of the incident table builds the cube; it is
    checkpointed to the shared folder and the five tables are rebuilt whole
    from it (stale groups cannot survive a re-run)."""
    ensure_checkpoint_dir(catalog.spark)
    cube = S.summary_cube(catalog.read(table)).checkpoint(eager=True)
    outs = S.all_summaries(None, years, hour_exclude, daylight_exclude, cube=cube)
    return {name: catalog.write(name, outs[name]) for name in SUMMARY_TABLES}


def refresh_summaries(catalog: Catalog, years=SUMMARY_YEARS, hour_exclude=HOUR_EXCLUDED_CITIES,
                      daylight_exclude=DAYLIGHT_EXCLUDED_CITIES, table: str = "incidents") -> dict[str, str]:
    """Incremental form of :func:`rebuild_summaries`.

    SUM is additive, so the stored cube plus the signed changes that the commits
    since have left is the new cube: the cost follows the changes, and neither the
    incidents nor their folders are touched. The cube's note names the last commit
    it holds, so each change counts once, whatever loads or refreshes run side by
    side. The cube is built from the whole table on the first call, and where a
    commit left no change (the table was written by other means, or its manifest
    is vacuumed away).
    """
    layers = catalog.layered(table)
    now = layers.manifest()
    if now is None:
        raise FileNotFoundError(f"table {table!r} has no commit")
    upto = catalog.note(CUBE_TABLE).get(UPTO) if catalog.exists(CUBE_TABLE) else None
    notes = None
    if upto is not None:
        wanted = range(upto + 1, now["version"] + 1)
        if set(wanted) <= set(layers.log.versions()):
            notes = [layers.manifest(v)["change"] for v in wanted]
    if notes is None or any(n["delta"] is None and n["kind"] != "compact" for n in notes):
        cube = S.signed_cube(layers.read(now["version"]))
    else:
        paths = [n["delta"] for n in notes if n["delta"]]
        cube = catalog.read(CUBE_TABLE)
        if paths:
            cube = S.add_changes(cube, catalog.spark.read.schema(cube.schema).parquet(*paths))
    path = catalog.write(CUBE_TABLE, cube, note={UPTO: now["version"]})
    stored = S.plain_cube(catalog.spark.read.schema(cube.schema).parquet(path))
    outs = S.all_summaries(None, years, hour_exclude, daylight_exclude, cube=stored)
    written = {name: catalog.write(name, outs[name]) for name in SUMMARY_TABLES}
    written[CUBE_TABLE] = path
    return written


def build_training(catalog: Catalog, codes: DataFrame | None = None, table: str = "incidents",
                   out: str = "training") -> str:
    """The code table is broadcast: the inline one outright, a loaded one
    behind a row-count check (one row per crime type)."""
    if codes is None:
        feats = M.training_features(catalog.read(table), code_table_df(catalog.spark), broadcast="fixed")
    else:
        feats = M.training_features(catalog.read(table), codes, broadcast="planner")
    return catalog.write(out, feats)


def train_model(catalog: Catalog, model_path: str, train_pct: int = 60, table: str = "training",
                **params) -> float:
    """Fit on the content split of the written feature table; save; return RMSE."""
    feats = catalog.read(table)
    train, validation = M.content_split(feats, train_pct)
    model = M.fit(train, **params)
    rmse = M.evaluate_rmse(model.transform(validation))
    M.save_model(model, model_path, rmse=rmse)
    return rmse


def score(locations: DataFrame, model_path: str, codes=SCORE_CODES, year: int = SCORE_YEAR,
          id_col: str = "loc_id", address_col: str = "address") -> tuple[DataFrame, DataFrame]:
    """(predictions per location / year / type, unsupported locations)."""
    model = M.load_model(model_path)
    gated = M.gate_locations(locations, address_col)
    rows = [r for r in CRIME_CODE_ROWS if r[0] in set(codes)]
    preds = M.score_locations(gated.filter("supported"), model, rows, id_col=id_col, year=year)
    return preds, gated.filter(~gated["supported"])
