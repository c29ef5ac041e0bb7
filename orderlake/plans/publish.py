"""Gold writes and publishing.

Layout under a warehouse root (a shared folder):

* ``tables/<name>/snapshot=<run_id>/`` — one snapshot per dimension and run (a
  retry of a run that wasn't published replaces its own folder);
* ``tables/fact_sales/version=<run>-<id>/run_id=<part>/`` — the fact, one part per
  run, with all orders that the run brought; nothing in it is ever rewritten;
* ``tables/fact_sales/index``, ``…/deletes`` — which part has which order, and which
  orders of a part aren't shown (``orderlake.plans.versions``);
* ``tables/fact_sales/partials`` — the reports' sums of each part (``orderlake.plans.partials``);
* ``_manifest/<number>.json`` — the commits (``orderlake.plans.commits``): pointers
  (table, run_id, path, rows, seq, part).  What is current of a dimension, or of a part of
  the fact, is its pointer of the highest commit.  One commit re-points the dimensions and
  all parts of a publish together; of two publishers, the second merges again.

An order has one row in the published fact: of the versions that the runs have now, the one with the
largest ordering tuple (``_best``, as the dimensions use), whatever the order in which
runs arrive or are repeated, and whatever a repeated run no longer brings.

Every write observes its own row count (``DataFrame.observe``): one job per
table instead of a count job plus a write job.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlake.config import drop_path
from orderlake.functions.names import qualified_name
from orderlake.operators.dedupe import BEST
from orderlake.plans import commits, partials, versions
from orderlake.plans.commits import Conflict
from orderlake.plans.partials import partials_of
from orderlake.plans.versions import Parts, deletes_of, index_of
from orderlake.schemas import DIMENSIONS, FACTS, GOLD_TABLES
from orderlake.sources import warehouse
from orderlake.sources.warehouse import Connector

RUN_COL = "run_id"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Warehouse:
    root: str
    database: str | None = None  # when set, declared catalog tables are re-pointed too
    index_buckets: int = 64      # hash buckets of the order index, for the life of the warehouse

    def table_dir(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def snapshot_path(self, name: str, run_id: str) -> str:
        return f"{self.table_dir(name)}/snapshot={run_id}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifest"

    def key_map(self, name: str) -> str:
        return f"{self.root}/_keymaps/{name}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                dynamic: bool = False) -> int:
    """Write Parquet and return the rows written (observed during the write)."""
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "zstd")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    rows = int(obs.get["rows"])
    log.info("wrote %d rows to %s (mode=%s)", rows, path, mode)  # A1: counted by the write itself
    return rows


# --------------------------------------------------------------------- manifest

def manifest(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return commits.pointers(spark, wh.manifest)


def manifest_entries(spark: SparkSession, wh: Warehouse) -> list[tuple]:
    """All pointers (tbl, run_id, path, rows, seq, part).

    Metadata, not data: one row per table and changed part per publishing run, read
    once per publish and resolved on the driver.
    """
    return [tuple(r) for r in manifest(spark, wh).collect()]


def _latest(entries: list[tuple]) -> int:
    """The last commit."""
    return max((e[4] for e in entries), default=0)


def manifest_version(spark: SparkSession, wh: Warehouse) -> int:
    return _latest(manifest_entries(spark, wh))


def _current(entries: list[tuple]) -> dict[str, tuple[str, str, int]]:
    best: dict[str, tuple] = {}
    for tbl, run_id, path, rows, seq, _ in entries:
        if tbl not in best or seq > best[tbl][3]:
            best[tbl] = (run_id, path, rows, seq)
    return {t: v[:3] for t, v in best.items()}


def current_versions(spark: SparkSession, wh: Warehouse) -> dict[str, tuple[str, str, int]]:
    """tbl -> (run_id, path, rows) of the published version."""
    return _current(manifest_entries(spark, wh))


def published_runs(spark: SparkSession, wh: Warehouse, name: str) -> list[str]:
    """Runs of a fact table that passed publishing (bounded by the number of runs)."""
    return sorted({e[5] for e in manifest_entries(spark, wh) if e[0] == name})


class Changes(list):
    """Pointers (tbl, run_id, path, rows, part) to commit; part is None for a dimension.

    ``base`` is the commit that they were worked out from.
    """

    def __init__(self, entries: list[tuple], base: int):
        super().__init__(entries)
        self.base = base


def _point(spark: SparkSession, wh: Warehouse, entries: Changes) -> None:
    """Commit the pointers as one; ``Conflict`` if there is a commit after their base.

    Pointing to what is current already is a no-op.
    """
    known = manifest_entries(spark, wh)
    if _latest(known) != entries.base:
        raise Conflict(f"{wh.root} has commits after {entries.base}")
    current = _current(known)
    fresh = [e for e in entries if e[4] is not None or current.get(e[0], (None, None))[:2] != (e[1], e[2])]
    seq = entries.base + 1
    if fresh:
        commits.commit(spark, wh.manifest, seq, fresh)
    known += [(t, r, p, n, seq, part) for t, r, p, n, part in fresh]
    for t in dict.fromkeys(e[0] for e in entries if e[0] in GOLD_TABLES):
        qualified = qualified_name(t, wh.database) if wh.database else None
        if not (qualified and table_exists(spark, qualified)):
            open_table(spark, wh, t, known).createOrReplaceTempView(t)
        elif t in FACTS:
            _point_declared_fact(spark, wh, t, qualified, known, {e[4] for e in entries if e[4] is not None})
        else:
            run_statement(spark, f"ALTER TABLE {qualified} SET LOCATION '{current_path(known, t)}'")
            run_statement(spark, f"REFRESH TABLE {qualified}")


def current_path(entries: list[tuple], name: str) -> str:
    return _current(entries)[name][1]


def _point_declared_fact(spark: SparkSession, wh: Warehouse, name: str, table: str, entries: list[tuple],
                         changed: set[str]) -> None:
    """The declared table's partitions of the changed parts now read their shown rows.

    Catalog readers know nothing of delete files, so a part with hidden rows gets a copy without them.
    """
    parts = Parts.of(entries, name)
    paths = {p: parts.data[p][0] for p in changed if p in parts.shown}
    copied = sorted(p for p in paths if p in parts.deletes)
    if copied:
        folder = f"{wh.table_dir(name)}/shown={uuid.uuid4().hex[:8]}"
        (read_fact_parts(spark, wh, parts, copied, name).sortWithinPartitions(RUN_COL, "date_key", "order_id")
         .write.partitionBy(RUN_COL).parquet(folder))
        paths |= {p: f"{folder}/{RUN_COL}={p}" for p in copied}
    for p in sorted(changed):
        partition = f"PARTITION ({RUN_COL} = '{p}')"
        run_statement(spark, f"ALTER TABLE {table} DROP IF EXISTS {partition}")
        if p in paths:
            run_statement(spark, f"ALTER TABLE {table} ADD {partition} LOCATION '{paths[p]}'")
    run_statement(spark, f"REFRESH TABLE {table}")


def _publish(spark: SparkSession, wh: Warehouse, merge: Callable[[], Changes]) -> Changes:
    """Merge and commit; after losing to another publisher, merge again with what it published."""
    while True:
        changes = merge()
        try:
            _point(spark, wh, changes)
            return changes
        except Conflict as lost:
            log.info("%s: merging again", lost)


def run_statement(spark: SparkSession, sql: str) -> DataFrame:
    """Run one SQL statement (DDL / publish) in the session."""
    return spark.sql(sql)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup; real errors propagate instead of meaning "no"."""
    return spark.catalog.tableExists(name)


def open_table(spark: SparkSession, wh: Warehouse, name: str, entries: list[tuple] | None = None) -> DataFrame:
    """The published version of a gold table."""
    entries = manifest_entries(spark, wh) if entries is None else entries
    cols = GOLD_TABLES[name].column_names
    if name in FACTS:
        parts = Parts.of(entries, name)
        if not any(e[0] == name for e in entries):
            raise KeyError(f"{name} has not been published under {wh.root}")
        return read_fact_parts(spark, wh, parts, parts.shown, name).select(*cols)
    current = _current(entries)
    if name not in current:
        raise KeyError(f"{name} has not been published under {wh.root}")
    return spark.read.parquet(current[name][1]).select(*cols)


def read_current_snapshot(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame | None:
    """The published dimension snapshot with its hidden state columns (None before the first publish)."""
    v = current_versions(spark, wh).get(name)
    return None if v is None else spark.read.parquet(v[1])


# --------------------------------------------------------------------- dimensions

def stage_dimension(wh: Warehouse, name: str, df: DataFrame, run_id: str) -> tuple[str, int]:
    """X3 part 1: write this run's snapshot (idempotent: same run -> same folder)."""
    path = wh.snapshot_path(name, run_id)
    hidden = [c for c in df.columns if c.startswith("_")]  # merge state kept beside the declared columns
    return path, write_table(df.select(*GOLD_TABLES[name].column_names, *hidden), path)


def load_dimension(spark: SparkSession, wh: Warehouse, name: str, df: DataFrame, run_id: str) -> int:
    """Stage the snapshot, then swap the pointer (first publish simply creates it)."""
    path, rows = stage_dimension(wh, name, df, run_id)
    _publish(spark, wh, lambda: Changes([(name, run_id, path, rows, None)], manifest_version(spark, wh)))
    return rows


# --------------------------------------------------------------------- fact

def load_fact(spark: SparkSession, wh: Warehouse, fact: DataFrame, run_id: str,
              name: str = "fact_sales") -> int:
    """Publish this run's fact rows; a replay replaces what the run brought before.

    Returns how many of the run's rows are shown.
    """
    staged = stage_fact(spark, wh, fact, run_id, name)
    changes = _publish(spark, wh, lambda: merge_fact(spark, wh, staged, run_id, name))
    return _shown_rows(changes, name, run_id)


def _shown_rows(changes: list[tuple], name: str, run_id: str) -> int:
    return Parts.of([(*e[:4], 0, e[4]) for e in changes], name).live(run_id)


@dataclass(frozen=True)
class Staged:
    """A run's part of the fact, written and not published yet: its files, row count and index (None without rows)."""

    rows: DataFrame
    path: str
    n: int
    index: str | None


def stage_fact(spark: SparkSession, wh: Warehouse, fact: DataFrame, run_id: str, name: str = "fact_sales") -> Staged:
    """Write the run's part with its ordering tuple, and its index, where they stay once published.

    A fact without ``_best`` is ordered by its date, then by its other columns.
    """
    cols = GOLD_TABLES[name].column_names
    if BEST not in fact.columns:
        rest = [c for c in cols if c not in ("order_id", "date_key")]
        fact = fact.withColumn(BEST, F.struct("date_key", *rest))
    path = f"{wh.table_dir(name)}/version={run_id}-{uuid.uuid4().hex[:8]}/{RUN_COL}={run_id}"
    # Sorted by date within each file: Parquet min/max statistics then let
    # date-range reports skip row groups (a local sort, no extra shuffle).
    n = write_table(fact.select(*cols, BEST).sortWithinPartitions("date_key", "order_id"), path)
    rows = spark.read.parquet(path)
    index = versions.write_index(rows, wh.table_dir(index_of(name)), run_id, wh.index_buckets) if n else None
    return Staged(rows, path, n, index)


def unstage_fact(spark: SparkSession, staged: Staged) -> None:
    """Drop a part that wasn't published."""
    for path in (staged.path, staged.index):
        if path:
            drop_path(spark, path)


def _fact_files(spark: SparkSession, wh: Warehouse, paths: list[str], name: str, state: StructType | None = None) -> DataFrame:
    """The rows in some parts' files, with ``run_id`` (their part) and, if its type is given, ``_best``."""
    fields = [*GOLD_TABLES[name].schema.fields, *([StructField(BEST, state, True)] if state else []),
              StructField(RUN_COL, StringType(), True)]
    if not paths:
        return spark.createDataFrame([], StructType(fields))
    return (spark.read.schema(StructType(fields)).option("basePath", wh.table_dir(name))
            .parquet(*paths).select(*[f.name for f in fields]))


def read_fact_parts(spark: SparkSession, wh: Warehouse, parts: Parts, names: list[str], name: str = "fact_sales") -> DataFrame:
    """The shown rows of some parts, with ``run_id``.  Only parts with hidden rows meet their delete files."""
    hiding = [p for p in names if p in parts.deletes]
    clean = _fact_files(spark, wh, [parts.data[p][0] for p in names if p not in parts.deletes], name)
    if not hiding:
        return clean
    hidden = versions.read_deletes(spark, wh.table_dir(deletes_of(name)), {p: parts.deletes[p] for p in hiding})
    rest = _fact_files(spark, wh, [parts.data[p][0] for p in hiding], name).join(hidden, ["order_id", RUN_COL], "left_anti")
    return rest if len(hiding) == len(names) else clean.unionByName(rest)


def merge_fact(spark: SparkSession, wh: Warehouse, staged: Staged, run_id: str,
               name: str = "fact_sales") -> Changes:
    """Write the delete files and partials that the staged part changes; returns the pointers to them and to the part."""
    entries = manifest_entries(spark, wh)
    parts = Parts.of(entries, name)
    index = wh.table_dir(index_of(name))
    state = staged.rows.schema[BEST].dataType

    def read_parts(names: list[str]) -> DataFrame:
        return _fact_files(spark, wh, [parts.data[p][0] for p in names], name, state).select("order_id", RUN_COL, BEST)

    settled = versions.settle(spark, staged.rows, run_id, parts, index, wh.table_dir(deletes_of(name)), read_parts,
                              BEST, staged.index)
    sums = _merge_partials(spark, wh, staged.rows, run_id, name, parts, settled)
    for path in settled.scratch:
        drop_path(spark, path)
    log.info("fact %s: run %s brought %d rows, %d delete files changed", name, run_id, staged.n, len(settled.deletes))
    return Changes([(name, run_id, staged.path, staged.n, run_id),
                    (index_of(name), run_id, staged.index or index, staged.n, run_id),
                    *[(deletes_of(name), run_id, path, n, p) for p, (path, n) in settled.deletes.items()],
                    *[(partials_of(name), run_id, path, n, p) for p, (path, n) in sums.items()]], _latest(entries))


def _merge_partials(spark: SparkSession, wh: Warehouse, staged: DataFrame, run_id: str, name: str, parts: Parts,
                    settled: versions.Settled) -> dict[str, tuple[str, int]]:
    """The partials of the run's part and of the parts whose shown rows change: part -> (path, rows)."""
    hidden = settled.deletes.get(run_id, parts.deletes.get(run_id, ("", 0)))
    own = staged.select(*partials.FACT_COLUMNS)
    if hidden[1]:
        gone = versions.read_deletes(spark, wh.table_dir(deletes_of(name)), {run_id: hidden}).select("order_id")
        own = own.join(gone, "order_id", "left_anti")
    others = {p: parts.partials[p] for p in settled.deletes if p != run_id and p in parts.partials}
    moved = None
    if others:
        turned = settled.moved.select("order_id", RUN_COL, (-F.col("_n")).alias(partials.SIGN))
        moved = (_fact_files(spark, wh, [parts.data[p][0] for p in others], name)
                 .select(RUN_COL, *partials.FACT_COLUMNS).join(turned, ["order_id", RUN_COL]))
    return partials.write_partials(spark, wh.table_dir(partials_of(name)), run_id, own, moved, others)


# --------------------------------------------------------------------- all

def load_all(spark: SparkSession, wh: Warehouse, tables: dict[str, DataFrame], run_id: str,
             gate=None, base: int | None = None) -> dict[str, int]:
    """Stage every dimension and the fact, run the gate, then re-point them together.

    When ``gate`` (a callable returning failing check rows) reports failures, no pointer
    moves.  A run that is published already changes nothing.  ``base`` is the commit whose tables
    ``tables`` were made from: if another publisher commits after it, ``Conflict`` is raised and
    they must be made again.  Without it, the tables replace whatever is published.
    """
    known = manifest_entries(spark, wh)
    current = _current(known)
    staged = {}
    for n in DIMENSIONS:
        done = current.get(n)
        if done is not None and done[0] == run_id:  # a repeated run: already published, keep it
            staged[n] = (done[1], done[2])
        else:
            staged[n] = stage_dimension(wh, n, tables[n], run_id)
    published = {n: Parts.of(known, n) for n in tables if n in FACTS and any(e[0] == n and e[5] == run_id for e in known)}
    facts = {n: stage_fact(spark, wh, tables[n], run_id, n) for n in tables if n in FACTS and n not in published}
    if gate is not None:
        failures = gate({n: spark.read.parquet(p) for n, (p, _) in staged.items()},
                        {n: f.rows.drop(BEST) for n, f in facts.items()}, {n: r for n, (_, r) in staged.items()})
        if failures:
            for f in facts.values():
                unstage_fact(spark, f)
            raise ValueError(f"quality gate failed, nothing published: {failures}")

    def merge() -> Changes:
        changes = Changes([(n, run_id, p, r, None) for n, (p, r) in staged.items()],
                          manifest_version(spark, wh) if base is None else base)
        for n, f in facts.items():
            merged = merge_fact(spark, wh, f, run_id, n)
            changes += merged
            changes.base = merged.base if base is None else base
        return changes

    if base is None:
        changes = _publish(spark, wh, merge)
    else:
        changes = merge()
        try:
            _point(spark, wh, changes)
        except Conflict:  # the tables are made again
            for f in facts.values():
                unstage_fact(spark, f)
            raise
    for n in published:  # a crash may have come between the commit and the catalog
        table = qualified_name(n, wh.database) if wh.database else None
        if table and table_exists(spark, table):
            entries = manifest_entries(spark, wh)
            _point_declared_fact(spark, wh, n, table, entries, {
                e[5] for e in entries if e[1] == run_id and e[0] in (n, deletes_of(n))})
    return {**{n: r for n, (_, r) in staged.items()}, **{n: p.live(run_id) for n, p in published.items()},
            **{n: _shown_rows(changes, n, run_id) for n in facts}}


def publish_to_connector(spark: SparkSession, wh: Warehouse, conn: Connector, prefix: str = "",
                         tables: list[str] | None = None) -> dict[str, int]:
    """X5 to an outside warehouse: the published version of every table through ``conn``.

    Each table is written whole to ``<prefix><table>_staging`` and then to its own name, so
    a failed transfer leaves the target as it was.  Returns the rows sent.
    """
    entries = manifest_entries(spark, wh)
    sent = {}
    for n in tables or GOLD_TABLES:
        df = open_table(spark, wh, n, entries)
        warehouse.write_table(df, conn, f"{prefix}{n}_staging")
        obs = Observation()
        warehouse.write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), conn, f"{prefix}{n}")
        sent[n] = int(obs.get["rows"])
    return sent
