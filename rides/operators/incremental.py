"""High-water-mark incremental load with upsert on a unique key.

``upsert`` is the pure DataFrame form: rows of ``batch`` newer than the
target's newest ``mark_col`` are loaded, and target rows whose key arrives
again are replaced (delete + insert). Semantics kept from the source rule:

* the comparison is strict, so rows at the mark or earlier (late rows) are
  skipped; ``lookback`` widens the window to re-read late rows, which the key
  match makes idempotent;
* rows repeated inside one batch are all inserted by ``upsert`` (the unique
  check reports them) unless ``repeated="last"`` asks for the last writer;
  ``IncrementalTable.load`` takes the last writer, so that its key is unique;
* rows without a key never match and are never taken for one another;
* an empty target has no mark; it is treated as "load everything" rather
  than the SQL outcome of loading nothing.

``IncrementalTable`` persists the result as versions of a Parquet table
partitioned by trip month (``rides.sources.versions``) and writes only the
months a batch touches. Bloom filters of each month's keys
(``rides.operators.key_filter``) tell which other months can hold a key that
arrives again, so no other month is read.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rides.operators import key_filter as KF, row_marks as M
from rides.session import together
from rides.sources import parquet as PQ, versions as V


NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _folder(month: str | None) -> str:
    return NULL_MONTH if month is None else month


def high_water_mark(target: DataFrame, mark_col: str):
    """Newest value of ``mark_col`` as a Python scalar (one small aggregate).
    Collected so the batch filter is a literal that Spark can push into the
    scan and use for partition pruning."""
    return target.agg(F.max(mark_col).alias("m")).first()["m"]


def new_rows(batch: DataFrame, mark, mark_col: str = "start_ts",
             lookback: dt.timedelta | None = None) -> DataFrame:
    if mark is None:
        return batch
    cutoff = mark - lookback if lookback else mark
    return batch.where(F.col(mark_col) > F.lit(cutoff).cast(batch.schema[mark_col].dataType))


def replaced(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Target rows whose key does not arrive again, plus the new rows. The
    anti join needs only the new keys; adaptive execution broadcasts them
    where their measured size allows it."""
    return target.join(new.select(key), on=key, how="left_anti").unionByName(new)


def _one(columns: list[str]):
    """The columns as one value to compare; a single column stays itself, whose
    maximum Spark takes without a sort."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def last_writer(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row of each key: the greatest by ``order``, ties by the values of the
    whole row. Rows without a key all stay. The maximum is taken before the
    shuffle too, so a key repeated very often does not meet in one task."""
    names = [c for c in rows.columns if c != key]
    keyed = (rows.where(F.col(key).isNotNull()).groupBy(key)
                 .agg(F.max(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)),
                                     F.struct(*names).alias("row"))).alias("last"))
                 .select(*(F.col("last.row")[c].alias(c) if c != key else F.col(key) for c in rows.columns)))
    return keyed.unionByName(rows.where(F.col(key).isNull()))


def upsert(target: DataFrame, batch: DataFrame, key: str = "ride_id", mark_col: str = "start_ts",
           lookback: dt.timedelta | None = None, mark=None, repeated: str = "all",
           order: list[str] | None = None) -> DataFrame:
    """Target rows not replaced, plus the batch rows past the mark: all of them,
    or with ``repeated="last"`` the last writer of each key by ``order``
    (default: the mark column)."""
    if repeated not in ("all", "last"):
        raise ValueError(f"repeated must be all or last, not {repeated!r}")
    if mark is None:
        mark = high_water_mark(target, mark_col)
    new = new_rows(batch, mark, mark_col, lookback)
    if repeated == "last":
        new = last_writer(new, key, order or [mark_col])
    return replaced(target, new, key)


class IncrementalTable:
    """Month-partitioned, versioned Parquet table maintained by an upsert.

    ``path`` must be on storage every executor can read and write. A load
    writes its rows once to a staging folder (they are then fixed), the new
    content of the months it touches to a snapshot folder, the key filters of
    these months beside it, and puts the next version in force. Stopped
    anywhere before that, it has changed nothing; the next load starts from
    the version in force.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "ride_id",
                 mark_col: str = "start_ts"):
        self.spark, self.path, self.key, self.mark_col = spark, path.rstrip("/"), key, mark_col
        self.filters = f"{self.path}/_filters"

    def version(self) -> dict | None:
        return V.current(self.path)

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, schema, months: list[str] | None = None) -> DataFrame:
        """The version in force; the DataFrame stays on it whatever is loaded."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], PQ.with_month_field(schema))
        return V.read(self.spark, self.path, schema, version, months)

    def mark(self, schema=None):
        """The high-water mark of the version in force."""
        version = self.version()
        return dt.datetime.fromisoformat(version["mark"]) if version and version["mark"] else None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the files that none of the ``keep`` newest versions reads."""
        gone = V.vacuum(self.path, keep)
        for snap in gone:
            PQ.delete_dir(f"{self.filters}/{V.SNAP_COL}={snap}")
        return gone

    def _write(self, rows: DataFrame, schema, before: dict, touched: list[str], facts: dict,
               at_most: dict[str, int]) -> dict:
        """Write a snapshot of ``rows`` and its filters; publish the version in
        which it takes the place of the ``touched`` months. ``at_most`` bounds
        the rows of each month, which sizes its filter."""
        snap = V.new_snapshot()
        folder = f"{self.path}/{V.SNAP_COL}={snap}"
        PQ.write_trips_by_month(rows, folder, source_col=self.mark_col)
        months = {m: snap for m in PQ.partition_values(folder)} if PQ.path_exists(folder) else {}
        written = V.read(self.spark, self.path, schema, {"months": months})

        def write_filters():
            if sizes:
                (KF.build_filters(written.select(self.key, PQ.MONTH_COL), self.key, sizes)
                   .write.partitionBy(PQ.MONTH_COL).parquet(f"{self.filters}/{V.SNAP_COL}={snap}"))

        sizes = {m: at_most[m] for m in months if m != NULL_MONTH}
        counts, _ = together(
            written.groupBy(PQ.MONTH_COL).agg(F.count(F.lit(1)).alias("n")).collect, write_filters)
        blocks = {m: KF.blocks_for(n) for m, n in sizes.items()}
        rows_of = {_folder(r[PQ.MONTH_COL]): r["n"] for r in counts}

        def merged(name, new):
            kept = {m: v for m, v in before.get(name, {}).items() if m not in touched}
            return {**kept, **new}

        return V.publish(self.path, {"months": merged("months", months), "rows": merged("rows", rows_of),
                                     "blocks": merged("blocks", blocks), **facts})

    def _months_hit(self, new: DataFrame, n_new: int, version: dict, schema,
                    others: set[str]) -> tuple[set, list[str]]:
        """Months among ``others`` that hold a key of ``new``, and the months
        whose key column had to be read to tell."""
        asked = {m: s for m, s in version["months"].items() if m in others and m in version["blocks"]}
        folders = [f"{self.filters}/{V.SNAP_COL}={s}/{PQ.MONTH_COL}={m}" for m, s in asked.items()]
        folders = [f for f in folders if PQ.path_exists(f)]         # none for a month without keys
        if not folders:
            return set(), []
        filters = (self.spark.read.schema(f"{KF.FILTER}, {V.SNAP_COL} string, {PQ.MONTH_COL} string")
                       .option("basePath", self.filters).parquet(*folders))
        keys = new.select(self.key)
        may = KF.months_that_may_hold(keys, self.key, filters, sorted({version["blocks"][m] for m in asked}),
                                      n_new)
        if not may:
            return set(), []
        held = (V.read(self.spark, self.path, schema, version, may).select(self.key, PQ.MONTH_COL)
                 .join(keys, self.key, "left_semi").select(PQ.MONTH_COL).distinct())
        return {r[0] for r in held.collect()}, may

    def load(self, batch: DataFrame, full_refresh: bool = False,
             lookback: dt.timedelta | None = None, every_row: bool = False,
             order: list[str] | None = None, epoch: tuple[str, int] | None = None) -> dict:
        """Apply one staged batch (``stg_trips`` columns). Returns a summary:
        mode, the mark before, the months written, and ``months_read``, those
        that were read only to look for keys.

        Of rows that repeat a key the last by ``order`` (default: the mark
        column; columns that begin with an underscore are not stored) is taken.
        ``every_row`` upserts rows at or before the mark too. ``epoch`` (source,
        number) makes a batch that was applied already a no-op."""
        version = None if full_refresh else self.version()
        epochs = dict((version or {}).get("epochs", {}))
        if epoch:
            if version and epochs.get(epoch[0], -1) >= epoch[1]:
                return {"mode": "replayed", "mark": self.mark(), "months": [], "months_read": []}
            epochs[epoch[0]] = epoch[1]
        mark = dt.datetime.fromisoformat(version["mark"]) if version and version["mark"] else None
        extra = [c for c in order or [] if c.startswith("_")]
        rows = batch if every_row or version is None else new_rows(batch, mark, self.mark_col, lookback)
        staging = f"{self.path}/_staging/{uuid.uuid4().hex}"
        try:
            staged = self._staged(rows, f"{staging}/rows")
            order = order or [self.mark_col]
            repeated, found = together(lambda: self._repeated(staged, order, f"{staging}/repeated"),
                                       lambda: self._months_of(staged))
            if repeated is not None:
                staged = self._last(staged, repeated, order, sum(r["n"] for r in found), staging)
                found = self._months_of(staged)
            new = staged.drop(*extra)
            return self._apply(new, found, new.schema, version, mark, epochs, staging)
        finally:
            PQ.delete_dir(staging)

    def _staged(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _repeated(self, rows: DataFrame, order: list[str], path: str) -> DataFrame | None:
        """Keys that stand more than once among staged rows, with the greatest
        ``order`` of each (``_top``), None without any. Only keys and order are
        shuffled."""
        keys = self._staged(rows.where(F.col(self.key).isNotNull()).groupBy(self.key)
                                .agg(F.count(F.lit(1)).alias("_n"), F.max(_one(order)).alias("_top"))
                                .where("_n > 1").select(self.key, "_top"), path)
        return None if keys.isEmpty() else keys

    def _last(self, rows: DataFrame, repeated: DataFrame, order: list[str], n: int, staging: str) -> DataFrame:
        """The last writer of each key of ``n`` staged rows. Rows below their
        key's greatest order are left out by their place, for which no whole
        row is shuffled; rows are, once, where a tie remains."""
        if n <= M.MOST_ROWS:
            beaten = (M.placed(rows, self.key, *order).join(repeated, self.key)
                       .where(~_one(order).eqNullSafe(F.col("_top"))))
            rows = M.without(rows, self._staged(M.marks(beaten), f"{staging}/beaten"))
            repeated = self._repeated(rows, order, f"{staging}/tied")
            if repeated is None:
                return rows
        keyed, keys = rows.where(F.col(self.key).isNotNull()), repeated.select(self.key)
        again = last_writer(keyed.join(keys, self.key, "left_semi"), self.key, order)
        return self._staged(keyed.join(keys, self.key, "left_anti").unionByName(again)
                                 .unionByName(rows.where(F.col(self.key).isNull())), f"{staging}/last")

    def _kept(self, new: DataFrame, schema, version: dict, touched: list[str], staging: str) -> DataFrame:
        """Rows of the touched months whose key does not arrive again. Keys are
        shuffled, rows without one are not, and whole rows only where the months
        have too many to mark."""
        rows = V.read(self.spark, self.path, schema, version, touched)
        if not version["months"].keys() & set(touched):
            return rows
        if sum(version["rows"].get(m, 0) for m in touched) > M.MOST_ROWS:
            return rows.join(new.select(self.key), self.key, "left_anti")
        gone = (M.placed(rows, self.key).where(F.col(self.key).isNotNull())
                 .join(new.select(self.key), self.key, "left_semi"))
        return M.without(rows, self._staged(M.marks(gone), f"{staging}/gone"))

    def _months_of(self, rows: DataFrame) -> list:
        """Month, newest mark and number of ``rows``: one row a month."""
        return rows.groupBy(PQ.month_key(self.mark_col).alias("month")).agg(
            F.max(self.mark_col).alias("newest"), F.count(F.lit(1)).alias("n")).collect()

    def _apply(self, new: DataFrame, found: list, schema, version: dict | None, mark, epochs: dict,
               staging: str) -> dict:
        arrived = {_folder(r["month"]): r["n"] for r in found}
        new_months = set(arrived)
        newest = max((x for x in (mark, *(r["newest"] for r in found)) if x is not None), default=None)
        facts = {"mark": newest.isoformat() if newest else None, "epochs": epochs}
        if version is None:
            self._write(new, schema, {}, [], facts, arrived)
            return {"mode": "full", "mark": None, "months": sorted(new_months), "months_read": []}
        if not found:
            return {"mode": "incremental", "mark": mark, "months": [], "months_read": []}
        hit, looked = self._months_hit(new, sum(r["n"] for r in found), version, schema,
                                       set(version["months"]) - new_months)
        touched = sorted(new_months | hit)
        kept = self._kept(new, schema, version, touched, staging).drop(PQ.MONTH_COL)
        at_most = {m: version["rows"].get(m, 0) + arrived.get(m, 0) for m in touched}
        self._write(kept.unionByName(new), schema, version, touched, facts, at_most)
        return {"mode": "incremental", "mark": mark, "months": touched, "months_read": looked}
