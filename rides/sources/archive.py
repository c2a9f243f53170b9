"""Zipped trip CSVs read in parallel by a Spark Python data source.

Archives may hold CSV members directly or inner zips of CSVs (one level of
nesting, as the monthly trip archives do). A Spark job plans the read from the
central directories, and the plan has one input partition
per CSV member. Each task opens its member from shared storage, streams it
through pyarrow's incremental reader and yields Arrow record batches whose
columns are picked *by header name* (text; Spark casts them to the declared
types JVM-side). Names starting with '._', anything under '__MACOSX/', empty
members and members that are no CSV are skipped and reported.
"""

from __future__ import annotations

import io
import json
import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rides.schema import RAW_NAMES, RAW_SCHEMA

FORMAT = "rides_zip"
TEXT_SCHEMA = ", ".join(f"{n} string" for n in RAW_NAMES) + ", filename string"


def skip_reason(name: str, size: int) -> str | None:
    """Why a member is not loaded, None for one that is."""
    base = name.rsplit("/", 1)[-1]
    if "__MACOSX/" in name:
        return "hidden folder"
    if base.startswith("._"):
        return "resource fork"
    if not name.endswith((".csv", ".zip")):
        return "not a csv"
    return "empty" if size == 0 else None


@dataclass
class MemberPartition(InputPartition):
    archive: str
    member: str          # CSV, or inner zip, inside the archive
    inner: str           # CSV inside the inner zip, or ''
    size: int = 0

    @property
    def label(self) -> str:
        return "/".join(x for x in (self.archive, self.member, self.inner) if x)


def _members(archive: str) -> tuple[list[MemberPartition], list[tuple[str, int, str]]]:
    """(CSV members, skipped members) of one archive, from its directories."""
    from rides.sources.files import open_path

    found, skipped = [], []

    def take(z: zipfile.ZipFile, outer: str) -> None:
        for info in z.infolist():
            name = info.filename
            if name.endswith("/"):
                continue
            why = skip_reason(name, info.file_size)
            if why is None and name.endswith(".zip") and outer:
                why = "nested too deep"
            if why:
                skipped.append(("/".join(x for x in (archive, outer, name) if x), info.file_size, why))
            elif name.endswith(".zip"):
                with z.open(info) as raw, zipfile.ZipFile(raw) as inner:
                    take(inner, name)
            else:
                found.append(MemberPartition(archive, outer or name, name if outer else "", info.file_size))

    with open_path(archive) as f, zipfile.ZipFile(f) as z:
        take(z, "")
    return found, skipped


PLAN = "archive string, place long, member string, inner string, size long, why string"


def _plan_batches(batches):
    """Rows of the plan for archive paths: a member, or what is skipped and why."""
    import pandas as pd

    for pdf in batches:
        rows = []
        for archive in pdf["path"]:
            found, skipped = _members(archive)
            rows += [(archive, i, m.member, m.inner, m.size, None) for i, m in enumerate(found)]
            rows += [(archive, len(found) + i, label, "", size, why) for i, (label, size, why) in enumerate(skipped)]
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in PLAN.split(", ")])


def plan_members(spark: SparkSession, path: str) -> tuple[list[MemberPartition], list[tuple[str, int, str]]]:
    """Every CSV member under ``path`` (a zip or a folder), and what is
    skipped with its reason. Fails when nothing usable is left.

    A Spark job reads the central directories, and through the inner zips that
    are compressed; the driver lists files and takes one row a member, but
    opens no archive."""
    from rides.sources.files import NoUsableFiles, admit

    adm = admit(None, path, "*.zip")
    n = min(len(adm.paths), 2 * spark.sparkContext.defaultParallelism)
    paths = spark.createDataFrame([(p,) for p in adm.paths], "path string").repartition(n)
    rows = sorted(paths.mapInPandas(_plan_batches, PLAN).collect(), key=lambda r: (r["archive"], r["place"]))
    found = [MemberPartition(r["archive"], r["member"], r["inner"], r["size"]) for r in rows if r["why"] is None]
    skipped = adm.skipped + [(r["member"], r["size"], r["why"]) for r in rows if r["why"]]
    if not found:
        raise NoUsableFiles(f"no usable members under {path!r} (skipped {len(skipped)})")
    return found, skipped


def _saved_plan(spark: SparkSession, found: list[MemberPartition]) -> str:
    """The plan as a file in the shared folder, from which the source takes its
    partitions."""
    from rides.session import shared_dir
    from rides.sources.parquet import write_text

    path = shared_dir(spark, "archive_plans", unique=True) + ".json"
    write_text(path, json.dumps([[m.archive, m.member, m.inner, m.size] for m in found]))
    return path


def _csv_batches(stream, label: str, block_size: int):
    """Record batches of RAW columns (text) from one CSV stream, by name.

    Only declared columns present in the file are parsed (all as text, so no
    type is inferred), and declared columns the file lacks become NULL. As in
    the CSV reader only an empty field is NULL, and quotes are doubled."""
    import csv
    import pyarrow as pa
    import pyarrow.csv as pacsv

    first = stream.readline().decode("utf-8-sig").rstrip("\r\n")
    if not first or not stream.peek(1):
        return
    names = next(csv.reader([first]))
    place = {c.strip(): i for i, c in reversed(list(enumerate(names)))}
    present = {c: f"c{place[c]}" for c in RAW_NAMES if c in place}
    wanted = list(present.values()) or ["c0"]
    reader = pacsv.open_csv(
        stream,
        read_options=pacsv.ReadOptions(block_size=block_size, encoding="utf-8",
                                       column_names=[f"c{i}" for i in range(len(names))]),
        convert_options=pacsv.ConvertOptions(
            column_types={n: pa.string() for n in wanted}, null_values=[""],
            strings_can_be_null=True, quoted_strings_can_be_null=False, include_columns=wanted))
    for batch in reader:
        n = batch.num_rows
        cols = [batch.column(batch.schema.get_field_index(present[c])) if c in present
                else pa.nulls(n, pa.string()) for c in RAW_NAMES]
        cols.append(pa.array([label] * n, pa.string()))
        yield pa.RecordBatch.from_arrays(cols, names=RAW_NAMES + ["filename"])


class ZipTripsReader(DataSourceReader):
    def __init__(self, options):
        self.plan = options.get("plan")
        self.block_size = int(options.get("blockSize", str(1 << 22)))

    def partitions(self):
        from rides.sources.parquet import read_text

        return [MemberPartition(*m) for m in json.loads(read_text(self.plan))]

    def read(self, part: MemberPartition):
        from rides.sources.files import open_path

        with open_path(part.archive) as f, zipfile.ZipFile(f) as outer, outer.open(part.member) as s:
            if not part.inner:
                yield from _csv_batches(io.BufferedReader(s, 1 << 16), part.label, self.block_size)
                return
            with zipfile.ZipFile(s) as inner, inner.open(part.inner) as t:
                yield from _csv_batches(io.BufferedReader(t, 1 << 16), part.label, self.block_size)


class ZipTripsSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return TEXT_SCHEMA

    def reader(self, schema):
        return ZipTripsReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipTripsSource)


def _text_members(spark: SparkSession, path: str, found: list[MemberPartition] | None) -> DataFrame:
    register(spark)
    found = found or plan_members(spark, path)[0]
    return spark.read.format(FORMAT).option("plan", _saved_plan(spark, found)).load()


def read_trips_zip(spark: SparkSession, path: str, strict: bool = True,
                   found: list[MemberPartition] | None = None) -> DataFrame:
    """Raw trips (declared types) from every zip under ``path``; ``found`` is
    its plan where there is one already."""
    text = _text_members(spark, path, found)
    cols = []
    for f in RAW_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return text.select(*cols, "filename")


def read_trips_zip_checked(spark: SparkSession, path: str,
                           found: list[MemberPartition] | None = None) -> DataFrame:
    """Every row of the archives, fit or not, with the reasons against it
    (``rides.operators.quarantine``)."""
    from rides.operators.quarantine import checked

    return checked(_text_members(spark, path, found), RAW_SCHEMA, ["filename"])


def write_trips_zip(df: DataFrame, out_dir: str, nested: bool = True) -> None:
    """Write each partition of ``df`` (raw text columns) as one archive in
    ``out_dir``: an outer zip holding an inner zip holding one CSV, the same
    layout as the published monthly archives.

    Runs as a Spark job; every task streams its rows batch by batch into the
    archive on shared storage, so task memory is one Arrow batch whatever
    the partition size. Archives are named by partition number and written
    under a temporary name, then moved into place, so a retried task
    replaces its own file instead of adding a second copy."""
    cols = RAW_NAMES

    def write_part(batches):
        import pandas as pd
        from pyspark import TaskContext

        from rides.sources.files import filesystem

        ctx = TaskContext.get()
        tag = f"{ctx.partitionId():05d}"
        fs, p = filesystem(out_dir)
        fs.create_dir(p, recursive=True)
        tmp = f"{p}/.archive-{tag}.zip.{ctx.attemptNumber()}"
        rows = 0
        with fs.open_output_stream(tmp) as sink, \
                zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED if nested else zipfile.ZIP_DEFLATED) as outer:
            if nested:
                entry = outer.open(f"trips-{tag}.zip", "w", force_zip64=True)
                inner = zipfile.ZipFile(entry, "w", zipfile.ZIP_DEFLATED)
            else:
                entry, inner = None, outer
            with inner.open(f"trips-{tag}.csv", "w", force_zip64=True) as csv_out:
                csv_out.write((",".join(cols) + "\n").encode())
                for pdf in batches:
                    rows += len(pdf)
                    csv_out.write(pdf[cols].to_csv(index=False, header=False).encode())
            if nested:
                inner.close()
                entry.close()
        if rows == 0:
            fs.delete_file(tmp)
            return
        fs.move(tmp, f"{p}/archive-{tag}.zip")
        yield pd.DataFrame({"archive": [f"archive-{tag}.zip"], "rows": [rows]})

    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    text.mapInPandas(write_part, "archive string, rows long").collect()


def ingest_archives(spark: SparkSession, path: str, target_path: str, strict: bool = True,
                    mode: str = "append", rejects: str | None = None) -> dict:
    """Write every trip in the archives under ``path`` to a month-partitioned
    raw table in one parallel write, and report rows per CSV member, skipped
    members, archive MB, seconds and MB/s. Rows are counted from what was
    written, member by member; ``counts`` and ``rejects`` are as in
    ``rides.sources.csv.ingest``."""
    import time

    from rides.sources.csv import ingest_stats, write_watched
    from rides.sources.files import Admission, filesystem

    t0 = time.perf_counter()
    found, skipped = plan_members(spark, path)
    rows = (read_trips_zip(spark, path, strict, found) if rejects is None
            else read_trips_zip_checked(spark, path, found))
    written, counts = write_watched(rows, target_path, mode, rejects)
    adm = Admission(admitted=[(m.label, m.size) for m in found])
    members = [{"member": r["file"], "rows_added": r["rows_added"], "bytes_mb": r["bytes_mb"]}
               for r in ingest_stats(written, adm).orderBy("file").collect()]
    mb = 0.0
    for a in {m.archive for m in found}:
        fs, p = filesystem(a)
        mb += fs.get_file_info(p).size / 1e6
    secs = time.perf_counter() - t0
    return {"members": members, "skipped": skipped, "rows": sum(m["rows_added"] for m in members),
            "mb": mb, "seconds": secs, "mb_per_s": mb / secs if secs else None, "counts": counts}
