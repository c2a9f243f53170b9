"""Session construction and the shared folder used for written tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package assumes. Timestamps are zone-less
# (TIMESTAMP_NTZ) end to end; UTC keeps any zoned intermediate from shifting
# a calendar day.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "rides",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so a cluster submit keeps its own.
    ``spark.checkpoint.dir`` is left to the cluster; a local fallback is
    set only when nothing names it (tests, laptops).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled"):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


class NoSharedFolder(RuntimeError):
    pass


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rides`` importable in every Python worker (the code that runs
    inside tasks: the CSV header probe, the zip data source, the archive
    writer). The package is zipped once per application into the shared
    folder and added with ``addPyFile``, as ``--py-files`` would do."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out_dir = shared_dir(spark, "pyfiles", sc.applicationId)    # outlives the scratch folder
    target = f"{out_dir}/rides.zip"
    from rides.sources.files import filesystem

    fs, p = filesystem(target)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(p) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("rides", os.path.relpath(full, pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests, a laptop) gets a fallback under /tmp;
    on a cluster a machine-local folder would not be visible to other
    executors, so an unset setting is an error there."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder every executor can reach")
        d = os.path.join("/tmp", "rides-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path inside the shared checkpoint folder (visible to every executor).

    ``unique`` paths are scratch space: they sit under a folder of the
    current application, which ``cleanup_scratch`` removes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if unique:
        app = spark.sparkContext.applicationId
        return "/".join([base, "rides", "scratch", app, *parts, uuid.uuid4().hex])
    return "/".join([base, "rides", *parts])


def cleanup_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder (materialized aggregates,
    staged batches). Call when the DataFrames built on them are no longer
    needed."""
    from rides.sources.parquet import delete_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    delete_dir(f"{base}/rides/scratch/{spark.sparkContext.applicationId}")


def together(*jobs):
    """Run independent actions at the same time and return their results in
    order. Each job of a small step leaves most of a cluster idle; Spark's
    scheduler shares it among those submitted from several threads."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]
