"""File listing and admission (storage-agnostic, metadata only).

Spark's own file index hides names that start with '.' or '_' and empty
files without saying so. Admission lists through pyarrow's filesystem layer
instead, so every skipped file is reported with its reason, then hands the
admitted paths to Spark readers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession, functions as F


class NoUsableFiles(ValueError):
    pass


@dataclass
class Admission:
    admitted: list[tuple[str, int]] = field(default_factory=list)   # (path, bytes)
    skipped: list[tuple[str, int, str]] = field(default_factory=list)  # (path, bytes, reason)

    @property
    def paths(self) -> list[str]:
        return [p for p, _ in self.admitted]


def _walk(path: str, glob: str):
    """(path, size, hidden) for every file matching ``glob`` under ``path``:
    a metadata-only listing through pyarrow's filesystem layer."""
    import fnmatch

    import pyarrow.fs as pafs

    fs, root = filesystem(path)
    prefix = _prefix(path, root)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        yield prefix + root, info.size, False
        return
    for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        if f.type != pafs.FileType.File or not fnmatch.fnmatch(f.base_name, glob):
            continue
        rel = [seg for seg in f.path[len(root):].split("/") if seg]
        hidden = any(seg.startswith(("_", ".")) for seg in rel[:-1])
        yield prefix + f.path, f.size, hidden


def admit(spark: SparkSession | None, paths: str | list[str], glob: str = "*.csv") -> Admission:
    """Admit files for loading: skip resource forks ('._*'), files inside
    hidden folders ('__MACOSX/', '_temporary/') and zero-byte files, and fail
    when nothing usable is left. The list is bounded by the number of files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    adm = Admission()
    for root in paths:
        for uri, size, hidden in sorted(_walk(root, glob)):
            name = uri.rsplit("/", 1)[-1]
            if hidden:
                adm.skipped.append((uri, size, "hidden folder"))
            elif name.startswith("._"):
                adm.skipped.append((uri, size, "resource fork"))
            elif name.startswith((".", "_")):
                adm.skipped.append((uri, size, "hidden"))
            elif size == 0:
                adm.skipped.append((uri, 0, "empty"))
            else:
                adm.admitted.append((uri, size))
    if not adm.admitted:
        raise NoUsableFiles(f"no usable files under {paths!r} (skipped {len(adm.skipped)})")
    return adm


def _prefix(path: str, root: str) -> str:
    """What stands before a filesystem's own path in Spark's spelling."""
    if "://" not in path or path.startswith("file:"):
        return "file:"
    scheme, rest = path.split("://", 1)
    authority = rest.split("/", 1)[0]
    return f"{scheme}://" + ("" if root.split("/", 1)[0] == authority else authority)


def filesystem(path: str):
    """(pyarrow filesystem, path inside it) for local, HDFS, S3 or GCS paths.
    Paths are plain text: a blank or a percent sign stands for itself."""
    import os
    from urllib.parse import quote

    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


def plain_file_path():
    """``_metadata.file_path`` (percent-encoded by Spark) as plain text, with
    local files as 'file:/a/b'."""
    path = F.col("_metadata.file_path")
    # Evaluated for every row: a path without escapes needs no decoding, a
    # remote one no change.
    plain = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    rest = F.substring(plain, len("file:/") + 1, 1 << 30)
    return F.when(F.startswith(path, F.lit("file:/")), F.concat(F.lit("file:/"), F.ltrim(rest, F.lit("/")))).otherwise(plain)


def no_glob(path: str) -> str:
    """``path`` with the characters that Spark's readers take for patterns
    escaped."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def open_path(path: str):
    """Open a file for reading inside a task (used by the Python readers)."""
    fs, p = filesystem(path)
    return fs.open_input_file(p)
