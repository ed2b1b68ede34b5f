"""Tables that are replaced as a whole, whatever happens while they are written.

A version of a table is a folder ``version=<id>`` of its own below the table's path. It
counts from the moment an entry of the manifest, ``_commits/<number>.json``, names it; that
file is written last, under another name, and renamed. Readers follow the newest
entry. A job that dies while it writes leaves rows that no entry names, and the
table as it was. Superseded versions are deleted after the commit.

Several tables that belong together have a manifest at their common root, whose entry
names a version of each; tables that are absent on purpose are named too.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"
VERSION = "version"
# Versions that no entry names are left alone for so long: somebody may be writing them.
GRACE_SECONDS = 86_400
# A builder that has not committed after so long is taken to be dead.
PATIENCE_SECONDS = 3_600
_POLL_SECONDS = 0.2


class Entry(NamedTuple):
    """One line of a manifest: a version of a table, or of each table of a set, and what was noted with it."""

    number: int
    version: str | None
    rows: int | None
    schema: str | None
    facts: dict[str, Any]


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def _children(spark: SparkSession, path: str) -> list:
    files, folder = _files(spark, path)
    return list(files.listStatus(folder)) if files.exists(folder) else []


def _create(spark: SparkSession, path: str, text: str = "") -> bool:
    """A new file; False where there is one already."""
    files, target = _files(spark, path)
    try:
        out = files.create(target, False)
    except Exception as error:  # the file system's own class of "exists already"
        if files.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    files, target = _files(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str, ending: str) -> list[int]:
    names = [c.getPath().getName() for c in _children(spark, f"{path}/{COMMITS}")]
    return sorted(int(n.removesuffix(ending)) for n in names if n.endswith(ending) and not n.startswith("_"))


def _entry(spark: SparkSession, path: str, number: int) -> Entry:
    told = json.loads(_text(spark, f"{path}/{COMMITS}/{number:08d}.json"))
    return Entry(number, told["version"], told["rows"], told["schema"], told["facts"])


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The manifest of a table or set, oldest first."""
    return [_entry(spark, path, n) for n in _numbers(spark, path, ".json")]


def newest(spark: SparkSession, path: str) -> Entry | None:
    """The entry that counts; None where nothing was ever committed."""
    numbers = _numbers(spark, path, ".json")
    return _entry(spark, path, numbers[-1]) if numbers else None


def folder_of(path: str, version: str) -> str:
    return f"{path}/{VERSION}={version}"


def new_version() -> str:
    return f"{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


def entry_of(spark: SparkSession, path: str, version: str) -> Entry | None:
    """The entry that names a version."""
    return next((e for e in reversed(entries(spark, path)) if e.version == version), None)


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = (), **facts: Any) -> Entry:
    """Write a version that nobody reads yet; its entry has no number."""
    version = new_version()
    folder = folder_of(path, version)
    df.write.partitionBy(*partition_by).parquet(folder)
    # From the footers alone.
    rows = df.sparkSession.read.schema(df.schema).parquet(folder).count()
    return Entry(0, version, rows, df.schema.json(), facts)


def _put(spark: SparkSession, path: str, number: int, entry: Entry) -> bool:
    """Write the entry of that number, all at once; False where there is one."""
    files, target = _files(spark, f"{path}/{COMMITS}/{number:08d}.json")
    if files.exists(target):
        return False
    draft = f"{path}/{COMMITS}/_{uuid.uuid4().hex}"
    told = {"version": entry.version, "rows": entry.rows, "schema": entry.schema, "facts": entry.facts}
    _create(spark, draft, json.dumps(told))
    if files.rename(_files(spark, draft)[1], target):
        return True
    _delete(spark, draft)
    return False


def commit(spark: SparkSession, path: str, entry: Entry) -> Entry:
    """Name a staged version in the manifest. From now on it is the table."""
    while True:
        taken = [0, *_numbers(spark, path, ".json"), *_numbers(spark, path, ".claim")]
        number = max(taken) + 1
        # The claim keeps a number for one writer; a number whose writer died is left out.
        if _create(spark, f"{path}/{COMMITS}/{number:08d}.claim") and _put(spark, path, number, entry):
            return entry._replace(number=number)


def sweep(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> None:
    """Delete versions that the newest entry does not name, but for ``keep`` and those that may be in the making."""
    listed = entries(spark, path)
    named = {e.version for e in listed}
    wanted = {*keep, *[e.version for e in listed[-1:]]}
    now = time.time() * 1000
    for child in _children(spark, path):
        name = child.getPath().getName()
        if name.startswith(f"{VERSION}=") and (version := name.partition("=")[2]) not in wanted:
            if version in named or now - child.getModificationTime() > GRACE_SECONDS * 1000:
                _delete(spark, f"{path}/{name}")


def read(spark: SparkSession, path: str, version: str | None = None) -> DataFrame | None:
    """The newest version of a table, or the one given; None where nothing is committed."""
    entry = newest(spark, path) if version is None else entry_of(spark, path, version)
    if entry is None or entry.version is None:
        return None
    return spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(folder_of(path, entry.version))


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), **facts: Any) -> Entry:
    """Stage, commit, sweep: the table is the old one or the new one, never less."""
    done = commit(df.sparkSession, path, stage(df, path, partition_by, **facts))
    sweep(df.sparkSession, path)
    return done


def swap_in(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace a plain folder that others read by its path: written beside it, then renamed.

    While ``write`` runs, and if it fails, the old folder stays. A job that dies between the
    two renames leaves the old folder beside the path, as ``<path>._old-<id>``.
    """
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{path.rstrip('/')}._new-{mark}", f"{path.rstrip('/')}._old-{mark}"
    try:
        write(fresh)
    except BaseException:
        _delete(spark, fresh)
        raise
    files, target = _files(spark, path)
    if files.exists(target) and not files.rename(target, _files(spark, old)[1]):
        raise OSError(f"{path} cannot be replaced")
    if not files.rename(_files(spark, fresh)[1], target):
        raise OSError(f"{fresh} cannot be renamed to {path}")
    _delete(spark, old)


def commit_set(spark: SparkSession, root: str, parts: Mapping[str, Entry | None], **facts: Any) -> Entry:
    """Tables below ``root`` that count together; None stands for one that is absent on purpose.

    Versions that the set named before are deleted only afterwards.
    """
    named = {name: (part.version if part else None) for name, part in parts.items()}
    done = commit(spark, root, Entry(0, None, None, None, {**facts, "parts": named}))
    for name, part in parts.items():
        if part is None:
            _delete(spark, f"{root}/{name}")
        else:
            sweep(spark, f"{root}/{name}", [part.version])
    return done


def read_part(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of the newest set; None if it is absent on purpose. Without a set, or for a name it does not have, an error."""
    entry = newest(spark, root)
    if entry is None:
        raise FileNotFoundError(f"nothing finished under {root}")
    if name not in entry.facts["parts"]:
        raise FileNotFoundError(f"{root} has no {name}")
    version = entry.facts["parts"][name]
    return None if version is None else read(spark, f"{root}/{name}", version)


def build_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], patience: float = PATIENCE_SECONDS
) -> DataFrame:
    """The table at ``path``, built by whoever comes first.

    The first builder claims the first number by creating its file; others wait for its
    commit. If it fails it gives the claim back; if it dies, others build after ``patience``
    seconds. Even then one commit counts, since the first entry is written once.
    """
    claim = f"{path}/{COMMITS}/{1:08d}.claim"
    while newest(spark, path) is None:
        files, target = _files(spark, claim)
        mine = _create(spark, claim)
        if mine or (files.exists(target) and time.time() - files.getFileStatus(target).getModificationTime() / 1000 > patience):
            try:
                staged = stage(build(), path)
            except BaseException:
                if mine:
                    _delete(spark, claim)
                raise
            if not _put(spark, path, 1, staged):
                _delete(spark, folder_of(path, staged.version))
        else:
            time.sleep(_POLL_SECONDS)
    return read(spark, path)


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of name, length and modification time of every file below ``paths``; no content is read.

    Spark lists the files; hashes are summed, so their order plays no part.
    """
    parts = []
    for path in paths:
        if not path_exists(spark, path):
            parts.append(f"{path}:absent")
            continue
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        one = F.xxhash64("path", "length", "modificationTime")
        other = F.xxhash64("length", "modificationTime", "path")
        row = listed.agg(F.count("*"), F.bit_xor(one), F.bit_xor(other)).first()
        parts.append(f"{path}:{row[0]}:{row[1]}:{row[2]}")
    return "|".join(parts)
