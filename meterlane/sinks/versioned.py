"""Parquet tables whose loads replace single files and become visible all at once.

A table is a folder. Each load writes its rows to a new folder under ``data`` and then, as its last step,
a small pointer under ``versions`` that names what belongs to the table from now on: folders, or
single files of a folder. Readers take the newest pointer. A load that breaks off leaves no
pointer and readers never see what it wrote; two loads that start from the same
version can't both win, since a pointer is never overwritten.

Deletes and merges copy on write: the files that hold a row concerned are found through
``_metadata.file_path``, their other rows are written anew and all other files stay as they are. What the
driver holds is a list of files, as Spark itself does for every scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlane.operators.cleaning import first_per_key
from meterlane.operators.merging import missing_rows, newer_than_target
from meterlane.operators.unions import stacked_loosely
from meterlane.session import materialize

ROWS = "rows"
_FILE = "__file"


class Version(NamedTuple):
    """What a pointer says. ``parts`` maps a part of the table to its folders, and each folder to the
    names of its files that still belong to it; None stands for all."""

    number: int
    schema: StructType
    parts: dict[str, dict[str, list[str] | None]]


class Conflict(RuntimeError):
    """Another load has made a version in the meantime; nothing has changed, and the load can be run again."""


# --- versions ------------------------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    _, fs, place = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, ascending; none if there is no table."""
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path}/versions") if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The given version or the newest; None if there is no table."""
    number = number if number is not None else max(versions(spark, path), default=None)
    if number is None:
        return None
    jvm, fs, place = _file_system(spark, f"{path}/versions/{number:010}.json")
    stream = fs.open(place)
    try:
        told = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, StructType.fromJson(told["schema"]), told["parts"])


def point(spark: SparkSession, path: str, new: Version) -> None:
    """The last step of a load. The pointer is written beside its place and renamed, which fails if it is taken."""
    told = json.dumps({"schema": new.schema.jsonValue(), "parts": new.parts})
    jvm, fs, beside = _file_system(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(told.encode())
    finally:
        out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{new.number:010}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        beside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(place), no_options)
    except Exception as error:
        fs.delete(beside, False)
        if fs.exists(place):
            raise Conflict(f"version {new.number} of {path} was made by another load") from error
        raise


def read(spark: SparkSession, path: str, part: str = ROWS, number: int | None = None) -> DataFrame:
    """The rows of the newest or the given version; older files have null in columns that came later."""
    return frame(spark, path, known(spark, path, number), part)


def known(spark: SparkSession, path: str, number: int | None = None) -> Version:
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return found


def frame(spark: SparkSession, path: str, at: Version, part: str) -> DataFrame:
    places = []
    for folder, names in at.parts.get(part, {}).items():
        places += [f"{path}/data/{folder}"] if names is None else [f"{path}/data/{folder}/{n}" for n in names]
    return spark.read.schema(at.schema).parquet(*places) if places else spark.createDataFrame([], at.schema)


def written(df: DataFrame, path: str) -> str:
    """Write rows to a folder of their own, which no version names yet."""
    folder = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{folder}")
    return folder


def _touched(rows: DataFrame) -> dict[str, set[str]]:
    """Folder and names of the files that rows with their file in ``__file`` come from."""
    out: dict[str, set[str]] = {}
    # Paths are taken apart here, once per file and not once per row.
    for (file,) in rows.select(_FILE).distinct().collect():
        folder, name = file.rsplit("/", 2)[1:]
        out.setdefault(folder, set()).add(name)
    return out


def _without(spark: SparkSession, path: str, folders: Mapping[str, list[str] | None], gone: Mapping[str, set[str]]) -> dict:
    """The folders less some files; folders that hold none of them stay as they are."""
    out: dict[str, list[str] | None] = {}
    for folder, names in folders.items():
        if folder not in gone:
            out[folder] = names
            continue
        if names is None:
            names = [n for n in _names(spark, f"{path}/data/{folder}") if not n.startswith(("_", "."))]
        if left := sorted(set(names) - gone[folder]):
            out[folder] = left
    return out


def _only(spark: SparkSession, path: str, at: Version, files: Mapping[str, set[str]]) -> DataFrame:
    return frame(spark, path, at._replace(parts={ROWS: {f: sorted(n) for f, n in files.items()}}), ROWS)


def wider(old: StructType, new: StructType) -> StructType:
    return StructType(old.fields + [f for f in new.fields if f.name not in old.names])


# --- loads ---------------------------------------------------------------------------------

def replace(df: DataFrame, path: str) -> DataFrame:
    """Make these rows the whole table."""
    spark, last = df.sparkSession, max(versions(df.sparkSession, path), default=0)
    point(spark, path, Version(last + 1, df.schema, {ROWS: {written(df, path): None}}))
    return read(spark, path)


def append(df: DataFrame, path: str) -> DataFrame:
    """Add rows; columns that the table lacks are added to it. Makes the table if there is none."""
    spark = df.sparkSession
    at = version(spark, path)
    if at is None:
        return replace(df, path)
    folders = {**at.parts[ROWS], written(df, path): None}
    point(spark, path, Version(at.number + 1, wider(at.schema, df.schema), {ROWS: folders}))
    return read(spark, path)


def insert_only(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Add the rows whose key the table does not have; keys repeated in ``df`` stay. Null keys match nothing."""
    at = version(df.sparkSession, path)
    return append(df if at is None else missing_rows(frame(df.sparkSession, path, at, ROWS), df, keys), path)


def merge(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[Column] = (),
          at: Version | None = None) -> DataFrame:
    """Replace the rows of equal key as a whole and insert the others; run again, it changes nothing.

    A key that ``df`` has several times counts once: its first row in the order ``newest``, or
    any one without an order. Rows with a null in the key match nothing, so each of them is inserted.
    ``at`` is the version to start from, where ``df`` was read from that very version.
    """
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    once = first_per_key(df.filter(named), keys, newest) if newest else df.filter(named).dropDuplicates(list(keys))
    return _rewritten(df, path, keys, once.unionByName(df.filter(~named)), at)


def delete_insert(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Delete all rows whose key occurs in ``df``, then insert ``df`` with its repeated keys."""
    return _rewritten(df, path, keys, df)


def _rewritten(df: DataFrame, path: str, keys: Sequence[str], added: DataFrame, at: Version | None = None) -> DataFrame:
    spark, at = df.sparkSession, at or version(df.sparkSession, path)
    if at is None:
        return replace(added, path)
    # Written to its place at once, and read from there.
    new = written(added, path)
    added = spark.read.schema(added.schema).parquet(f"{path}/data/{new}")
    wanted = added.select(*keys).distinct()
    old = frame(spark, path, at, ROWS)

    def hits(rows: DataFrame) -> DataFrame:
        return rows.withColumn(_FILE, F.col("_metadata.file_path")).join(wanted, list(keys), "left_semi")

    # The range of the new keys is pushed to the scan, so files beyond it are not read through.
    ranges = added.agg(*[f(k) for k in keys for f in (F.min, F.max)]).first()
    near = [F.col(k).between(F.lit(ranges[2 * i]), F.lit(ranges[2 * i + 1])) for i, k in enumerate(keys) if ranges[2 * i] is not None]
    files = _touched(hits(old.filter(reduce(lambda a, b: a & b, near)))) if near else {}
    kept = missing_rows(added, _only(spark, path, at, files), keys) if files else None
    return _commit(spark, path, at, files, kept, wider(at.schema, df.schema), {new: None})


def delete_where(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """Delete the rows for which the condition is true; where it is null they stay. Without such rows
    there is no new version."""
    return _replaced(spark, path, condition, None)


def replace_where(df: DataFrame, path: str, condition: Column) -> DataFrame:
    """Delete the rows for which the condition is true and insert those of ``df`` for which it is: the load of an interval."""
    if version(df.sparkSession, path) is None:
        return replace(df.filter(condition), path)
    return _replaced(df.sparkSession, path, condition, df.filter(condition))


def _replaced(spark: SparkSession, path: str, condition: Column, added: DataFrame | None) -> DataFrame:
    at = known(spark, path)
    files = _touched(frame(spark, path, at, ROWS).withColumn(_FILE, F.col("_metadata.file_path")).filter(condition)
                     if at.parts[ROWS] else spark.createDataFrame([], f"{_FILE} string"))
    if not files and added is None:
        return frame(spark, path, at, ROWS)
    kept = _only(spark, path, at, files).filter(~F.coalesce(condition, F.lit(False)))
    if added is None:
        return _commit(spark, path, at, files, kept, at.schema)
    return _commit(spark, path, at, files, stacked_loosely(kept, added), wider(at.schema, added.schema))


def _commit(spark: SparkSession, path: str, at: Version, files: Mapping[str, set[str]], rows: DataFrame | None, schema: StructType,
            more: Mapping[str, None] = MappingProxyType({})) -> DataFrame:
    """The next version: without ``files``, with ``rows`` and what folders were written before."""
    folders = {**_without(spark, path, at.parts[ROWS], files), **more}
    if rows is not None:
        folders[written(rows, path)] = None
    point(spark, path, Version(at.number + 1, schema, {ROWS: folders}))
    return read(spark, path)


def load(df: DataFrame, path: str, strategy: str = "replace", keys: Sequence[str] = (), full_refresh: bool = False) -> DataFrame:
    """Load rows by a named strategy and return the table; ``full_refresh`` turns any into ``replace``."""
    plain: dict[str, Callable] = {"replace": replace, "append": append}
    keyed: dict[str, Callable] = {"insert_only": insert_only, "merge": merge, "delete_insert": delete_insert}
    if strategy not in plain | keyed:
        raise ValueError(f"unknown strategy {strategy!r}")
    if full_refresh or strategy in plain:
        return (replace if full_refresh else plain[strategy])(df, path)
    return keyed[strategy](df, path, keys)


def load_newer(source: DataFrame, path: str, time: str, keys: Sequence[str]) -> DataFrame:
    """Incremental model: rows beyond the table's newest time, merged by key."""
    if version(source.sparkSession, path) is None:
        return merge(source, path, keys)
    return merge(newer_than_target(read(source.sparkSession, path), source, time), path, keys)


# --- history -------------------------------------------------------------------------------

OPEN, CLOSED = "open", "closed"


def load_history(current: DataFrame, path: str, key: str, tracked: Sequence[str], at: Column) -> DataFrame:
    """Type-2 history of a source, stored: close versions that changed or vanished, open new ones.

    Open versions are a part of the table of their own. A delivery reads that part only and
    rewrites those of its files in which a version ends; closed versions are only ever added.
    ``current`` is the source as of ``at``; a key that it has several times counts once, by its least tracked
    values. Nulls are compared as values, in the key too. The same delivery again changes nothing.
    """
    spark = current.sparkSession
    state = F.struct(*tracked)
    now = current.groupBy(key).agg(F.min(state).alias("now")).withColumn("__at", at)
    kind = now.schema["__at"].dataType
    schema = StructType([current.schema[key], *[current.schema[c] for c in tracked]]).add("valid_from", kind).add("valid_to", kind)
    schema = StructType([f.__class__(f.name, f.dataType, True) for f in schema.fields])
    before = version(spark, path) or Version(0, schema, {OPEN: {}, CLOSED: {}})
    old = frame(spark, path, before, OPEN)
    old = old.withColumn(_FILE, F.col("_metadata.file_path") if before.parts[OPEN] else F.lit(None).cast("string"))
    both = (old.select(F.struct(*schema.names).alias("old"), _FILE)
            .join(now, F.col(f"old.{key}").eqNullSafe(F.col(key)), "full"))
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"now.{c}")) for c in tracked], F.lit(True))
    # Only what differs from the open versions is written down.
    changed = both.filter(F.col("old").isNull() | F.col("now").isNull() | ~same)
    changed = materialize(changed.select("old", _FILE, key, "now", at.cast(kind).alias("__at")), "history-changes")
    ended = changed.filter("old IS NOT NULL")
    closing = ended.select("old.*", "__at").withColumn("valid_to", F.col("__at")).drop("__at")
    opening = changed.filter("now IS NOT NULL").select(
        key, "now.*", F.col("__at").alias("valid_from"), F.lit(None).cast(kind).alias("valid_to"))
    files = _touched(ended)
    if not files and opening.isEmpty():
        if before.number == 0:
            point(spark, path, before._replace(number=1))
        return history(spark, path)
    ends = ended.select(F.col(f"old.{key}").alias("__key"))
    left = _only(spark, path, before, files)
    left = left.join(ends, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    parts = {OPEN: {**_without(spark, path, before.parts[OPEN], files), written(left.unionByName(opening), path): None},
             CLOSED: dict(before.parts[CLOSED])}
    if files:
        parts[CLOSED][written(closing, path)] = None
    point(spark, path, Version(before.number + 1, before.schema, parts))
    return history(spark, path)


def history(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """All versions, the open ones with a null ``valid_to``."""
    at = known(spark, path, number)
    return frame(spark, path, at, OPEN).unionByName(frame(spark, path, at, CLOSED))
