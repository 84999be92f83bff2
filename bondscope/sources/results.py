"""Published results: named views, versioned datasets, bundles and archives."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import files
from bondscope.session import drop_database, own_database

RUN_KEYS = ("report_date", "sector")
#: The folder of a path's records.
RUNS = "_runs"
#: Tables behind published views, by application and view name.
_PUBLISHED: dict[tuple[str, str], str] = {}


def _place(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def publish(
    results: Mapping[str, DataFrame],
    path: str | None = None,
    *,
    report_date: date | None = None,
    sector: str | None = None,
) -> list[str]:
    """Make results readable by name, replacing earlier ones in one step.

    Without a path they are written as tables of this application and become global temporary views of those, so
    they outlive the report they come from; views are replaced when all tables are written. With a path each
    is a parquet dataset with a folder for each report date, sector and version. All sections of a run are
    written under a new version, then one record names it: a reader sees the run before or this one, and a publish that
    fails changes nothing. The version before the current one stays for readers that have begun.
    """
    if path is not None and (report_date is None or sector is None):
        raise ValueError("a dataset needs report_date and sector")
    if not results:
        return []
    spark = next(iter(results.values())).sparkSession
    if path is None:
        _publish_views(spark, results)
        return list(results)
    run, version = Run(spark, path, report_date, sector), uuid4().hex[:16]
    try:
        entries = {name: run.write(name, frame, version) for name, frame in results.items()}
    except BaseException:
        run.drop(results, version)
        raise
    run.enter(entries)
    return list(results)


def _publish_views(spark: SparkSession, results: Mapping[str, DataFrame]) -> None:
    database = own_database(spark)
    try:
        for name, frame in results.items():
            frame.write.format("parquet").saveAsTable(f"{database}.{name}")
    except BaseException:
        drop_database(spark, database)
        raise
    for name in results:
        spark.table(f"{database}.{name}").createOrReplaceGlobalTempView(name)
        _drop_table(spark, name)
        _PUBLISHED[spark.sparkContext.applicationId, name] = f"{database}.{name}"


def _drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table behind a published view, and its database with the last one."""
    table = _PUBLISHED.pop((spark.sparkContext.applicationId, name), None)
    if table is None:
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    database = table.split(".")[0]
    if not any(other.startswith(f"{database}.") for other in _PUBLISHED.values()):
        drop_database(spark, database)


class Run:
    """One report date and sector of published datasets, and the records that tell its current version.

    Records are numbered and never changed; the one of the highest number holds. An entry of a record tells a
    section's version, rows, checksum and columns.
    """

    def __init__(self, spark: SparkSession, path: str, report_date: date, sector: str) -> None:
        self.spark, self.path, self.report_date, self.sector = spark, path, report_date, sector
        self.part = f"report_date={report_date.isoformat()}/sector={files.part_name(spark, sector)}"
        self.records = _place(path, f"{RUNS}/{self.part}")

    @classmethod
    def all_in(cls, spark: SparkSession, path: str) -> list[Run]:
        found = []
        for day in files.names_in(spark, _place(path, RUNS)):
            for part in files.names_in(spark, _place(path, f"{RUNS}/{day}")):
                run = cls(spark, path, date.fromisoformat(day.partition("=")[2]), "")
                run.part, run.records = f"{day}/{part}", _place(path, f"{RUNS}/{day}/{part}")
                record = run.current()
                if record is not None:
                    run.sector = record["sector"]
                    found.append(run)
        return found

    def numbers(self) -> list[int]:
        names = files.names_in(self.spark, self.records)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def current(self) -> dict | None:
        numbers = self.numbers()
        return files.read_record(self.spark, f"{self.records}/{numbers[-1]:08d}.json") if numbers else None

    def sections(self) -> dict[str, dict]:
        return (self.current() or {"sections": {}})["sections"]

    def folder(self, name: str, version: str) -> str:
        return _place(self.path, f"{name}/{self.part}/version={version}")

    def write(self, name: str, frame: DataFrame, version: str) -> dict:
        """Write a section under a version and measure it in the same job."""
        told = Observation()
        measures = [value.alias(key) for key, value in content(frame).items()]
        frame.observe(told, *measures).write.parquet(self.folder(name, version))
        return {"version": version, "columns": frame.schema.json(), **told.get}

    def drop(self, names: Iterable[str], version: str) -> None:
        for name in names:
            files.remove(self.spark, self.folder(name, version))

    def enter(self, entries: Mapping[str, dict]) -> None:
        """Make the entries current, then remove records and versions older than those before."""
        record = {"report_date": self.report_date.isoformat(), "sector": self.sector, "sections": dict(entries)}
        number = max(self.numbers(), default=0) + 1
        while not files.write_record(self.spark, f"{self.records}/{number:08d}.json", record):
            number += 1  # another publish of this run came first; this one replaces it
        old = [n for n in self.numbers() if n < number]
        kept = {(name, e["version"]) for name, e in entries.items()}
        for n in reversed(old):
            place = f"{self.records}/{n:08d}.json"
            for name, entry in files.read_record(self.spark, place)["sections"].items():
                if n != old[-1] and (name, entry["version"]) not in kept:
                    files.remove(self.spark, self.folder(name, entry["version"]))
                kept.add((name, entry["version"])) if n == old[-1] else None
            if n != old[-1]:
                files.remove(self.spark, place)

    def read(self, name: str) -> DataFrame:
        """A section with its own columns, then the report date and the sector."""
        entry = self.sections()[name]
        schema = T.StructType.fromJson(json.loads(entry["columns"]))
        frame = self.spark.read.schema(schema).parquet(self.folder(name, entry["version"]))
        return frame.withColumns({"report_date": F.lit(self.report_date), "sector": F.lit(self.sector)})


def content(frame: DataFrame) -> dict[str, Column]:
    """Rows and a checksum that does not depend on their order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]) if frame.columns else F.lit(0).cast("long")
    total = F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return {"rows": F.count("*"), "checksum": total.cast("string")}


def read_result(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    *,
    report_date: date | None = None,
    sector: str | None = None,
) -> DataFrame:
    """The current version of a published result; from a path, optionally one report date and sector of it.

    Pivoted sections have other columns each week and sector. One run comes back with its own columns, several with the
    columns of all.
    """
    if path is None:
        return spark.table(f"global_temp.{name}")
    runs = [
        run
        for run in Run.all_in(spark, path)
        if report_date in (None, run.report_date) and sector in (None, run.sector) and name in run.sections()
    ]
    if not runs:
        raise ValueError(f"no published {name!r} in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [run.read(name) for run in runs])


def cleanup(spark: SparkSession, names: Iterable[str], frames: Iterable[DataFrame] = ()) -> list[str]:
    """Drop published views with their tables and release staged frames; returns the views that existed."""
    dropped = [name for name in names if spark.catalog.dropGlobalTempView(name)]
    for name in dropped:
        _drop_table(spark, name)
    for frame in frames:
        frame.unpersist()
    return dropped


def archive_run(
    spark: SparkSession, path: str, archive: str, names: Iterable[str], report_date: date
) -> dict[str, DataFrame]:
    """Copy one report date of published datasets to ``archive``; returns the archived frames.

    Every sector is copied with its own columns and read again; it is entered when rows and checksum agree with the
    source. What is entered from the same version and still reads the same is not copied again, so a call that was
    broken off, or whose copies were damaged, is finished by another one.
    """
    names = list(names)
    for run in Run.all_in(spark, path):
        if run.report_date != report_date:
            continue
        target = Run(spark, archive, report_date, run.sector)
        for name in names:
            source = run.sections().get(name)
            if source is None or _holds(target, name, source):
                continue
            version, own = uuid4().hex[:16], run.read(name).drop(*RUN_KEYS)
            copied = target.write(name, own, version) | {"source": source["version"]}
            if _differs(copied, source) or _differs(_measured(target, name, copied), source):
                target.drop([name], version)
                raise ValueError(f"the copy of {name!r}, {run.sector!r} differs from its source")
            target.enter(target.sections() | {name: copied})
    return {name: read_result(spark, name, archive, report_date=report_date) for name in names}


def _differs(one: Mapping, other: Mapping) -> bool:
    return any(one[key] != other[key] for key in ("rows", "checksum", "columns"))


def _measured(run: Run, name: str, entry: Mapping) -> dict:
    """What the files of a section hold now."""
    schema = T.StructType.fromJson(json.loads(entry["columns"]))
    frame = run.spark.read.schema(schema).parquet(run.folder(name, entry["version"]))
    return frame.agg(*[v.alias(k) for k, v in content(frame).items()]).first().asDict() | {"columns": entry["columns"]}


def _holds(run: Run, name: str, source: Mapping) -> bool:
    """Whether a section was copied from this version and its files still hold the same."""
    entry = run.sections().get(name)
    if entry is None or entry.get("source") != source["version"]:
        return False
    if not files.exists(run.spark, run.folder(name, entry["version"])):
        return False
    try:
        return not _differs(_measured(run, name, entry), source)
    except (PySparkException, Py4JJavaError):  # files that cannot be read
        return False


def write_bundle(spark: SparkSession, results: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write several sections under one path, with a manifest of their order, columns and rows, which comes last.

    Text files hold every value without loss, see ``to_cells``.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"format must be parquet or csv, got {fmt!r}")
    manifest = []
    for position, (name, frame) in enumerate(results.items()):
        told = Observation()
        shown = (to_cells(frame, name) if fmt == "csv" else frame).observe(told, F.count("*").alias("rows"))
        writer = shown.write.mode("overwrite").format(fmt)
        (writer.options(**CSV) if fmt == "csv" else writer).save(_place(path, f"sections/{name}"))
        manifest.append((position, name, frame.schema.json(), told.get["rows"]))
    (
        spark.createDataFrame(manifest, "position int, section string, columns string, rows long")
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(_place(path, "manifest"))
    )


def read_bundle(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All sections of a bundle by name, in the order they were written; rows that are missing or too many raise."""
    manifest = spark.read.parquet(_place(path, "manifest")).orderBy("position").collect()
    sections = {}
    for row in manifest:
        schema, place = T.StructType.fromJson(json.loads(row["columns"])), _place(path, f"sections/{row['section']}")
        if fmt == "csv":
            cells = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
            frame = from_cells(spark.read.schema(cells).options(**CSV, mode="FAILFAST").csv(place), schema)
        else:
            frame = spark.read.schema(schema).parquet(place)
        if frame.count() != row["rows"]:
            raise ValueError(f"section {row['section']!r} has {frame.count()} rows, its manifest {row['rows']}")
        sections[row["section"]] = frame
    return sections


#: Cells keep their blanks, and a quote within one is doubled.
CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: What a cell cannot hold as it is, and how it is told; the backslash is told first and read last.
TOLD = {"\\": "\\b", "\n": "\\n", "\r": "\\r", "\0": "\\0"}
NULL_CELL, EMPTY_CELL = "\\N", "\\E"


def to_cells(frame: DataFrame, name: str = "") -> DataFrame:
    """Every value as text from which ``from_cells`` makes the same value again.

    A null is ``\\N`` and an empty text ``\\E``; line breaks, zero characters and backslashes are told by a backslash
    and a letter. Times with a zone are microseconds since 1970, bytes are base64. Nested columns are refused.
    """
    cells = []
    for field in frame.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise ValueError(f"column {field.name!r} of {name!r} is nested and has no text form")
        if isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.BinaryType):
            column = F.base64(column)
        text = column.cast("string")
        for raw, told in TOLD.items():
            text = F.replace(text, F.lit(raw), F.lit(told))
        text = F.when(text == "", F.lit(EMPTY_CELL)).otherwise(text)
        cells.append(F.coalesce(text, F.lit(NULL_CELL)).alias(field.name))
    return frame.select(*cells)


def from_cells(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """The values that ``to_cells`` told, in the types of ``schema``; text that is no such value raises."""
    values = []
    for field in schema.fields:
        cell, kind = F.col(f"`{field.name}`"), field.dataType
        text = cell
        for raw, told in reversed(TOLD.items()):
            text = F.replace(text, F.lit(told), F.lit(raw))
        text = F.when(cell == NULL_CELL, None).when(cell == EMPTY_CELL, F.lit("")).otherwise(text)
        if isinstance(kind, T.TimestampType):
            value = F.timestamp_micros(text.cast("long"))
        elif isinstance(kind, T.BinaryType):
            value = F.unbase64(text)
        else:
            value = text.cast(kind)
        values.append(value.alias(field.name))
    return cells.select(*values)
