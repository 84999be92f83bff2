"""Session settings the reports are planned for."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Sequence
from datetime import timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession

from bondscope import files

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "bondscope", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Folders of local sessions that name none, by application.
_OWN_FOLDERS: dict[str, str] = {}


def configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def staging_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local session without one gets a folder of its own."""
    folder = configured_folder(spark)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_FOLDERS:
            _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="bondscope-")
        folder = _OWN_FOLDERS[app]
    return folder.rstrip("/")


#: Leases of this application, by the place they stand for.
_LEASES: dict[str, str] = {}


def take_lease(spark: SparkSession, place: str) -> None:
    """Note in the shared folder that this application uses ``place``, so that a later one can sweep it."""
    record = f"{staging_folder(spark)}/leases/{uuid4().hex}.json"
    told = {"application": spark.sparkContext.applicationId, "place": place, "time": time.time()}
    files.write_record(spark, record, told)
    _LEASES[place] = record


def end_lease(spark: SparkSession, place: str) -> None:
    """Remove a place and its lease; the place goes first, so that nothing is left without a lease."""
    files.remove(spark, place)
    record = _LEASES.pop(place, None)
    if record is not None:
        files.remove(spark, record)


def renew_leases(spark: SparkSession) -> None:
    """Note anew that this application is at work, before the age at which others sweep."""
    for place, record in list(_LEASES.items()):
        take_lease(spark, place)
        files.remove(spark, record)


def sweep(spark: SparkSession, older: timedelta = timedelta(days=7)) -> list[str]:
    """Remove what applications that ended without cleaning up left in the shared folder; returns the places.

    Only places whose lease is ``older`` and not of this application go; an application that runs longer than that
    calls ``renew_leases``.
    """
    folder, swept = f"{staging_folder(spark)}/leases", []
    for name in files.names_in(spark, folder):
        if not name.endswith(".json") or name.startswith("."):
            continue
        lease = files.read_record(spark, f"{folder}/{name}")
        if lease["application"] == spark.sparkContext.applicationId or lease["time"] > time.time() - older.total_seconds():
            continue
        files.remove(spark, lease["place"])
        files.remove(spark, f"{folder}/{name}")
        swept.append(lease["place"])
    return swept


def own_database(spark: SparkSession) -> str:
    """A new database in the shared folder; its files go with the session at the latest, or with a later ``sweep``."""
    name = f"bondscope_{uuid4().hex}"
    place = f"{staging_folder(spark)}/{name}"
    take_lease(spark, place)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    files.remove_at_end(spark, place)
    return name


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new place in the shared folder; it goes with the session at the latest, or with a later ``sweep``."""
    place = f"{staging_folder(spark)}/{kind}-{uuid4().hex}"
    take_lease(spark, place)
    files.remove_at_end(spark, place)
    return place


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    end_lease(spark, f"{staging_folder(spark)}/{name}")


def _observed(frame: DataFrame, told: Observation, measures: dict[str, Column]) -> DataFrame:
    return frame.observe(told, *[value.alias(key) for key, value in measures.items()])


class Staging:
    """Frames several sections read, computed once and kept where lost executors do no harm.

    ``table`` writes a frame to the shared folder as a table bucketed and sorted by its key. Later
    plans start from the written columns they need, know their true size, and join and group by
    the key without a shuffle. Small frames are persisted; lost blocks are computed again from the
    written tables.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.database: str | None = None
        self.tables: list[str] = []
        self.kept: list[DataFrame] = []

    def table(self, frame: DataFrame, name: str, key: str, *then: str) -> DataFrame:
        """Stage a frame whose size grows with the input, partitioned by ``key``."""
        return self._written(self._bucketed(frame, key, then), name)

    def measured_table(self, frame: DataFrame, name: str, key: str, *then: str, **measures: Column) -> tuple[DataFrame, dict]:
        """Like ``table``, and measure the frame in the same job."""
        told = Observation()
        return self._written(self._bucketed(_observed(frame, told, measures), key, then), name), told.get

    def measured(self, frame: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
        """Stage a frame and measure it in the same job."""
        told = Observation()
        return self._written(_observed(frame, told, measures).write, name), told.get

    def _bucketed(self, frame: DataFrame, key: str, then: Sequence[str]) -> DataFrameWriter:
        return frame.write.bucketBy(shuffle_partitions(self.spark), key).sortBy(key, *then)

    def _written(self, writer: DataFrameWriter, name: str) -> DataFrame:
        if self.database is None:
            self.database = own_database(self.spark)
        full = f"{self.database}.{name}"
        writer.format("parquet").saveAsTable(full)
        self.tables.append(full)
        return self.spark.table(full)

    def keep(self, frame: DataFrame) -> DataFrame:
        """Persist a small frame."""
        self.kept.append(frame.persist())
        return frame

    def forget(self) -> None:
        """Let persisted frames go; written tables stay."""
        for frame in reversed(self.kept):
            frame.unpersist()
        self.kept.clear()

    def release(self) -> None:
        """Let persisted frames go and remove the written tables."""
        self.forget()
        if self.database is not None:
            drop_database(self.spark, self.database)
            self.database = None
            self.tables.clear()
