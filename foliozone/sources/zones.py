"""A zone: stored metadata and objects, appended run by run on plain Parquet.

A run writes ``objects/run=ID``, then ``metadata/run=ID``, under a name of its own, then one commit
file whose name is the next number. The file is created only if it is not there, so of two runs
that end at once one takes the number and the other looks again. Readers only look at committed
runs: metadata never points at missing objects, and a run that died half-way is invisible. A run
that changed nothing commits nothing.

Metadata is bucketed by identifier, which the newest version per key, the change check and look-ups
of few keys make use of: none of them moves stored rows. Keys carry Bloom filters and are sorted in
their files, so a look-up reads the row groups that may hold one and skips the others.

Runs may overlap, such as one run per cell. If a run that committed meanwhile wrote a key that this
one writes too, this one's decisions are stale: it is refused with ``CommitConflict``, its folders are
removed, and the keys that meet have to be decided again. Otherwise both are kept.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.functions import dates, keys
from foliozone.operators.changes import KEY
from foliozone.session import create_new, remove, stage

_COMMITS = "run_seq BIGINT, run STRING, kind STRING, replaces ARRAY<STRING>, buckets INT"

#: Metadata buckets of a new zone: as many as its metadata will have times 200 MB, and no fewer than a
#: session's shuffle partitions.
BUCKETS = 16
#: So many keys are asked for by name, which prunes; more of them by a join.
FEW = 1000


class CommitConflict(RuntimeError):
    """Another run committed what this one decided on."""


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def period_of(decision_date: Column) -> Column:
    """The directory an object's row lies in, so that a date range reads only its own months."""
    return F.date_format(decision_date, "yyyy-MM")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version per key. Spark limits each group to one row before the shuffle too."""
    newest = Window.partitionBy(*keys).orderBy(F.col("run_seq").desc())
    return rows.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


HTML, OTHER = "html", "other"
OBJECT_FOLDERS = ["body_code", "kind", "period"]


def kind_of(content_type: Column) -> Column:
    return F.when(keys.is_html(content_type), HTML).otherwise(OTHER)


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


@dataclass(frozen=True)
class Snapshot:
    """A zone as of its last commit: whatever is appended later is not seen."""

    spark: SparkSession
    root: str
    names: tuple[tuple[int, str], ...]  # number and folder of each run that counts
    last: int = 0  # the highest number taken
    buckets: int = BUCKETS

    @property
    def runs(self) -> tuple[int, ...]:
        return tuple(number for number, _ in self.names)

    def _numbered(self, rows: DataFrame, schema: str) -> DataFrame:
        """Rows of the runs that count, with their numbers: one small row a run is the join side."""
        runs = self.spark.createDataFrame([*self.names], "run_seq BIGINT, run STRING")
        inside = rows.filter("run IN (" + ", ".join(f"'{run}'" for _, run in self.names) + ")")
        return inside.join(F.broadcast(runs), "run").select(*_columns(schema))

    def metadata(self) -> DataFrame:
        if not self.names:
            return self.spark.createDataFrame([], schemas.METADATA)
        name = _metadata_table(self.spark, self.root, self.buckets)
        self.spark.catalog.refreshTable(name)
        return self._numbered(self.spark.table(name), schemas.METADATA)

    def since(self, before: Snapshot) -> DataFrame:
        """Metadata rows of the runs that came after another snapshot."""
        newer = tuple(sorted(set(self.names) - set(before.names)))
        return Snapshot(self.spark, self.root, newer, self.last, self.buckets).metadata()

    def objects(self) -> DataFrame:
        """All object versions, payload included; select before use."""
        if not self.names:
            return self.spark.createDataFrame([], schemas.OBJECTS)
        rows = self.spark.read.schema(schemas.OBJECTS.replace("run_seq BIGINT", "run STRING")).parquet(f"{self.root}/objects")
        return self._numbered(rows, schemas.OBJECTS)

    def object_ids(self) -> DataFrame:
        return self.objects().drop("payload")

    def current(self, body_codes: tuple[str, ...] | None = None) -> DataFrame:
        """The stored record per key. Bodies are part of the key and prune directories; any other
        filter belongs above, since a newer version may carry another date."""
        rows = self.metadata()
        if body_codes:
            rows = rows.filter(F.col("body_code").isin(*sorted(set(body_codes))))
        return latest(rows, KEY)

    def current_objects(self) -> DataFrame:
        """The newest version per object key, without payloads."""
        return latest(self.object_ids(), ["object_key"])

    def find(self, asked: DataFrame) -> DataFrame:
        """Stored records for a table of ``(body_code, identifier)``.

        Up to ``FEW`` keys read their own directories, buckets and row groups; more are joined.
        """
        wanted = asked.select(*KEY)
        few = wanted.limit(FEW + 1).collect()
        if len(few) > FEW:
            return self.current().join(wanted, KEY, "left_semi")
        bodies, names = (sorted({r[c] for r in few if r[c] is not None}) for c in KEY)
        rows = self.metadata().filter(F.col("body_code").isin(bodies) & F.col("identifier").isin(names))
        return latest(rows, KEY).join(F.broadcast(wanted), KEY, "left_semi")

    def in_range(self, start, end, body_codes=None, source_name: str | None = None) -> DataFrame:
        """Current records with ``start <= decision_date < end``, oldest first."""
        return range_scan(self.current(body_codes), start, end, source_name).orderBy("decision_date")

    def existing(self, asked: DataFrame) -> DataFrame:
        """Those of the given object keys that are stored; up to ``FEW`` keys read only row groups that may hold one."""
        stored = self.object_ids().select("object_key")
        few = asked.select("object_key").limit(FEW + 1).collect()
        if len(few) <= FEW:
            stored = stored.filter(F.col("object_key").isin(sorted({r[0] for r in few if r[0] is not None})))
        return asked.join(stored, "object_key", "left_semi")


def _point_reads(column: str) -> dict[str, str]:
    """Writer options of a column that is looked up; the filter's size follows the number of keys."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _metadata_table(spark: SparkSession, root: str, buckets: int) -> str:
    """The name of the session's table over a zone's metadata: Spark reads buckets through one only.

    It holds no state: rows are what lies in the folders.
    """
    name = "foliozone_" + hashlib.sha256(f"{buckets} {root}".encode()).hexdigest()[:32]
    if not spark.catalog.tableExists(name):
        data = [c for c in schemas.METADATA.split(", ") if c.split()[0] not in ("run_seq", "body_code")]
        listed = "spark.sql.hive.manageFilesourcePartitions"
        usual = spark.conf.get(listed)
        spark.conf.set(listed, "false")  # partitions are the folders that are there
        try:
            place = f"{root}/metadata".replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(data)}, run STRING, body_code STRING) USING parquet "
                f"PARTITIONED BY (run, body_code) CLUSTERED BY (identifier) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
        finally:
            spark.conf.set(listed, usual)
    return name


@dataclass(frozen=True)
class Zone:
    """One zone under a root path on shared storage. Any number of writers and readers."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS  # of a new zone; a stored one keeps its own

    def _committed(self) -> Snapshot:
        """One small row per run; ``vacuum`` removes those that a compaction replaced."""
        commits = read_or_empty(self.spark, f"{self.root}/commits", _COMMITS, "json").collect()
        replaced = {run for c in commits for run in c["replaces"] or ()}
        live = sorted((c["run_seq"], c["run"]) for c in commits if c["run"] not in replaced)
        last = max((c["run_seq"] for c in commits), default=0)
        return Snapshot(self.spark, self.root, tuple(live), last, next((c["buckets"] for c in commits), self.buckets))

    def snapshot(self) -> Snapshot:
        """Committed runs, without those a compaction replaced."""
        # a join by body and identifier may use rows that lie by identifier
        self.spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        return self._committed()

    def append(self, before: Snapshot, objects: DataFrame, metadata: DataFrame, kind: str = "run", dealt: bool = False) -> int:
        """Objects first, metadata second, visible last. ``before``: what the rows were decided on.

        Rows are gathered by directory before the write, so that a run does not leave one file
        per task and directory; the rebalance splits directories that hold much and joins small
        ones. Only rows to be written pay for it, and none whose objects are ``dealt`` already.
        """
        run = uuid.uuid4().hex
        self._write(run, objects, dealt)
        self._write_metadata(run, metadata, before.buckets)
        try:
            return self._publish(before, run, kind)
        except CommitConflict:
            self._remove(run)
            raise

    def _write(self, run: str, objects: DataFrame, dealt: bool) -> None:
        shaped = objects.select(*(c for c in _columns(schemas.OBJECTS) if c != "run_seq"))
        gathered = shaped if dealt else shaped.hint("rebalance", *OBJECT_FOLDERS)
        ordered = gathered.sortWithinPartitions(*OBJECT_FOLDERS, "object_key")
        ordered.write.options(**_point_reads("object_key")).partitionBy(*OBJECT_FOLDERS).parquet(f"{self.root}/objects/run={run}")

    def _write_metadata(self, run: str, rows: DataFrame, buckets: int) -> None:
        """Every task writes one bucket. The table is a run's own, as writers of one table meet in its folder."""
        shaped = rows.select(*(c for c in _columns(schemas.METADATA) if c != "run_seq")).repartition(buckets, "identifier")
        name, writer = f"foliozone_{run}", shaped.write.format("parquet").options(**_point_reads("identifier"))
        writer.partitionBy("body_code").bucketBy(buckets, "identifier").sortBy("identifier").option("path", f"{self.root}/metadata/run={run}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    def _publish(self, before: Snapshot, run: str, kind: str) -> int:
        """Take the next number, unless a run that came in between makes this one stale."""
        while True:
            now = self._committed()
            newer = tuple(sorted(set(now.names) - set(before.names)))
            gone = set(before.names) - set(now.names)
            if kind == "compaction" and (newer or gone):
                raise CommitConflict(f"{self.root}: {len(newer)} runs were committed during the compaction")
            if now.names and now.buckets != before.buckets:
                raise CommitConflict(f"{self.root}: a run committed meanwhile set {now.buckets} buckets; run again")
            if newer and self._meets(Snapshot(self.spark, self.root, newer, buckets=before.buckets), run):
                raise CommitConflict(f"{self.root}: a run committed meanwhile wrote the same keys; run again")
            number = now.last + 1
            replaces = [name for _, name in before.names] if kind == "compaction" else []
            line = json.dumps({"run_seq": number, "run": run, "kind": kind, "replaces": replaces, "buckets": before.buckets})
            if create_new(self.spark, f"{self.root}/commits/{number:012d}.json", line + "\n"):
                return number

    def _remove(self, run: str) -> None:
        for name in ("metadata", "objects"):
            remove(self.spark, f"{self.root}/{name}/run={run}")

    def _meets(self, newer: Snapshot, run: str) -> bool:
        own = self.spark.read.schema(schemas.METADATA.replace("run_seq BIGINT", "run STRING")).parquet(f"{self.root}/metadata")
        own = own.filter(F.col("run") == run).select(*KEY)
        return not newer.metadata().select(*KEY).join(own, KEY, "left_semi").isEmpty()

    def compact(self) -> int:
        """Rewrite the current state as one version, after which the older ones are not read."""
        now = self.snapshot()
        version = ["object_key", "run_seq"]
        stale = now.object_ids().select(*version).join(now.current_objects().select(*version), version, "left_anti")
        live = now.objects().join(stage(stale, "stale_objects"), version, "left_anti")
        return self.append(now, live, now.current(), "compaction")

    def vacuum(self) -> list[str]:
        """Remove the folders and commits of runs that a compaction replaced; returns their names.

        Only when no reader works on a snapshot from before the compaction. Folders of runs that
        never committed are left alone, as such a run may still be going on.
        """
        commits = read_or_empty(self.spark, f"{self.root}/commits", _COMMITS, "json").collect()
        replaced = {run for c in commits for run in c["replaces"] or ()}
        for run in replaced:
            self._remove(run)
        for c in commits:
            if c["run"] in replaced:
                remove(self.spark, f"{self.root}/commits/{c['run_seq']:012d}.json")
        return sorted(replaced)


def range_scan(records: DataFrame, start, end, source_name: str | None = None) -> DataFrame:
    wanted = dates.contains(F.col("decision_date"), F.lit(start), F.lit(end))
    if source_name is not None:
        wanted &= F.col("source_name") == source_name
    return records.filter(wanted)


def stored_only(records: DataFrame) -> DataFrame:
    """Records whose object was stored: a null or empty path drops out."""
    return records.filter(F.col("file_path") != "")


@dataclass(frozen=True)
class RunLog:
    """Summaries and failures of every run, one directory per run and table."""

    spark: SparkSession
    root: str

    def append(self, name: str, run_id: str, rows: DataFrame) -> DataFrame:
        """Write a run's rows and hand them back as stored, so that no one computes them again."""
        path = f"{self.root}/{name}/run_id={run_id}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def read(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/{name}", f"{schemas.RUN_LOG[name]}, run_ts TIMESTAMP, run_id STRING")
