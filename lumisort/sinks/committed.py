"""A keyed table that can be written again and again: one row a key, whatever is repeated or dies.

    path/data/run=<attempt>/...   rows of one attempt to write a run (Parquet)
    path/commits/<version>.json   one line: run id, attempt, mode

A run's rows count from the moment its commit file exists, which is created once and never
overwritten; attempts that died before leave a folder that nobody reads (``clean`` removes it).
A run id that is committed is not written again, so a job or a micro-batch can be repeated.
``append`` skips rows whose key is there already, ``replace`` hides the older ones, ``compact``
folds all versions into one.  Writers that meet take consecutive versions: the later one
looks at what the earlier one wrote before it tries again.

The file system must create files atomically if asked not to overwrite (HDFS and object stores
with conditional writes do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("append", "replace", "snapshot")


class CommittedTable:
    """``key``: columns that identify a row; ``schema``: DDL of the rows; ``partition_by``: folder columns within a run."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.key, self.partition_by = spark, path.rstrip("/"), list(key), list(partition_by)
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names
        missing = {*self.key, *self.partition_by} - set(self.columns)
        if missing:
            raise ValueError(f"not in the schema: {sorted(missing)}")
        if "run" in self.columns:
            raise ValueError("'run' names the attempt; rename that column")

    # -- files

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def commits(self) -> list[dict]:
        """All commits in order: version, run, attempt, mode."""
        if not any(n.endswith(".json") for n in self._names("commits")):
            return []
        rows = (self.spark.read.schema("version long, run string, attempt string, mode string")
                .option("pathGlobFilter", "*.json").json(f"{self.path}/commits").where("run is not null").collect())
        return sorted((r.asDict() for r in rows), key=lambda c: c["version"])

    def _commit(self, version: int, run: str, attempt: str, mode: str) -> bool:
        """False if another writer has taken this version."""
        fs, p = self._fs(f"{self.path}/commits/{version:012d}.json")
        if fs.exists(p):
            return False
        from py4j.protocol import Py4JJavaError
        try:
            out = fs.create(p, False)
        except Py4JJavaError:
            if fs.exists(p):
                return False
            raise
        out.write(bytearray((json.dumps({"version": version, "run": run, "attempt": attempt, "mode": mode}) + "\n").encode()))
        out.close()
        return True

    # -- reading

    def read(self) -> DataFrame:
        """The committed rows, one a key."""
        return self._read(self.commits()).select(*self.columns)

    def _read(self, commits: list[dict]) -> DataFrame:
        """Rows of the commits since the last snapshot with their version, without those replaced later."""
        since = max((c["version"] for c in commits if c["mode"] == "snapshot"), default=0)
        live = [c for c in commits if c["version"] >= since]
        if not live:
            return self.spark.createDataFrame([], self.schema).withColumn("_version", F.lit(None).cast("long"))
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])
        rows = (self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/run={c['attempt']}" for c in live]))
        version = F.create_map(*[x for c in live for x in (F.lit(c["attempt"]), F.lit(c["version"]))])
        rows = rows.withColumn("_version", version[F.col("run")]).drop("run")
        replacing = [c["version"] for c in live if c["mode"] == "replace"]
        if not replacing:
            return rows
        newer = rows.where(F.col("_version").isin(replacing)).select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)], F.col("_version").alias("_newer"))
        same = F.col("_version") < F.col("_newer")
        for i, c in enumerate(self.key):
            same &= rows[c].eqNullSafe(F.col(f"_k{i}"))
        return rows.join(newer, same, "left_anti")

    def keys(self) -> DataFrame:
        """Keys of the committed rows; no other column is read."""
        return self.read().select(*self.key)

    # -- writing

    def append(self, df: DataFrame, run: str | None = None) -> bool:
        """Commits the rows of ``df`` whose key is not in the table yet, one a key.  False if ``run`` (any
        text, by default a new one) was committed before: nothing is written then."""
        return self._write(df, run, "append")

    def replace(self, df: DataFrame, run: str | None = None) -> bool:
        """As ``append``, but rows of ``df`` take the place of older ones with their key."""
        return self._write(df, run, "replace")

    def compact(self) -> bool:
        """Writes all rows as one run; older attempts are not read any more."""
        return self._write(None, None, "snapshot")

    def _write(self, df: DataFrame | None, run: str | None, mode: str) -> bool:
        run = run or uuid.uuid4().hex
        source, seen = df, 0
        while True:
            commits = self.commits()
            if any(c["run"] == run for c in commits):
                return False
            attempt = uuid.uuid4().hex
            rows = self._read(commits).drop("_version") if mode == "snapshot" else source.select(*self.columns).dropDuplicates(self.key)
            if mode == "append":
                rows = self._without_known(rows, [c for c in commits if c["version"] > seen], commits)
            self._write_attempt(rows, attempt)
            version = (commits[-1]["version"] if commits else 0) + 1
            if self._commit(version, run, attempt, mode):
                return True
            if mode == "append":  # what is written already needs a look at the newer commits only
                source = self._attempt(attempt)
                seen = commits[-1]["version"] if commits else 0

    def _without_known(self, rows: DataFrame, newer: list[dict], commits: list[dict]) -> DataFrame:
        if not newer:
            return rows
        known = self._read(commits).where(F.col("_version") >= newer[0]["version"]).select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)])
        same = None
        for i, c in enumerate(self.key):
            e = rows[c].eqNullSafe(known[f"_k{i}"])
            same = e if same is None else same & e
        return rows.join(known, same, "left_anti")

    def _write_attempt(self, rows: DataFrame, attempt: str) -> None:
        w = rows.write.mode("error")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(f"{self.path}/data/run={attempt}")

    def _attempt(self, attempt: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/run={attempt}")

    def clean(self) -> int:
        """Removes folders of attempts that no live commit names: of writers that died and of versions before a snapshot.
        Only while no other writer is at work.  Returns how many."""
        commits = self.commits()
        since = max((c["version"] for c in commits if c["mode"] == "snapshot"), default=0)
        live = {f"run={c['attempt']}" for c in commits if c["version"] >= since}
        gone = [n for n in self._names("data") if n.startswith("run=") and n not in live]
        for n in gone:
            fs, p = self._fs(f"{self.path}/data/{n}")
            fs.delete(p, True)
        return len(gone)


def feature_table(spark: SparkSession, path: str, partition_by: Sequence[str] = ("split", "label_name")) -> CommittedTable:
    """The committed form of the feature table: one row per image (split, class, name)."""
    return CommittedTable(spark, path, ("split", "label_name", "file_name"),
                          "file_name string, label_name string, split string, features array<double>, error string", partition_by)
