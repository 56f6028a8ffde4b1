"""Tables that change in one step: data goes to a folder of the attempt's own, then one small version file names it.

``{table}/data/{partition}/publish_attempt=X/part-*.parquet`` holds what attempt X wrote; ``{table}/_versions/v0000000012.json`` lists for each
partition the attempt whose files count. A reader takes the newest version file, so it sees the table before or after a
publication, never in between; an attempt that fails on the way leaves folders that no version names. The version file
is renamed into place under a number that must be free: of two publications at the same time one wins, and the other builds its
version on the winner's and tries again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.sources.landing import _fs_path, cluster_for_write

ATTEMPT = "publish_attempt"
#: Where the session names no codec. Level 1 takes the least time, and higher ones hardly gain on keys that are hashes.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
RETRIES = 20


def codec(spark: SparkSession) -> dict[str, str]:
    return CODEC if spark.conf.get("spark.sql.parquet.compression.codec", None) is None else {}


class PublishedTable:
    """A Parquet table at ``path`` whose contents are replaced by whole partitions (or as a whole) and in one step."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ---------------------------------------------------------------- versions
    def versions(self) -> list[int]:
        p, fs = _fs_path(self.spark, f"{self.path}/_versions/v*.json")
        return sorted(int(s.getPath().getName()[1:-5]) for s in fs.globStatus(p) or [])

    def _version(self, number: int) -> dict:
        row = self.spark.read.text(f"{self.path}/_versions/v{number:010d}.json", wholetext=True).first()
        return json.loads(row[0])

    def current(self) -> dict | None:
        """The newest version: schema, partition columns and partition -> attempt; None before the first publication."""
        numbers = self.versions()
        return self._version(numbers[-1]) if numbers else None

    def exists(self) -> bool:
        return bool(self.versions())

    def _commit(self, number: int, version: dict) -> bool:
        """Put the version file in place; False if another publication took the number."""
        jvm = self.spark.sparkContext._jvm
        part, fs = _fs_path(self.spark, f"{self.path}/_versions/.{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(version).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:  # without the overwrite option a taken name fails
            context.rename(part, _fs_path(self.spark, f"{self.path}/_versions/v{number:010d}.json")[0],
                           self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:  # noqa: BLE001 - the gateway wraps every exception of the JVM
            fs.delete(part, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    # ---------------------------------------------------------------- writing
    def write_attempt(self, df: DataFrame, partitions: Sequence[str] = (), observe: tuple[Observation, list[Column]] | None = None,
                      ) -> tuple[str, list[str]]:
        """Write ``df`` as a new attempt; (attempt, partitions it has). Nothing of it is visible yet.

        ``observe``: metrics to take of the rows while they are written.
        """
        attempt = uuid.uuid4().hex
        clustered = cluster_for_write(df, partitions) if partitions else df
        if observe:  # above the exchange: a boundary-sampling pass must not be counted
            clustered = clustered.observe(observe[0], *observe[1])
        clustered.withColumn(ATTEMPT, F.lit(attempt)).write.mode("append").options(**codec(self.spark)).partitionBy(*partitions, ATTEMPT).parquet(f"{self.path}/data")
        return attempt, self._folders(attempt, partitions)

    def _folders(self, attempt: str, partitions: Sequence[str]) -> list[str]:
        pattern = "/".join([f"{p}=*" for p in partitions] + [f"{ATTEMPT}={attempt}"])
        p, fs = _fs_path(self.spark, f"{self.path}/data/{pattern}")
        names = [s.getPath().toUri().getPath() for s in fs.globStatus(p) or []]
        return ["/".join(n.split("/")[-1 - len(partitions):-1]) for n in names]

    def publish(self, df: DataFrame, partitions: Sequence[str] = (), replace: Iterable[dict] | None = None, whole: bool = False,
                observe: tuple[Observation, list[Column]] | None = None) -> int:
        """Write ``df`` and make it count; returns the version.

        Without ``partitions``, or with ``whole``, ``df`` replaces the table. With partitions it replaces those it has rows in, and
        those of ``replace`` (column -> value) too, which become empty where it has none.
        """
        partitions = list(partitions)
        attempt, folders = self.write_attempt(df, partitions, observe)
        dropped = ["/".join(f"{p}={_escaped(r[p])}" for p in partitions) for r in replace or ()]
        return self.point(df.schema, partitions, {f: attempt for f in folders}, dropped, whole or not partitions)

    def point(self, schema: StructType, partitions: Sequence[str], folders: dict[str, str], dropped: Sequence[str] = (), whole: bool = False) -> int:
        """Name written folders in a new version, on top of the newest there is."""
        for _ in range(RETRIES):
            numbers = self.versions()
            old = self._version(numbers[-1]) if numbers else {"folders": {}}
            if not whole and numbers and old["partitions"] != list(partitions):
                raise ValueError(f"{self.path} is partitioned by {old['partitions']}, not {list(partitions)}")
            kept = {} if whole else {k: v for k, v in old["folders"].items() if k not in set(dropped)}
            version = {"schema": schema.jsonValue(), "partitions": list(partitions), "folders": {**kept, **folders}}
            number = (numbers[-1] if numbers else 0) + 1
            if self._commit(number, version):
                return number
        raise RuntimeError(f"{self.path}: {RETRIES} other publications came first")

    # ---------------------------------------------------------------- reading
    def read(self, version: int | None = None, schema: StructType | None = None) -> DataFrame:
        """The table as of its newest (or given) version; ``schema`` stands in before the first publication."""
        v = self._version(version) if version is not None else self.current()
        if v is None:
            if schema is None:
                raise FileNotFoundError(f"nothing published at {self.path}")
            return self.spark.createDataFrame([], schema)
        schema = StructType.fromJson(v["schema"])
        if not v["folders"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{f + '/' if f else ''}{ATTEMPT}={a}" for f, a in v["folders"].items()]
        df = self.spark.read.schema(StructType(schema.fields).add(ATTEMPT, "string")).option("basePath", f"{self.path}/data").parquet(*map(_literal, paths))
        return df.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders that none of the newest ``keep`` versions names, and older version files; returns the folders deleted.

        Only for times without a running publication or reader of an older version.
        """
        numbers = self.versions()
        if not numbers:
            return 0
        named, partitions = set(), self._version(numbers[-1])["partitions"]
        for n in numbers[-keep:]:
            named |= {(f, a) for f, a in self._version(n)["folders"].items()}
        gone = 0
        p, fs = _fs_path(self.spark, "/".join([f"{self.path}/data", *[f"{p}=*" for p in partitions], f"{ATTEMPT}=*"]))
        for s in fs.globStatus(p) or []:
            parts = s.getPath().toUri().getPath().split("/")
            if ("/".join(parts[-1 - len(partitions):-1]), parts[-1].split("=", 1)[1]) not in named:
                fs.delete(s.getPath(), True)
                gone += 1
        for n in numbers[:-keep]:
            fs.delete(_fs_path(self.spark, f"{self.path}/_versions/v{n:010d}.json")[0], False)
        return gone


# Fixed by the partition layout: characters that a folder's name holds as %XX, and the name of a null or empty value.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _escaped(value: object) -> str:
    """A partition value as it stands in a folder's name."""
    if value is None or value == "":
        return NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in str(value))


def _literal(path: str) -> str:
    """A path without glob meaning."""
    return "".join("\\" + c if c in "{}[]*?" else c for c in path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A published table's newest version, or the plain Parquet folder at ``path``."""
    t = PublishedTable(spark, path)
    if t.exists():
        return t.read()
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
