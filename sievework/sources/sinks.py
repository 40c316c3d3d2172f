"""JSON lines, collections of chunks, checkpoints, rejects."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


class CollectionExistsError(RuntimeError):
    """The collection is there and replacing it was not asked for."""


class CollectionMissingError(RuntimeError):
    """The collection isn't there or is empty."""


def write_jsonl(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "append") -> None:
    """One JSON object a line, partitioned by ``by``; append by default, as runs add to their output."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, strict: bool = True) -> DataFrame:
    """Blank lines are skipped; a malformed line fails the read, or is dropped if not ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


#: A line of the evaluation set; its metadata as they are, as the domains differ.
GOLDEN = "messages array<struct<role:string,content:string>>, expected_behaviours array<string>, red_flags array<string>, metadata map<string,string>"


def golden_set(spark: SparkSession, path: str) -> DataFrame:
    """The evaluation set, one row an example, with ``example``, the digest of its messages, as the format has no key."""
    return read_jsonl(spark, path, GOLDEN).withColumn("example", F.sha2(F.to_json("messages"), 256))


def golden_checks(golden: DataFrame) -> DataFrame:
    """example, kind (expected_behaviour or red_flag), pos, text: the two lists of the evaluation set, exploded."""
    one = lambda c, kind: golden.select("example", F.lit(kind).alias("kind"), F.posexplode(c).alias("pos", "text"))
    return one("expected_behaviours", "expected_behaviour").unionByName(one("red_flags", "red_flag"))


def split_rejected(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows by whether ``reason`` is null."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def write_rejected(df: DataFrame, path: str) -> None:
    """Rejected rows with the time of the write, as text in UTC."""
    write_jsonl(df.withColumn("timestamp", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")), path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def index_chunks(chunks: DataFrame, path: str, force: bool = False) -> None:
    """A collection partitioned by domain; an existing one is an error, or replaced with ``force``."""
    if exists(chunks.sparkSession, path) and not force:
        raise CollectionExistsError(path)
    chunks.write.mode("overwrite").partitionBy("domain").parquet(path)


def open_collection(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    """The collection, or one domain of it (a partition, so nothing else is read). Missing or empty is an error."""
    if not exists(spark, path):
        raise CollectionMissingError(f"no collection at {path}")
    df = spark.read.parquet(path)
    if domain is not None:
        df = df.where(F.col("domain") == domain)
    if not df.limit(1).count():
        raise CollectionMissingError(f"the collection at {path} is empty")
    return df


class Checkpoint:
    """The last index that is done, replaced as a whole by a rename."""

    def __init__(self, folder: str | Path):
        self.path = Path(folder) / "checkpoint.json"

    def save(self, index: int) -> None:
        if index < 0:
            raise ValueError("an index is at least 0")
        self.path.parent.mkdir(parents=True, exist_ok=True)
        handle, name = tempfile.mkstemp(dir=self.path.parent)
        with os.fdopen(handle, "w") as f:
            json.dump({"index": index}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, self.path)

    def load(self) -> int:
        """The index; FileNotFoundError without a checkpoint, ValueError for one that can't be read."""
        value = json.loads(self.path.read_text())
        if not isinstance(value, dict) or not isinstance(value.get("index"), int) or value["index"] < 0:
            raise ValueError(f"not a checkpoint: {self.path}")
        return value["index"]

    def clear(self) -> None:
        self.path.unlink(missing_ok=True)


class Lock:
    """An exclusive lock on an output folder for one driver."""

    def __init__(self, folder: str | Path):
        self.path = Path(folder) / ".lock"
        self._file = None

    def __enter__(self) -> Lock:
        import fcntl

        self.path.parent.mkdir(parents=True, exist_ok=True)
        self._file = self.path.open("w")
        try:
            fcntl.flock(self._file, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError:
            self._file.close()
            self._file = None
            raise RuntimeError(f"locked by another run: {self.path}") from None
        return self

    def __exit__(self, *_: object) -> None:
        if self._file:
            self._file.close()
            self._file = None


def prepare_output(folder: str | Path, resume: bool) -> None:
    """A fresh run removes what is in the folder but the lock; a resumed one keeps it."""
    import shutil

    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    if resume:
        return
    for entry in folder.iterdir():
        if entry.name != ".lock":
            shutil.rmtree(entry) if entry.is_dir() else entry.unlink()
