"""Helpers of the text operators: inputs, staged tables, held-out folds and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.session import settings

T = TypeVar("T")
_own_folder: dict[str, str] = {}
_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gives, made once per Python worker. A worker keeps one thing only, so stages that follow each other do not add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Drop what the worker keeps of another operator."""
    _kept.clear()


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """The named columns of a given table; only they reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one is made up on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    return _own_folder[app]


def staged(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back: lineage ends there, so a lost executor costs its own tasks only."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)  # what was shuffled for it is of no more use
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        files = df.inputFiles()
        if files and "/stage-" in files[0]:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. A null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached over undirected edges (a, b); nodes without an edge do not appear.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each a combined
    minimum per node and a join, so no node's neighbours are ever gathered in one place
    and a node with very many edges is split by the adaptive skew join. Rounds stop when the table repeats itself.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    tree = staged(edges.where(F.col("a") != F.col("b")).select(high.alias("child"), low.alias("parent")).distinct())
    before = None
    while True:
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return tree.select(F.col("child").alias("node"), F.col("parent").alias("root")).union(
                tree.select("parent", "parent").distinct()
            )
        before = now
        both = tree.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(tree.select("parent", "child"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct()
        lowest = large.groupBy("child").agg(F.min("parent").alias("m"))
        pairs = F.explode(F.array(F.struct("child", F.col("m").alias("parent")), F.struct(F.col("parent").alias("child"), F.col("m").alias("parent"))))
        small = large.join(lowest, "child").select(pairs.alias("pair")).select("pair.child", "pair.parent")
        following = staged(small.where("child != parent").distinct())
        unstage(tree)
        tree = following
