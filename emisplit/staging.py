"""Tables that a run writes once and reads often, in a folder that driver and executors share.

Weights are written bucketed and sorted by profile, so whatever a plan does per profile afterwards (totals, joins with what
has one row per profile, sums) needs no shuffle. Profiles of more than
``grouping.WHOLE`` rows would make one bucket, hence one task, too large: their rows are written apart, cut into
shares, and go through the totals of ``emisplit.functions.grouping`` that work on shares. Both
parts run the same chain of operators.

A written table also ends a plan's lineage: a lost executor costs no work from before it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emisplit.functions import grouping, salted, splittable


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="speciation-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def observed(rows: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation | None]:
    """``rows`` whose next action also works out ``metrics``."""
    if not metrics:
        return rows, None
    seen = Observation()
    return rows.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen


def written(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write ``rows`` and read them back; aggregates over them come from the same job."""
    path = new_folder(rows.sparkSession, name)
    rows, seen = observed(rows, metrics)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), _metrics(seen)


def _metrics(seen: Observation | None) -> dict:
    # An empty input may leave a metric out.
    return {name: value or 0 for name, value in seen.get.items()} if seen else {}


def bucketed(rows: DataFrame, name: str, keys: list[str], buckets: int | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """As ``written``, in sorted buckets by ``keys``: by default one for each shuffle partition of the session.

    Rows that a shuffle by the keys brought in then go straight to their buckets, one file each.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    table = f"{name}_{uuid.uuid4().hex}"
    rows, seen = observed(rows, metrics)
    writer = rows.write.format("parquet").option("path", new_folder(spark, name))
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table), _metrics(seen)


def hadoop(spark: SparkSession, path: str):
    """(path, its file system) of the JVM's file API."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    where, system = hadoop(spark, path)
    return [f.getPath().getName() for f in system.listStatus(where) if f.isDirectory()]


def _folders(rows: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in rows.inputFiles()}


def forget(rows: DataFrame) -> None:
    """Delete the files of a ``written`` or ``bucketed`` table that nothing reads any more."""
    spark = rows.sparkSession
    for folder in _folders(rows):
        path, system = hadoop(spark, folder)
        if path.toUri().getPath().startswith(hadoop(spark, shared_folder(spark))[0].toUri().getPath()):
            system.delete(path, True)


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``; both are in one file system."""
    old, system = hadoop(spark, source)
    new, _ = hadoop(spark, target)
    if system.exists(new):
        system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} can't be moved to {target}")


def published(rows: DataFrame, target: str) -> DataFrame:
    """Move a ``written`` or ``bucketed`` table to ``target`` and read it there."""
    spark = rows.sparkSession
    folders = _folders(rows)
    one_system = all(hadoop(spark, f)[1].getUri() == hadoop(spark, target)[1].getUri() for f in folders)
    if len(folders) == 1 and one_system:
        moved(spark, folders.pop(), target)
    else:
        rows.write.mode("overwrite").parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


# ---------------------------------------------------------------- weights


@dataclass(frozen=True)
class Staged:
    """Weights as they were written: whole profiles, and those cut into shares if there are any."""

    whole: DataFrame
    shares: DataFrame | None
    counts: dict

    def each(self, chain: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``chain`` on both parts. Rows of ``shares`` have a ``salt``; the chain carries it and may end without it."""
        parts = [chain(p) for p in (self.whole, self.shares) if p is not None]
        return reduce(DataFrame.unionByName, [p.drop("salt") for p in parts])

    def rows(self) -> DataFrame:
        return self.each(lambda part: part)


def _large(weights: DataFrame, rows: int) -> DataFrame | None:
    """Profiles with more of the ``rows`` weights than a window should take, or None; counted before the shuffle.

    Profiles are counted together by hash first: where no bin has too many rows, no profile has. Only
    the bins that do are counted profile by profile.
    """
    if rows <= grouping.WHOLE:
        return None
    bins = max(1, rows // max(1, grouping.WHOLE // 16))
    binned = weights.select("profile_id", F.pmod(F.xxhash64("profile_id"), F.lit(bins)).alias("bin"))
    full, found = written(binned.groupBy("bin").agg(F.count("*").alias("rows")).where(F.col("rows") > grouping.WHOLE), "bins", full_bins=F.count("*"))
    if not found["full_bins"]:
        return None
    sizes = binned.join(full, "bin", "left_semi").groupBy("profile_id").agg(F.count("*").alias("rows"))
    large, found = written(sizes.where(F.col("rows") > grouping.WHOLE).select("profile_id"), "large", profiles=F.count("*"))
    return large if found["profiles"] else None


def staged(
    weights: DataFrame, select: Callable[[DataFrame], DataFrame], chain: Callable[[DataFrame], DataFrame], name: str, metrics: dict[str, Column]
) -> Staged:
    """Write what ``chain`` makes of the rows that ``select`` takes from ``weights``, profile by profile.

    The weights may be derived at any cost, so they are worked out once: written as they come, counted and
    selected from there. ``select`` gives not more rows than there are weights. ``metrics`` are counts over the result.
    """
    given, seen = written(weights, f"{name}-given", given_rows=F.count("*"))
    rows = select(given)
    large = _large(given, seen["given_rows"])
    if large is None:
        whole, counts = bucketed(chain(rows), name, ["profile_id"], **metrics)
        done = Staged(whole, None, {name: counts.get(name, 0) for name in metrics})
    else:
        listed = splittable(large, "profile_id")
        whole, counts = bucketed(chain(rows.join(listed, "profile_id", "left_anti")), name, ["profile_id"], **metrics)
        shares = chain(salted(rows.join(listed, "profile_id", "left_semi"), "specie_id"))
        shares, more = written(shares, f"{name}-shares", **metrics)
        done = Staged(whole, shares, {name: counts.get(name, 0) + more.get(name, 0) for name in metrics})
    forget(given)
    return done


@dataclass
class Stages:
    """What the batches of a run have staged, found again by the plans of the tables it was made of."""

    done: list[tuple[tuple, list, Staged]] = field(default_factory=list)

    def get(self, key: tuple, tables: list[DataFrame | None], make: Callable[[], Staged]) -> Staged:
        for known, sources, result in self.done:
            if known == key and all(
                a is b or (a is not None and b is not None and a.sameSemantics(b)) for a, b in zip(sources, tables, strict=True)
            ):
                return result
        self.done.append((key, tables, make()))
        return self.done[-1][2]
