"""Sinks: offsets tables and the two keyed index tables.

A keyed table is a folder of loads: each attempt to write a load goes to a
folder of its own (``load=N/attempt=A``) by Spark's own writer, and becomes
visible by one row in a table of commits, which the two tables of an index
share: readers see a load in both tables or in none, and a repeated load
replaces itself at once. No file is opened outside Spark, so any file system
Spark knows will do; writers of different loads do not touch each other's
folders.

Reading folds the loads to one row per key in two phases: winners are found
on narrow rows (key, load, order, place in the files), and only rows that lose
are taken out of the wide ones, which stay where they are unless many lose.
``compact`` writes the folded rows as one load of a new table when many loads
(or abandoned attempts) have gathered.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusforge.operators.dedupe import keep_first, keep_last
from corpusforge.plans.records import data_table, meta_table, typed_fields
from corpusforge.session import cut


def write_offsets(offsets: DataFrame, path: str, json_copy: str | None = None) -> None:
    """Offsets ``(doc_id, start, end)`` as Parquet, optionally also as gzip JSON lines."""
    offsets.write.mode("overwrite").parquet(path)
    if json_copy:
        offsets.write.mode("overwrite").option("compression", "gzip").json(json_copy)


def upsert(existing: DataFrame | None, batch: DataFrame, key: str = "_id",
           order: tuple[str, ...] = (), first: bool = False) -> DataFrame:
    """One row per key of both frames.

    Rows of ``batch`` replace existing ones, and within a frame the last in
    ``order`` counts; with ``first`` existing rows stay and the first counts.
    Rows of equal rank are told apart by a hash of the row, so repeated runs agree.
    """
    both = batch.withColumn("__load", F.lit(1))
    if existing is not None:
        both = existing.select(*batch.columns).withColumn("__load", F.lit(0)).unionByName(both)
    return _fold(both, key, ("__load", *order), first).drop("__load")


def _fold(rows: DataFrame, key: str, order: tuple[str, ...], first: bool) -> DataFrame:
    # Order columns may be the key itself or be wanted in the result: ranks get names of their own.
    ranked = rows.withColumn("__tie", F.xxhash64(*rows.columns))
    ranked = ranked.withColumns({f"__o{i}": F.col(c) for i, c in enumerate(order)})
    ranks = [f"__o{i}" for i in range(len(order))]
    pick = keep_first if first else keep_last
    return pick(ranked, key, [*ranks, "__tie"]).select(*rows.columns)


COMMITS_SCHEMA = "load long, attempt string, at long"


def _load_path(path: str, load: int, attempt: str) -> str:
    return f"{path.rstrip('/')}/load={int(load)}/attempt={attempt}"


def _commits_path(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"  # readers of a table skip names that begin so


def new_attempt() -> str:
    return f"a-{uuid.uuid4().hex}"


def commit_load(spark: SparkSession, commits_path: str, load: int, attempt: str) -> None:
    """Make an attempt the visible one of its load: one row in one file, which appears as a whole."""
    row = spark.createDataFrame([(int(load), attempt, time.time_ns())], COMMITS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(commits_path)


def committed(spark: SparkSession, commits_path: str) -> DataFrame:
    """(load, attempt): of each load the attempt committed last."""
    try:
        rows = spark.read.schema(COMMITS_SCHEMA).parquet(commits_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], COMMITS_SCHEMA)  # nothing was committed yet
    return rows.groupBy("load").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))


def create_table(spark: SparkSession, path: str, schema: StructType, commits_path: str | None = None) -> None:
    """An empty keyed table where none is (A13); an existing one stays as it is."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(_load_path(path, 0, "a-empty") + "/shard=0")
    commits = commits_path or _commits_path(path)
    if committed(spark, commits).where("load = 0").isEmpty():
        commit_load(spark, commits, 0, "a-empty")


def write_load(rows: DataFrame, path: str, load: int, key: str = "_id", num_shards: int = 1, attempt: str | None = None) -> str:
    """Write one load of a keyed table, ``num_shards`` folders by key hash.

    Rows gather by shard, and adaptive execution splits a shard that is too
    large for one task. Without ``attempt`` the load is committed at once;
    with it that is left to the caller (``commit_load``).
    """
    name = attempt or new_attempt()
    shards = rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(num_shards)).cast("int"))
    (shards.hint("rebalance", F.col("shard"))
           .write.mode("overwrite").partitionBy("shard").parquet(_load_path(path, load, name)))
    if attempt is None:
        commit_load(rows.sparkSession, _commits_path(path), load, name)
    return name


def _committed_rows(spark: SparkSession, path: str, commits_path: str | None) -> DataFrame:
    """Rows of the committed attempts, with ``load`` and each row's place in the files."""
    rows = spark.read.parquet(path).drop("shard").withColumn("load", F.col("load").cast("long"))
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    seen = committed(spark, commits_path or _commits_path(path))
    return rows.join(seen, ["load", "attempt"], "left_semi").drop("attempt")


def read_loads(spark: SparkSession, path: str, commits_path: str | None = None) -> DataFrame:
    """All rows of the committed loads, as they were written, with ``load`` (for tables whose keys repeat)."""
    return _committed_rows(spark, path, commits_path).drop("__file", "__at")


def read_table(spark: SparkSession, path: str, key: str = "_id", order: tuple[str, ...] = (),
               first: bool = False, commits_path: str | None = None) -> DataFrame:
    """The rows of a keyed table, one per key: the last load's, or with ``first`` the first load's.

    Within a load the last (first) in ``order`` counts, then the place in the files, so repeated reads agree.
    """
    rows = _committed_rows(spark, path, commits_path)
    narrow = rows.select(F.col(key).alias("__k"), F.struct("load", *order, "__file", "__at").alias("__rank"))
    best = narrow.groupBy("__k").agg((F.min if first else F.max)("__rank").alias("__best")).withColumnRenamed("__k", "__key")
    losers = narrow.join(best, F.col("__k").eqNullSafe(F.col("__key"))).where(F.col("__rank") != F.col("__best"))
    losers = losers.select(F.col("__rank.__file").alias("__f"), F.col("__rank.__at").alias("__a"))
    kept = rows.join(losers, (F.col("__file") == F.col("__f")) & (F.col("__at") == F.col("__a")), "left_anti")
    return kept.drop("load", "__file", "__at")


def read_index(spark: SparkSession, meta_path: str, data_path: str, first: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both tables of an index, as of the loads committed for both."""
    commits = _commits_path(data_path)
    return tuple(read_table(spark, p, first=first, commits_path=commits) for p in (meta_path, data_path))


def stored_collisions(spark: SparkSession, meta_path: str, data_path: str) -> DataFrame:
    """Keys under which committed loads hold different documents (two writers at a time can do that): _id, n_docs."""
    rows = _committed_rows(spark, meta_path, _commits_path(data_path))
    return rows.groupBy("_id").agg(F.count_distinct("uuid").alias("n_docs")).where("n_docs > 1")


def compact(spark: SparkSession, path: str, new_path: str, key: str = "_id", order: tuple[str, ...] = (),
            num_shards: int = 1, first: bool = False, commits_path: str | None = None) -> None:
    """The table's rows written as the first load of a new table."""
    write_load(read_table(spark, path, key, order, first, commits_path), new_path, 1, key, num_shards)


def write_typed(raw: DataFrame, path: str, quarantine_path: str, table: str = "data") -> dict:
    """Rows with all fields of their types to ``path``, the others as they came, with ``bad_fields``, to ``quarantine_path`` (K1)."""
    typed = cut(typed_fields(raw.withColumn("__raw", F.to_json(F.struct(*raw.columns))), table))
    good, bad = Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    fine = typed.where(F.size("bad_fields") == 0).drop("__raw", "bad_fields")
    aside = typed.where(F.size("bad_fields") > 0).select("bad_fields", F.col("__raw").alias("raw"))
    fine.observe(good, count).write.mode("overwrite").parquet(path)
    aside.observe(bad, count).write.mode("overwrite").parquet(quarantine_path)
    return {"written": good.get["n"], "set_aside": bad.get["n"]}


def write_clustered(rows: DataFrame, path: str, by: tuple[str, ...], num_files: int | None = None) -> None:
    """A copy of a table in ranges of ``by`` (filter fields, the most selective first), each sorted.

    Parquet's statistics then leave out the row groups that a filter on these
    fields cannot match, and whole files for the first one.
    """
    dealt = rows.repartitionByRange(num_files, *by) if num_files else rows.repartitionByRange(*by)
    conf, key = rows.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(key)
    conf.set(key, "TIMESTAMP_MICROS")  # the default form of time stamps has no statistics
    try:
        dealt.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    finally:
        conf.set(key, before)


def collision_losers(rows: DataFrame, key: str, order: tuple[str, ...], first: bool = False) -> DataFrame:
    """The rows that do not stand for their key (G4); ``order`` must tell all rows of a key apart.

    Works on the narrow columns it is given: bodies do not travel.
    """
    pick = F.min if first else F.max
    best = rows.groupBy(F.col(key).alias("__key")).agg(pick(F.struct(*order)).alias("__best"))
    joined = rows.join(best, rows[key] == F.col("__key"))
    return joined.where(F.struct(*order) != F.col("__best")).drop("__key", "__best")


def foreign_rows(rows: DataFrame, stored: DataFrame, key: str = "_id", document: str = "uuid") -> DataFrame:
    """Rows whose key is stored for another document (G4 between loads); ``stored`` has ``key`` and ``document``."""
    by_key = stored.groupBy(F.col(key).alias("__stored")).agg(
        F.min(document).alias("__least"), F.max(document).alias("__most"))  # equal, unless two writers collided before
    other = ~F.col("__least").eqNullSafe(F.col(document)) | ~F.col("__most").eqNullSafe(F.col(document))
    return rows.join(by_key, F.col(key) == F.col("__stored")).where(other).drop("__stored", "__least", "__most")


def _taken(spark: SparkSession, winners: DataFrame, meta_path: str, commits_path: str, load: int) -> DataFrame:
    """(_id, __row) of winners whose key another load has given to another document; narrow columns only."""
    if committed(spark, commits_path).where(F.col("load") != load).isEmpty():
        return winners.select("_id", "__row").limit(0)
    stored = _committed_rows(spark, meta_path, commits_path).where(F.col("load") != load).select("_id", F.col("uuid").alias("__uuid"))
    return foreign_rows(winners, stored, "_id", "__uuid").select("_id", "__row")


def write_index(records: DataFrame, meta_path: str, data_path: str, num_meta_shards: int,
                num_data_shards: int, load: int = 1, order: tuple[str, ...] = (), first: bool = False,
                collisions_path: str | None = None) -> dict:
    """Write one load of both tables from a record frame (A10, A14); returns counts.

    The record frame is checkpointed once in the shared folder, so the HTML
    and id work runs once and a lost executor does not repeat it. Each key
    gets one winner, by ``order``, offset, document and row number, and both
    tables take that row. Different documents under one key (it keeps 24 bits
    of the document's hash) fail the job, or go to ``collisions_path``: of one
    load the rows that lose, and rows whose key belongs to a document of
    another load. Both tables become visible by one commit. Rows are counted
    while they are written.
    """
    spark = records.sparkSession
    commits, attempt = _commits_path(data_path), new_attempt()
    seen, meta_rows, data_rows = (Observation() for _ in range(3))
    count = F.count(F.lit(1)).alias("n")
    rows = cut(records.withColumn("__row", F.monotonically_increasing_id()).observe(seen, count))
    narrow = rows.select("_id", "d_uuid", "m_source_offset", "__row", *order)
    ranks = tuple(dict.fromkeys([*order, "m_source_offset", "d_uuid", "__row"]))
    losers = cut(collision_losers(narrow, "_id", ranks, first))
    winners = narrow.join(losers.select("__row"), "__row", "left_anti").select("_id", F.col("d_uuid").alias("__uuid"), "__row")
    inside = losers.join(winners.select(F.col("_id").alias("__id"), "__uuid"), F.col("_id") == F.col("__id")).where(~F.col("d_uuid").eqNullSafe(F.col("__uuid")))
    taken = _taken(spark, winners, meta_path, commits, load)
    clash = cut(inside.select("_id").unionByName(taken.select("_id")).distinct())
    if collisions_path is None:
        if shown := [r["_id"] for r in clash.limit(6).collect()]:
            raise ValueError(f"Index keys are shared by different documents, such as {shown[:5]}; "
                             "give collisions_path to write the rows that lose elsewhere")
    out = cut(losers.select("__row").unionByName(taken.select("__row")))
    kept = rows.join(out, "__row", "left_anti").drop("__row")
    collisions = 0
    if collisions_path is not None:
        lost = rows.join(out, "__row", "left_semi").drop("__row")
        marked = lost.join(clash.withColumn("shared_key", F.lit(True)), "_id", "left").withColumn("shared_key", F.coalesce("shared_key", F.lit(False)))
        write_load(marked, collisions_path, load, attempt=attempt)
        collisions = clash.count()  # narrow, written already, and hardly ever more than a few
    write_load(meta_table(kept).observe(meta_rows, count), meta_path, load, "_id", num_meta_shards, attempt)
    write_load(data_table(kept).observe(data_rows, count), data_path, load, "_id", num_data_shards, attempt)
    if collisions_path is not None:
        commit_load(spark, _commits_path(collisions_path), load, attempt)
    commit_load(spark, commits, load, attempt)
    n_docs = seen.get["n"]
    return {"documents": n_docs, "actions": 2 * n_docs, "written_meta": meta_rows.get["n"], "written_data": data_rows.get["n"],
            "key_collisions": collisions}
