"""The tables of one book, as Parquet folders below a root all executors share.

ledger/run_id=R/batch_id=B      postings, append-only, one folder per committed micro-batch
commits/run_id=R/batch_id=B     last offset and rows per log partition; written last, so a
                                batch counts only when its folder is here
quarantine/run_id=R/batch_id=B  log records that are not postings
accounts/version=V/bucket=K     balances; a version holds only the buckets that were rewritten
changes/version=V               net changes of the fold that made version V; balances are
                                buckets plus the changes after their base
marks/version=V                 which folder holds each bucket of version V, and the last
                                batch folded into it; written last, which publishes V
runs/                           run_id of each checkpoint folder; a new checkpoint restarts
                                batch_id at 0, the pair (run_id, batch_id) stays ordered

Each table has one writer: one ingest query and one fold query per book. Accounts are opened
by the fold's writer, between folds. Of the versions only the last KEEP stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas
from tallybook.functions.numbers import exact_sum
from tallybook.operators.balances import apply_changes

Batch = tuple[int, int]


@dataclass(frozen=True)
class Book:
    """Where the tables are and how accounts are spread; buckets must stay the same for a book.

    The changes of so many folds as apply_every are kept apart before buckets are rewritten.
    """

    root: str
    key: str = "string"
    buckets: int = 64
    apply_every: int = 30

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def schema(self, table: str) -> T.StructType:
        return {
            "ledger": schemas.ledger_schema(self.key),
            "history": schemas.ledger_schema(self.key),
            "commits": schemas.COMMITS,
            "quarantine": schemas.QUARANTINE,
            "changes": schemas.changes_schema(self.key),
            "marks": schemas.MARKS,
            "runs": schemas.RUNS,
        }[table]


TABLES = ("ledger", "history", "commits", "quarantine", "changes", "marks", "runs")
#: Published versions that readers may still hold; older ones are removed.
KEEP = 3


def truncate_table(spark: SparkSession, book: Book, table: str) -> None:
    """Empty one table by overwriting it with no rows.

    A fold does not need this: it moves its mark past the batches it has applied.
    """
    fields = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in book.schema(table))
    nothing = spark.sql(f"SELECT {fields} WHERE false")
    nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(book.path(table))


def init_tables(spark: SparkSession, book: Book) -> None:
    """Create the tables, empty. On a book that exists this is the full reset."""
    for table in TABLES:
        truncate_table(spark, book, table)


def read_table(spark: SparkSession, book: Book, table: str) -> DataFrame:
    return spark.read.schema(book.schema(table)).parquet(book.path(table))


def after(batch: Batch) -> Column:
    """Rows of later batches; a condition on folder names, so it prunes folders."""
    run, number = batch
    return (F.col("run_id") > run) | ((F.col("run_id") == run) & (F.col("batch_id") > number))


def before(batch: Batch) -> Column:
    run, number = batch
    return (F.col("run_id") < run) | ((F.col("run_id") == run) & (F.col("batch_id") < number))


def read_ledger(spark: SparkSession, book: Book) -> DataFrame:
    """The postings of committed batches.

    What a batch that has not committed yet may have written is nowhere seen, by the merge
    neither: should another run take over, it gets these postings again. Batches are folders, and
    so are commits: which batches count follows from names alone, no commit is read.
    """
    return read_table(spark, book, "ledger").filter(_counted(spark, book))


def _counted(spark: SparkSession, book: Book) -> Column:
    """Rows of batches that are committed now: per run those up to its last commit, but for folders without one.

    Batches run one after another, so at most the last one that a run began has no commit.
    """
    counted = F.lit(False)
    for run in _numbers(spark, book.path("ledger"), "run_id"):
        done = set(_numbers(spark, f"{book.path('commits')}/run_id={run}", "batch_id"))
        begun = _numbers(spark, f"{book.path('ledger')}/run_id={run}", "batch_id")
        last = max(done, default=-1)
        of_run = (F.col("run_id") == run) & (F.col("batch_id") <= last)
        broken = [n for n in begun if n < last and n not in done]
        counted |= of_run & ~F.col("batch_id").isin(broken) if broken else of_run
    return counted


def read_commits(spark: SparkSession, book: Book) -> DataFrame:
    return read_table(spark, book, "commits")


BLOOM = {"parquet.bloom.filter.enabled#id": "true"}


def write_batch(rows: DataFrame, book: Book, table: str, batch: Batch) -> None:
    """Replace one batch folder of a table; repeating the write changes nothing."""
    run, number = batch
    tagged = rows.withColumns({"run_id": F.lit(run).cast("bigint"), "batch_id": F.lit(number).cast("bigint")})
    tagged = tagged.select(*book.schema(table).fieldNames())
    if "id" in tagged.columns:
        # A lookup of one id reads the row groups whose range and Bloom filter may have it.
        tagged = tagged.sortWithinPartitions("id")
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**BLOOM).partitionBy("run_id", "batch_id").parquet(book.path(table))


def is_committed(spark: SparkSession, book: Book, batch: Batch) -> bool:
    """Looks at the batch's own folder only, however many batches there are."""
    run, number = batch
    folder = f"{book.path('commits')}/run_id={run}/batch_id={number}"
    try:
        return not spark.read.schema(schemas.COMMITS).parquet(folder).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _folder(spark: SparkSession, path: str):
    """The folder and its file system, for listing names and removing versions."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """The numbers N of the column=N folders in path, in order: one listing of names, no file is opened."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{column}="))


def batches_after(spark: SparkSession, book: Book, since: Batch) -> list[Batch]:
    """Committed batches after `since`, in order; batches run one after another."""
    root = book.path("commits")
    runs = [run for run in _numbers(spark, root, "run_id") if run >= since[0]]
    found = ((run, n) for run in runs for n in _numbers(spark, f"{root}/run_id={run}", "batch_id"))
    return [batch for batch in found if batch > since]


def read_batches(spark: SparkSession, book: Book, table: str, batches: list[Batch]) -> DataFrame:
    """The rows of the given batches: exactly their folders are listed. A batch without rows has none."""
    root = book.path(table)
    paths = [f"{root}/run_id={run}/batch_id={number}" for run, number in batches]
    paths = [p for p in paths if _exists(spark, p)]
    schema = book.schema(table)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def run_of(spark: SparkSession, book: Book, checkpoint: str) -> int:
    """The run_id of a checkpoint folder, minted at first use."""
    runs = read_table(spark, book, "runs")
    known = runs.filter(F.col("checkpoint") == checkpoint).agg(F.max("run_id")).first()[0]
    if known is not None:
        return known
    newest = runs.agg(F.max("run_id")).first()[0]
    run = 0 if newest is None else newest + 1
    row = spark.createDataFrame([(checkpoint, run)], schemas.RUNS)
    row.write.mode("append").parquet(book.path("runs"))
    return run


# ---- account snapshots ----


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Place:
    """Which version's folder holds a bucket, and the least and greatest balance in it."""

    version: int
    low: int
    high: int


@dataclass(frozen=True)
class Published:
    """The newest published version: where its buckets are, and what is folded into it."""

    version: int
    base: int
    applied: Batch
    places: dict[int, Place]


def current_marks(spark: SparkSession, book: Book) -> DataFrame | None:
    """The rows of the newest published version, one per bucket. Older marks are not read."""
    versions = _numbers(spark, book.path("marks"), "version")
    if not versions:
        return None
    path = f"{book.path('marks')}/version={versions[-1]}"
    return spark.read.schema(schemas.MARKS).option("basePath", book.path("marks")).parquet(path)


def published(spark: SparkSession, book: Book) -> Published | None:
    marks = current_marks(spark, book)
    rows = [] if marks is None else marks.collect()  # one row per bucket
    if not rows:
        return None
    first = rows[0]
    places = {r["bucket"]: Place(r["data_version"], r["low"], r["high"]) for r in rows if r["bucket"] >= 0}
    return Published(first["version"], first["base"], (first["run_id"], first["batch_id"]), places)


def _bucket_schema(book: Book) -> T.StructType:
    extra = [T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return T.StructType(schemas.account_schema(book.key).fields + extra)


def read_buckets(spark: SparkSession, book: Book, places: dict[int, Place]) -> DataFrame:
    """Accounts of the given buckets: exactly their folders are listed."""
    if not places:
        return spark.createDataFrame([], _bucket_schema(book))
    root = book.path("accounts")
    paths = [f"{root}/version={place.version}/bucket={bucket}" for bucket, place in sorted(places.items())]
    return spark.read.schema(_bucket_schema(book)).option("basePath", root).parquet(*paths)


def pending_changes(spark: SparkSession, book: Book, now: Published) -> DataFrame:
    """Net change per account (id) of the folds that are not in the buckets: at most apply_every small folders."""
    root = book.path("changes")
    paths = [f"{root}/version={v}" for v in range(now.base + 1, now.version + 1)]
    paths = [p for p in paths if _exists(spark, p)]
    schema = book.schema("changes")
    rows = spark.read.schema(schema).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.groupBy("account_id").agg(exact_sum(F.col("net_change")).alias("net_change"))


def read_accounts(spark: SparkSession, book: Book) -> DataFrame:
    """All accounts at the newest published version."""
    now = published(spark, book)
    fields = schemas.account_schema(book.key).fieldNames()
    if now is None:
        return read_buckets(spark, book, {}).select(*fields)
    return apply_changes(read_buckets(spark, book, now.places), pending_changes(spark, book, now)).select(*fields)


def read_account(spark: SparkSession, book: Book, account_id) -> DataFrame:
    """One account, read from its bucket and the pending changes only."""
    now = published(spark, book)
    fields = schemas.account_schema(book.key).fieldNames()
    if now is None:
        return read_buckets(spark, book, {}).select(*fields)
    kind = schemas.account_schema(book.key)["id"].dataType
    wanted = spark.range(1).select(bucket_of(F.lit(account_id).cast(kind), book.buckets)).first()[0]
    places = {k: p for k, p in now.places.items() if k == wanted}
    accounts = read_buckets(spark, book, places).filter(F.col("id") == F.lit(account_id))
    changes = pending_changes(spark, book, now).filter(F.col("account_id") == F.lit(account_id))
    return apply_changes(accounts, changes).select(*fields)


def write_accounts(book: Book, accounts: DataFrame, version: int) -> dict[int, Place]:
    """Write account rows (with bucket) as a version; without marks it is invisible."""
    path = f"{book.path('accounts')}/version={version}"
    rows = accounts.select(*schemas.account_schema(book.key).fieldNames(), "bucket")
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    written = accounts.sparkSession.read.schema("balance BIGINT, bucket INT").parquet(path).groupBy("bucket")
    ranges = written.agg(F.min("balance").alias("low"), F.max("balance").alias("high")).collect()  # one per bucket
    return {r["bucket"]: Place(version, r["low"], r["high"]) for r in ranges}


def write_changes(book: Book, net: DataFrame, version: int) -> None:
    """The net changes (account_id, net_change) of one fold; without marks they are invisible."""
    path = f"{book.path('changes')}/version={version}"
    net.select("account_id", "net_change").hint("rebalance").write.mode("overwrite").parquet(path)


def publish_version(
    spark: SparkSession, book: Book, version: int, base: int, places: dict[int, Place], applied: Batch
) -> None:
    """Publish a version: where each of its buckets is, and the last batch folded into it."""
    run, number = applied
    # A book without accounts is published too, by a bucket that no account has.
    rows = places or {-1: Place(-1, 0, 0)}
    marks = [(bucket, p.version, p.low, p.high, base, run, number, version) for bucket, p in sorted(rows.items())]
    frame = spark.createDataFrame(marks, schemas.MARKS).coalesce(1)
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(
        book.path("marks")
    )


def remove_old(spark: SparkSession, book: Book) -> None:
    """Remove marks beyond the last KEEP, and the changes and buckets that none of those kept needs.

    Marks go first: what they name is then out of every reader's sight.
    """
    versions = _numbers(spark, book.path("marks"), "version")
    kept, old = versions[-KEEP:], versions[:-KEEP]
    if not old:
        return
    rows = spark.read.schema(schemas.MARKS).option("basePath", book.path("marks")).parquet(
        *[f"{book.path('marks')}/version={v}" for v in kept]
    )
    held = rows.select("bucket", "data_version", "base").distinct().collect()  # KEEP rows per bucket at most
    base = min(r["base"] for r in held)
    used = {(r["data_version"], r["bucket"]) for r in held}
    gone = [f"{book.path('marks')}/version={v}" for v in old]
    gone += [f"{book.path('changes')}/version={v}" for v in _numbers(spark, book.path("changes"), "version") if v <= base]
    for version in _numbers(spark, book.path("accounts"), "version"):
        folder = f"{book.path('accounts')}/version={version}"
        buckets = _numbers(spark, folder, "bucket") if version <= kept[-1] else []
        unused = [b for b in buckets if (version, b) not in used]
        if version <= kept[-1] and len(unused) == len(buckets):
            gone.append(folder)
        else:
            gone += [f"{folder}/bucket={b}" for b in unused]
    for path in gone:
        folder, files = _folder(spark, path)
        files.delete(folder, True)


def register_views(spark: SparkSession, book: Book) -> None:
    """Temporary views ledger, accounts and offsets for SQL users."""
    from tallybook.operators.offsets import committed_offsets

    read_ledger(spark, book).createOrReplaceTempView("ledger")
    read_accounts(spark, book).createOrReplaceTempView("accounts")
    committed_offsets(read_commits(spark, book)).createOrReplaceTempView("offsets")


def create_external_tables(spark: SparkSession, book: Book, database: str) -> None:
    """Catalog entries over the folders, for sites with a shared metastore.

    Batches written later appear after ALTER TABLE ... RECOVER PARTITIONS.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in ("ledger", "history", "commits", "quarantine"):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in book.schema(table).fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet "
            f"PARTITIONED BY (run_id, batch_id) LOCATION '{book.path(table)}'"
        )
        spark.sql(f"ALTER TABLE {database}.{table} RECOVER PARTITIONS")


def drop_external_tables(spark: SparkSession, database: str) -> None:
    """Drop the catalog entries; the folders stay."""
    for table in ("ledger", "history", "commits", "quarantine"):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
