"""Stock as a base and the changes since.

The base has the balance of every warehouse and material, of either sign; each micro-batch adds a small folder of
what it changes. Readers sum both. When the changes have grown to a share of the base they are merged into
a new one. A base says up to which batch of each run it goes, so a batch that is replayed after that
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.model import INVENTORY, INVENTORY_TRANSACTIONS
from millrace.operators.upsert import with_audit
from millrace.plans.inventory import balances
from millrace.session import discard
from millrace.sources.sinks import replace_table
from millrace.streaming.references import BATCH, RUN, Folder, folder, folders, of_folders

#: Changes are merged when they have more rows than this share of the base.
SHARE = 0.25
FIELDS = f"warehouse_id string, material_id string, quantity bigint, {RUN} string, {BATCH} bigint"
UPTO = f"{RUN} string, upto bigint"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete bases, oldest first; what a base goes up to is written last."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/upto/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(str(s.getPath().getParent()).rpartition("=")[2]) for s in found or [])


def _changes(path: str) -> str:
    return f"{path}/changes"


def _upto(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    rows = spark.read.schema(UPTO).parquet(f"{path}/upto/version={version}").collect()  # one row for each run
    return {r[RUN]: r["upto"] for r in rows}


def _since(spark: SparkSession, path: str, version: int) -> set[Folder]:
    """Folders of changes that the base doesn't have."""
    upto = _upto(spark, path, version)
    return {(run, batch) for run, batch in folders(spark, _changes(path)) if batch > upto.get(run, -1)}


def _write_base(spark: SparkSession, rows: DataFrame, path: str, version: int, upto: dict[str, int]) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/base/version={version}")
    spark.createDataFrame(list(upto.items()), UPTO).coalesce(1).write.mode("overwrite").parquet(f"{path}/upto/version={version}")


def seed_stock(ledger: DataFrame, path: str, run: str, batch_id: int) -> None:
    """The balances of a ledger as the first base."""
    _write_base(ledger.sparkSession, balances(ledger), path, 0, {run: batch_id})


def _base(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(INVENTORY).parquet(f"{path}/base/version={version}")


def read_balances(spark: SparkSession, path: str) -> DataFrame:
    """Balances of either sign: the latest base and all changes since."""
    version = _versions(spark, path)[-1]
    since = _since(spark, path, version)
    rows = _base(spark, path, version)
    if since:
        changes = spark.read.schema(FIELDS).parquet(_changes(path)).where(of_folders(since))
        rows = rows.unionByName(changes.select(*rows.columns))
    return rows.groupBy("warehouse_id", "material_id").agg(F.sum("quantity").alias("quantity"))


def read_stock(spark: SparkSession, path: str) -> DataFrame:
    """Positive balances."""
    return read_balances(spark, path).where("quantity > 0")


def publish_stock(spark: SparkSession, path: str, snapshot: str) -> int:
    """The stock as a table of its own, in place of the one before."""
    return replace_table(with_audit(read_stock(spark, path)), snapshot)


def add_changes(spark: SparkSession, booked: DataFrame, path: str, run: str, batch_id: int) -> None:
    """What one batch changes, in its own folder; a replay writes the same again."""
    balances(booked).write.mode("overwrite").parquet(folder(_changes(path), run, batch_id))


def add_missing(spark: SparkSession, ledger_path: str, path: str) -> None:
    """Changes of ledger folders whose writer was ended before it had added them."""
    upto = _upto(spark, path, _versions(spark, path)[-1])
    known = folders(spark, _changes(path))
    for run, batch in folders(spark, ledger_path):
        if batch > upto.get(run, -1) and (run, batch) not in known:
            add_changes(spark, spark.read.schema(INVENTORY_TRANSACTIONS).parquet(folder(ledger_path, run, batch)), path, run, batch)


def compact(spark: SparkSession, path: str, share: float = SHARE) -> bool:
    """Merges the changes into a new base if they have grown beyond a share of it. The base before stays for its readers."""
    version = _versions(spark, path)[-1]
    since = _since(spark, path, version)
    if not since:
        return False
    changed = spark.read.schema(FIELDS).parquet(_changes(path)).where(of_folders(since)).count()
    if changed <= share * _base(spark, path, version).count():
        return False
    before = _upto(spark, path, version)
    upto = dict(before)
    for run, batch in since:
        upto[run] = max(batch, upto.get(run, -1))
    _write_base(spark, read_balances(spark, path), path, version + 1, upto)
    for old in (v for v in _versions(spark, path) if v < version):
        discard(spark, f"{path}/upto/version={old}")
        discard(spark, f"{path}/base/version={old}")
    for run, batch in folders(spark, _changes(path)):
        if batch <= before.get(run, -1):  # in the base that is kept, too
            discard(spark, folder(_changes(path), run, batch))
    return True
