"""Tables kept as bucketed slots, of which a day rewrites only those that it touches.

A table is divided by a hash of its key into a fixed number of slots: partitions with one Spark bucket each, so a table read
back is already dealt out by its key and is joined or grouped without being shuffled. A write makes a new piece,
``<root>/<table>/data/in_piece=<piece>/in_slot=<slot>``; no file is ever changed. ``<root>/<table>/log`` says which pieces
make up which version: a piece replaces its slots or adds rows to them. A version is listed only after it has been written
and its key checked, so a reader sees the old table or the new one. One writer per table at a time.

The number of slots is fixed by a table's first version: ``slots``, or else the session's number of shuffle partitions.
Tables are read through Spark's session catalog, which alone knows of buckets, as external tables named
``pursefold_<table>_<digest>``; ``close`` drops those of a store. Dropping them removes no data.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pursefold.operators.audit import refuse_faults, slot_faults
from pursefold.schemas import Target
from pursefold.sources.paths import delete, exists, names_in

SLOT, PIECE = "in_slot", "in_piece"
LOG_COLUMNS = (
    "version bigint, store_date date, n_rows bigint, slots int, oldest bigint, "
    f"{PIECE} string, {SLOT} int, whole boolean, piece_rows bigint"
)


@dataclass
class Head:
    """What a version of a table is made of."""

    version: int = 0
    n_rows: int = 0
    slots: int = 0
    oldest: int = 1
    #: (slot, piece, rows)
    pieces: list[tuple[int, str, int]] = field(default_factory=list)


def slot_of(keys: Sequence[str], slots: int) -> Column:
    """The slot of a key: the number of the bucket that Spark puts it into."""
    return F.pmod(F.hash(*keys), F.lit(slots))


class StateStore:
    def __init__(self, spark: SparkSession, root: str, slots: int | None = None):
        self.spark = spark
        self.root = root
        self.slots = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: set[str] = set()

    def _log_path(self, target: Target) -> str:
        return f"{self.root}/{target.name}/log"

    def _data_path(self, target: Target) -> str:
        return f"{self.root}/{target.name}/data"

    def _log(self, target: Target) -> DataFrame:
        path = self._log_path(target)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], LOG_COLUMNS)
        return self.spark.read.schema(LOG_COLUMNS).parquet(path)

    def versions(self, target: Target) -> DataFrame:
        """(version, store_date, n_rows) of every readable version."""
        log = self._log(target)
        oldest = log.agg(F.max("oldest")).first()[0] or 1
        rows = log.filter((F.col("version") >= oldest) & F.col("whole").isNotNull())
        return rows.select("version", "store_date", "n_rows").distinct()

    def has_day(self, target: Target, store_date: str) -> bool:
        """Whether a version, readable or removed, was made from that day."""
        return not self._log(target).filter(F.col("store_date") == F.lit(store_date).cast("date")).isEmpty()

    def _head(self, target: Target, version: int | None = None) -> Head:
        log = self._log(target)
        oldest = F.max("oldest").alias("oldest")
        if version is not None:
            log = log.filter(F.col("version") <= version)
        piece = F.struct("version", PIECE, "piece_rows")
        slots = log.groupBy(SLOT).agg(
            oldest,
            F.max(F.when(F.col("whole").isNotNull(), F.struct("version", "n_rows", "slots"))).alias("head"),
            F.max(F.when(F.col("whole"), F.col("version"))).alias("base"),
            F.collect_list(F.when(F.col(PIECE).isNotNull(), piece)).alias("pieces"),
        )
        since = F.coalesce("base", F.lit(0))
        slots = slots.withColumn("pieces", F.filter("pieces", lambda p: p["version"] >= since))
        found = slots.select(SLOT, "oldest", "head", "pieces").collect()
        heads = [r.head for r in found if r.head]
        if not heads:
            return Head(slots=self.slots)
        last = max(heads)
        return Head(
            last.version, last.n_rows, last.slots, max(r.oldest for r in found),
            [(r[SLOT], p[PIECE], p.piece_rows) for r in found for p in r.pieces],
        )

    def current_version(self, target: Target) -> int:
        """Number of the newest version; 0 when the table was never written."""
        return self._head(target).version

    def read(self, target: Target, version: int | None = None) -> DataFrame:
        head = self._head(target, version)
        if version is not None and 0 < version < head.oldest:
            raise ValueError(f"{target.name}: version {version} has been removed")
        return self._read(target, head)

    def _read(self, target: Target, head: Head, only: list[int] | None = None) -> DataFrame:
        if not head.pieces:
            return self.spark.createDataFrame([], target.ddl)
        digest = hashlib.md5(repr((self.root, sorted(head.pieces))).encode()).hexdigest()
        name = f"pursefold_{target.name}_{digest}"
        if name not in self._tables:
            keys = ", ".join(target.key)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({target.ddl}, {PIECE} string, {SLOT} int) USING parquet "
                f"PARTITIONED BY ({PIECE}, {SLOT}) CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {head.slots} BUCKETS LOCATION '{self._data_path(target)}'"
            )
            parts = " ".join(f"PARTITION ({PIECE}='{p}', {SLOT}={s})" for s, p, _ in head.pieces)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            self._tables.add(name)
        table = self.spark.table(name)
        if only is not None and len(only) < head.slots:
            table = table.filter(F.col(SLOT).isin(only))
        return table.select(*target.names)

    def close(self) -> None:
        """Forget the catalog's tables; frames read from this store can no longer be run."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")

    def _write(self, table: DataFrame, target: Target, slots: int) -> tuple[str, dict[int, int]]:
        """A new piece and its rows by slot; raises if its key is broken.

        A key stands in one slot, and its slot in one bucket, so the check groups the piece without a shuffle.
        """
        piece = uuid.uuid4().hex
        name = f"pursefold_{target.name}_{piece}"
        columns = [F.col(c).cast(kind).alias(c) for c, kind in target.columns.items()]
        rows = table.select(*columns).withColumn(SLOT, slot_of(target.key, slots))
        writer = rows.write.format("parquet").partitionBy(SLOT)
        writer = writer.bucketBy(slots, *target.key).sortBy(*target.key)
        writer.option("path", f"{self._data_path(target)}/{PIECE}={piece}").saveAsTable(name)
        try:
            faults = slot_faults(self.spark.table(name), target.key, SLOT).collect()
        finally:
            self.spark.sql(f"DROP TABLE {name}")
        refuse_faults(faults, target.key, target.name)
        return piece, {r[SLOT]: r.n_rows for r in faults}

    def _enter(
        self, target: Target, head: Head, store_date: str | None, n_rows: int,
        piece: str | None = None, slots: dict[int, int | None] | None = None, whole: bool = True,
    ) -> int:
        """Make the next version current. Returns its row count."""
        entries = [
            (head.version + 1, n_rows, head.slots, head.oldest, piece if n is not None else None, s, whole, n)
            for s, n in (slots or {None: None}).items()
        ]
        kinds = f"version bigint, n_rows bigint, slots int, oldest bigint, {PIECE} string, {SLOT} int, whole boolean, piece_rows bigint"
        log = self.spark.createDataFrame(entries, kinds).withColumn("store_date", F.lit(store_date).cast("date"))
        log.coalesce(1).write.mode("append").parquet(self._log_path(target))
        return n_rows

    def publish(
        self,
        table: DataFrame,
        target: Target,
        store_date: str | None = None,
        after: Head | None = None,
    ) -> int:
        """Write ``table`` as a whole new version, check its key, then make it current. Returns its row count."""
        head = after or self._head(target)
        piece, rows = self._write(table.repartition(head.slots, *target.key), target, head.slots)
        # Slots that the new table leaves empty are replaced by nothing.
        slots = dict.fromkeys((s for s, _, _ in head.pieces), None) | rows
        return self._enter(target, head, store_date, sum(rows.values()), piece, slots)

    def update(
        self,
        target: Target,
        merge: Callable[[DataFrame], DataFrame],
        store_date: str | None = None,
        batch: DataFrame | None = None,
    ) -> int:
        """Publish ``merge`` of the current table. Returns the new row count.

        With ``batch``, a frame that has the keys (others too) of all rows that the merge changes
        or inserts, only the slots of those keys are read and written; ``merge`` must keep all
        other rows of a slot, and no row's key.
        """
        head = self._head(target)
        if batch is None or not head.pieces:
            return self.publish(merge(self._read(target, head)), target, store_date, head)
        touched = self._touched(target, head, batch)
        if not touched:
            return self._enter(target, head, store_date, head.n_rows)
        merged = merge(self._read(target, head, touched))
        piece, rows = self._write(merged, target, head.slots)
        replaced = sum(n for s, _, n in head.pieces if s in set(touched))
        n_rows = head.n_rows - replaced + sum(rows.values())
        return self._enter(target, head, store_date, n_rows, piece, dict.fromkeys(touched, None) | rows)

    def append(
        self,
        target: Target,
        new_rows: Callable[[DataFrame], DataFrame],
        store_date: str | None = None,
        batch: DataFrame | None = None,
    ) -> int:
        """Add rows whose keys the table has not got: ``new_rows`` of the current table (of the
        slots of ``batch``). What is stored is only read, and nothing is written if there are none.
        """
        head = self._head(target)
        if not head.pieces:
            return self.publish(new_rows(self._read(target, head)), target, store_date, head)
        touched = self._touched(target, head, batch) if batch is not None else None
        if touched == []:
            return self._enter(target, head, store_date, head.n_rows)
        piece, rows = self._write(new_rows(self._read(target, head, touched)), target, head.slots)
        return self._enter(target, head, store_date, head.n_rows + sum(rows.values()), piece, rows, whole=False)

    def _touched(self, target: Target, head: Head, batch: DataFrame) -> list[int]:
        keys = [F.col(k).cast(target.columns[k]).alias(k) for k in target.key]
        slots = batch.select(*keys).select(slot_of(target.key, head.slots).alias(SLOT)).distinct()
        return sorted(r[SLOT] for r in slots.collect())

    def compact(self, target: Target) -> int:
        """Make one piece of all, as a new version; for tables that many days have added to."""
        head = self._head(target)
        return self.publish(self._read(target, head), target, after=head) if head.pieces else 0

    def remove_before(self, target: Target, version: int) -> list[str]:
        """Remove the data that only versions before this one need, and what unlisted writes have
        left. Those versions can no longer be read. Returns the folders removed. No writer may be at work.
        """
        head = self._head(target)
        version = min(version, head.version)
        if not version:
            return []
        needed = {(s, p) for s, p, _ in self._head(target, version).pieces}
        listed = self._log(target).filter(F.col(PIECE).isNotNull()).select("version", SLOT, PIECE).collect()
        needed |= {(r[SLOT], r[PIECE]) for r in listed if r.version > version}
        # Under no version's number, so that readers of any see it.
        mark = self.spark.createDataFrame([(0, version)], "version bigint, oldest bigint")
        mark.coalesce(1).write.mode("append").parquet(self._log_path(target))
        gone = []
        for piece in names_in(self.spark, self._data_path(target)):
            folder = f"{self._data_path(target)}/{piece}"
            kept = {f"{SLOT}={s}" for s, p in needed if piece == f"{PIECE}={p}"}
            for name in names_in(self.spark, folder) if kept else ():
                if name.startswith(f"{SLOT}=") and name not in kept:
                    gone.append(f"{folder}/{name}")
            gone += [] if kept else [folder]
        for folder in gone:
            delete(self.spark, folder)
        return gone
