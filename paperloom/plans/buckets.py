"""Current papers in buckets: an upsert reads and writes the buckets that it changes, and shuffles no stored row.

The snapshot is a bucketed Parquet table: rows lie by ``pmod(hash(paper_id), buckets)``, which is also how Spark places them
for a join on ``paper_id``.  Every upsert writes new files of the changed buckets under the next generation, and
then one row that lists them.  A bucket is read from the newest listed generation that holds it, so a generation that died
half-way is never seen.  Bucket and generation are partition columns: what is not read is pruned as directories.

The number of buckets is fixed when the snapshot is made.  It bounds what the driver holds: one number per bucket.
One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from paperloom import schemas
from paperloom.functions.literals import constant
from paperloom.plans.staging import file_system
from paperloom.plans.store import PaperStore, apply_changes, latest_changes

GENERATIONS = "generation bigint, buckets array<int>, of int, fresh boolean"
FOLDED = "generation bigint, run_id bigint, attempt bigint"


class BucketedPapers:
    """One row per ``paper_id`` with its ``run_id``; further columns as the schema says."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, buckets: int = 1024):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        known = self._generations().select(F.max("of")).first()[0]
        if known and known != buckets:
            raise ValueError(f"{self.root} has {known} buckets, not {buckets}")
        self.buckets = buckets
        self.table = "papers_" + hashlib.sha256(self.root.encode()).hexdigest()[:24]

    def _generations(self) -> DataFrame:
        empty = self.spark.createDataFrame([], GENERATIONS)
        empty.write.mode("ignore").parquet(f"{self.root}/generations")
        return self.spark.read.schema(GENERATIONS).parquet(f"{self.root}/generations")

    def _register(self) -> str:
        """The catalog entry of this session for the files; names no data of its own."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        if not self.spark.catalog.tableExists(self.table):
            place, files = file_system(self.spark, f"{self.root}/papers")
            files.mkdirs(place)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}, generation BIGINT, bucket INT) USING parquet "
                f"PARTITIONED BY (generation, bucket) CLUSTERED BY (paper_id) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.root}/papers'"
            )
        # Folders that other sessions wrote.
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return self.table

    def bucket_of(self, paper_id: Column) -> Column:
        """Spark's own placement of a key, so that a bucket is one partition of a join."""
        return F.pmod(F.hash(paper_id), F.lit(self.buckets))

    def newest(self) -> dict[int, int]:
        """The generation to read each bucket from."""
        rows = self._generations().orderBy("generation").collect()
        start = max((r.generation for r in rows if r.fresh), default=0)
        return {bucket: r.generation for r in rows if r.generation >= start for bucket in r.buckets}

    def current(self, buckets: list[int] | None = None) -> DataFrame:
        """All papers, or those of some buckets; a bucketed scan of the newest files."""
        newest = self.newest()
        some = newest if buckets is None else set(buckets)
        wanted = {str(b): g for b, g in newest.items() if b in some}
        rows = self.spark.table(self._register())
        newest_of = constant(wanted, "map<string,bigint>")[F.col("bucket").cast("string")]
        return rows.where(F.col("generation") == newest_of).select(*self.schema.fieldNames())

    def of_ids(self, ids: DataFrame) -> DataFrame:
        """Papers whose ``paper_id`` is in a list of any length: only the buckets of these ids are read, and met where they lie."""
        wanted = ids.select("paper_id").distinct()
        buckets = wanted.select(self.bucket_of(F.col("paper_id")).alias("bucket")).distinct()
        return self.current([r.bucket for r in buckets.collect()]).join(wanted, "paper_id", "left_semi")

    def merged(self, changes: DataFrame, buckets: list[int]) -> DataFrame:
        """Rows of the buckets after the changes.  Stored rows meet the changed ids where they lie."""
        changes = changes.select(*self.schema.fieldNames())
        return apply_changes(self.current(buckets), changes, self.buckets).select(*self.schema.fieldNames())

    def upsert(
        self, changes: DataFrame, fresh: bool = False, before_listing: Callable[[int], None] | None = None
    ) -> int:
        """Put changes into their buckets; the newest run of a paper wins.  Returns the generation, 0 for no changes.

        ``changes`` should be a stored table, as it is read twice.  ``fresh`` forgets what is stored.
        ``before_listing`` notes what belongs to the generation before any reader can see it.
        """
        touched = changes.select(self.bucket_of(F.col("paper_id")).alias("bucket")).distinct().orderBy("bucket")
        buckets = [r.bucket for r in touched.collect()]
        if not buckets and not fresh:
            return 0
        table = self._register()
        used = self.spark.sql(f"SHOW PARTITIONS {table}")
        number = F.regexp_extract("partition", r"generation=(\d+)", 1).cast("bigint")
        last = max(used.select(F.max(number)).first()[0] or 0, self._generations().select(F.max("generation")).first()[0] or 0)
        generation = last + 1
        if fresh:
            newest = latest_changes(changes.select(*self.schema.fieldNames())).select(*self.schema.fieldNames())
            rows = newest.repartition(self.buckets, "paper_id")
        else:
            rows = self.merged(changes, buckets)
        placed = rows.withColumns(
            {"generation": F.lit(generation).cast("bigint"), "bucket": self.bucket_of(F.col("paper_id"))}
        )
        placed.write.insertInto(table)
        if before_listing:
            before_listing(generation)
        row = (generation, buckets, self.buckets, fresh)
        made = self.spark.createDataFrame([row], GENERATIONS).coalesce(1)
        made.write.mode("append").parquet(f"{self.root}/generations")
        return generation


class BucketedStore(PaperStore):
    """A paper store whose snapshot is bucketed; finished runs are folded into it by ``compact``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 1024):
        super().__init__(spark, root)
        schema = StructType([schemas.CHANGES[c] for c in schemas.CHANGE_COLUMNS])
        self.snapshot = BucketedPapers(spark, f"{self.root}/bucketed", schema, buckets)

    def create(self) -> BucketedStore:
        super().create()
        self.spark.createDataFrame([], FOLDED).write.mode("ignore").parquet(self._path("folded"))
        return self

    def _folded(self) -> DataFrame:
        """Attempts that the snapshot holds."""
        listed = self.snapshot._generations()
        start = listed.where("fresh").select(F.max("generation")).first()[0] or 0
        listed = listed.where(F.col("generation") >= start).select("generation")
        folded = self.spark.read.schema(FOLDED).parquet(self._path("folded"))
        return folded.join(listed, "generation", "left_semi").select(*schemas.RUN_KEYS)

    def _is_valid(self) -> bool:
        """Whether no run in the snapshot was repeated since."""
        return self._folded().join(self._finished(), schemas.RUN_KEYS, "left_anti").isEmpty()

    def _pending(self, valid: bool) -> tuple[DataFrame, DataFrame]:
        """Finished attempts that are not in the snapshot, and their changes."""
        wanted = self._finished()
        if valid:
            wanted = wanted.join(self._folded(), schemas.RUN_KEYS, "left_anti")
        changes = self._read("changes", schemas.CHANGES).join(wanted, schemas.RUN_KEYS, "left_semi")
        return wanted, changes.select(*schemas.CHANGE_COLUMNS)

    def papers(self) -> DataFrame:
        valid = self._is_valid()
        _, changes = self._pending(valid)
        current = apply_changes(self.snapshot.current(), changes) if valid else latest_changes(changes)
        return current.select(*schemas.CHANGE_COLUMNS, F.left("published", F.lit(7)).alias("published_month"))

    def compact(self) -> int:
        """Fold finished runs in.  A repeated run makes the snapshot anew from the change log, which is kept whole."""
        valid = self._is_valid()
        wanted, changes = self._pending(valid)
        if wanted.isEmpty():
            return max(self.snapshot.newest().values(), default=0)

        def note(generation: int) -> None:
            rows = wanted.select(F.lit(generation).cast("bigint").alias("generation"), *schemas.RUN_KEYS)
            rows.write.mode("append").parquet(self._path("folded"))

        self.snapshot.upsert(changes, fresh=not valid, before_listing=note)
        return max(self.snapshot.newest().values(), default=0)
