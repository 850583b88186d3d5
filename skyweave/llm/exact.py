"""Exact deduplication by an extendible-hash index that lies in files of a shared folder.

The index holds narrow entries (``key``, ``chain``, ``n_bytes``, ``keep_id``, ``n_rows``), one for each
distinct text, in buckets. A bucket owns the range of 64-bit keys that begin with its prefix. A directory
of 2^depth slots names the bucket of each slot; a bucket whose entries outgrow it is split by one more
bit, and the directory doubles where the bucket already used all bits. Texts themselves move only where
a key has come more than once: there equal bytes are brought together, and texts that differ although
their keys agree become links of a chain. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.llm.rows import written
from skyweave.runtime import broadcast_checked, fits_broadcast, materialize, scratch_path
from skyweave.sources.catalog import dataset_exists

# Bytes of entries that a bucket holds before it is split; an entry counts as 40 bytes.
BUCKET_BYTES = 16 << 20
ENTRY_BYTES = 40

# A text with more than this share of all rows is hot: its entry travels to the rows, and not the
# rows to the entry. There can be no more hot texts than this.
MOST_HOT = 10_000

# Bits of a key; fewer make collisions, for tests.
KEY_BITS = 64

_ENTRY = ["key", "chain", "n_bytes", "keep_id", "n_rows"]
_BUCKET = ["depth", "prefix"]


def text_key(text: Column, bits: int = KEY_BITS) -> Column:
    """Hash of the text whose upper bits choose its bucket."""
    key = F.xxhash64(text)
    return key if bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - bits), 64 - bits)


def _prefix(depth: Column) -> Column:
    """The first ``depth`` bits of the key; a shift by 64 places would be none."""
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(key, 64 - depth)"))


class HashIndex:
    """An index in ``path``: ``entries`` by bucket and version, and one ``directory`` for each version."""

    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES, key_bits: int = KEY_BITS):
        self.spark, self.path, self.bucket_bytes, self.key_bits = spark, path, bucket_bytes, key_bits

    def version(self) -> int:
        """Batches added so far; a directory counts from the moment it is complete."""
        if not dataset_exists(self.spark, f"{self.path}/directory"):
            return 0
        return self.spark.read.parquet(f"{self.path}/directory").agg(F.max("number")).first()[0] or 0

    def directory(self) -> DataFrame:
        """Buckets in force: ``depth, prefix, n_entries, version``; they cover all keys and none twice."""
        number = self.version()
        if not number:
            empty = "depth int, prefix long, n_entries long, version int"
            return self.spark.createDataFrame([(0, 0, 0, 0)], empty)
        found = self.spark.read.parquet(f"{self.path}/directory").where(F.col("number") == number)
        return found.select("depth", "prefix", "n_entries", "version")

    def slots(self, buckets: DataFrame | None = None) -> DataFrame:
        """The directory (or some of its buckets) as a table of slots: ``global_depth, slot, depth, prefix``."""
        buckets = self.directory() if buckets is None else buckets
        bits = buckets.agg(F.max("depth")).first()[0] or 0
        own = f"shiftleft(1L, {bits} - depth)"
        slots = F.sequence(F.expr(f"prefix * {own}"), F.expr(f"(prefix + 1) * {own} - 1"))
        return buckets.select(F.lit(bits).alias("global_depth"), F.explode(slots).alias("slot"), *_BUCKET)

    def entries(self, buckets: DataFrame | None = None) -> DataFrame:
        """Entries in force, of the given buckets (``depth, prefix, version``) only."""
        schema = "key long, chain int, n_bytes long, keep_id long, n_rows long, version int, depth int, prefix long"
        if not self.version():
            return self.spark.createDataFrame([], schema).drop("version")
        wanted = broadcast_checked((self.directory() if buckets is None else buckets).select(*_BUCKET, "version"))
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/entries")
        # The comparison makes Spark prune the folders of other buckets and versions at run time.
        return stored.join(wanted.where("prefix >= 0"), [*_BUCKET, "version"], "left_semi").select(*_ENTRY, *_BUCKET)

    def _in_buckets(self, df: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
        """Add ``depth, prefix`` of the bucket that owns each key: one look-up of its slot."""
        slots = materialize(self.slots(buckets))
        bits = slots.agg(F.max("global_depth")).first()[0]
        if not bits:  # one bucket owns all keys
            return df.withColumns({"depth": F.lit(0), "prefix": F.lit(0).cast("long")})
        return df.withColumn("slot", F.shiftrightunsigned("key", 64 - bits)).join(broadcast_checked(slots.drop("global_depth")), "slot").drop("slot")

    def add(self, rows: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
        """Add rows (``doc_id``, ``text``) as the next version, and give its entries.

        ``earlier`` holds the rows added before; only the texts that the index names as kept under a
        key that comes again are read from it, to compare their bytes. An interrupted call leaves the
        last version in force.
        """
        number = self.version() + 1
        if number > 1 and earlier is None:
            raise ValueError("an index that holds entries needs the earlier rows, to compare texts")
        keyed = self.keyed(rows)
        # Copies meet in the task that reads them; one narrow row for each key and task is moved.
        counted = keyed.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_rows"), F.max("doc_id").alias("keep_id"), F.max("n_bytes").alias("n_bytes")
        )
        counted = written(counted, "exact-keys")
        placed = self._in_buckets(counted)
        touched = materialize(self.directory().join(
            broadcast_checked(placed.select(*_BUCKET).distinct()), _BUCKET, "left_semi"
        ))
        known = materialize(self.entries(touched))

        again = counted.where("n_rows > 1").select("key")
        if number > 1:
            again = again.union(counted.join(known.select("key"), "key", "left_semi").select("key")).distinct()
        again = materialize(again)
        texts = [keyed.select("key", "text", "doc_id", F.lit(1).cast("long").alias("n"))]
        if number > 1:
            kept = known.join(again, "key", "left_semi").select("key", "keep_id", "n_rows")
            old = self.keyed(earlier).withColumnRenamed("key", "old_key")
            same = (F.col("old_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
            once = old.join(kept, same).dropDuplicates(["key", "text"])
            texts.append(once.select("key", "text", "doc_id", F.col("n_rows").alias("n")))
        classes = self._classes(texts, again)
        few = broadcast_checked(again)
        single = counted.join(few, "key", "left_anti").withColumn("chain", F.lit(0)).select(*_ENTRY)
        untouched = known.join(few, "key", "left_anti").select(*_ENTRY)
        fresh = written(single.unionByName(classes).unionByName(untouched), "exact-entries")
        self._write(fresh, touched, number)
        return self.entries()

    def keyed(self, rows: DataFrame) -> DataFrame:
        text = F.coalesce(F.col("text"), F.lit(""))
        named = rows.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        return named.withColumns({"key": text_key(F.col("text"), self.key_bits), "n_bytes": F.octet_length("text").cast("long")})

    def _classes(self, texts: list[DataFrame], again: DataFrame) -> DataFrame:
        """Entries of the keys that came again: equal bytes are one entry, others links of a chain.

        Grouping by the text itself compares bytes; each task sends a text once, however many copies
        it has read. Should the keys be too many to send to the tasks, all texts are grouped.
        """
        if fits_broadcast(again):
            texts = [t.join(F.broadcast(again), "key", "left_semi") for t in texts]
        rows = texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])
        grouped = rows.groupBy("key", "text").agg(F.sum("n").alias("n_rows"), F.max("doc_id").alias("keep_id"))
        if not fits_broadcast(again):
            grouped = grouped.join(again, "key", "left_semi")
        links = Window.partitionBy("key").orderBy("text")
        chained = grouped.withColumn("chain", F.row_number().over(links) - 1)
        return chained.withColumn("n_bytes", F.octet_length("text").cast("long")).select(*_ENTRY)

    def _write(self, fresh: DataFrame, touched: DataFrame, number: int) -> None:
        """Split overfull buckets among the touched ones, write their entries and then the directory."""
        split = materialize(self._split(self._in_buckets(fresh, touched), touched))
        rows = self._in_buckets(fresh, split).withColumn("version", F.lit(number))
        # An owner task holds whole key ranges, and writes them in order of the keys.
        rows = rows.hint("rebalance", *_BUCKET).sortWithinPartitions(*_BUCKET, "key", "chain")
        rows.write.mode("append").partitionBy("version", *_BUCKET).parquet(f"{self.path}/entries")
        left = self.directory().join(broadcast_checked(touched.select(*_BUCKET)), _BUCKET, "left_anti")
        new = split.select(*_BUCKET, "n_entries", F.lit(number).alias("version"))
        if number == 1:
            left = left.limit(0)
        both = materialize(left.unionByName(new))
        both.withColumn("number", F.lit(number)).coalesce(1).write.mode("append").parquet(f"{self.path}/directory")

    def _split(self, fresh: DataFrame, touched: DataFrame) -> DataFrame:
        """Buckets after all splits: ``depth, prefix, n_entries``.

        Every round splits the overfull buckets by one bit. A bucket of one key cannot be split; its
        links stay one chain.
        """
        full = max(1, self.bucket_bytes // ENTRY_BYTES)
        keys = materialize(fresh.groupBy(*_BUCKET, "key").agg(F.count(F.lit(1)).alias("n")))
        sizes = keys.groupBy(*_BUCKET).agg(F.sum("n").alias("n_entries"), F.count(F.lit(1)).alias("n_keys"))
        sizes = materialize(touched.select(*_BUCKET).join(sizes, _BUCKET, "left").na.fill(0, ["n_entries", "n_keys"]))
        done = None
        while True:
            over = (F.col("n_entries") > full) & (F.col("n_keys") > 1)
            fits = sizes.where(~over)
            done = fits if done is None else done.unionByName(fits)
            overfull = materialize(sizes.where(over))
            if overfull.isEmpty():
                return done.select(*_BUCKET, "n_entries")
            keys = keys.join(broadcast_checked(overfull.select(*_BUCKET)), _BUCKET, "left_semi")
            keys = materialize(keys.withColumn("depth", F.col("depth") + 1).withColumn("prefix", _prefix(F.col("depth"))))
            halves = overfull.select(F.col("depth") + 1, F.explode(F.expr("array(prefix * 2, prefix * 2 + 1)"))).toDF(*_BUCKET)
            counts = keys.groupBy(*_BUCKET).agg(F.sum("n").alias("n_entries"), F.count(F.lit(1)).alias("n_keys"))
            sizes = materialize(halves.join(counts, _BUCKET, "left").na.fill(0, ["n_entries", "n_keys"]))


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, bucket_bytes: int = BUCKET_BYTES,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    A null text counts as an empty one. Of rows with equal bytes, the one with the largest id is kept;
    rows that share this id are one document and all stay. Null ids are smaller than all others; where
    a group has no other, its rows stay and ``keep_id`` is null. Columns besides the two are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    index = HashIndex(spark, scratch_path(spark, "exact-index"), bucket_bytes, key_bits)
    entries = index.add(rows)
    keyed = index.keyed(rows)
    collided = materialize(entries.where("chain > 0").select("key").distinct())
    if collided.isEmpty():
        linked = keyed.withColumn("chain", F.lit(0))
    else:
        chains = keyed.join(broadcast_checked(collided), "key", "left_semi").select("key", "text").distinct()
        links = chains.withColumn("chain", F.row_number().over(Window.partitionBy("key").orderBy("text")) - 1)
        links = broadcast_checked(materialize(links))
        linked = keyed.join(links, ["key", "text"], "left").withColumn("chain", F.coalesce("chain", F.lit(0)))
    narrow = linked.select("doc_id", "key", "chain", F.sha2("text", 256).alias("text_sha256"))
    entries = entries.select("key", "chain", "keep_id", "n_rows")
    total = entries.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    is_hot = F.col("n_rows") * MOST_HOT > total
    hot = F.broadcast(materialize(entries.where(is_hot)))
    with_hot = narrow.join(hot, ["key", "chain"], "left")
    of_hot = with_hot.where(F.col("n_rows").isNotNull())
    others = with_hot.where(F.col("n_rows").isNull()).drop("keep_id", "n_rows")
    of_others = others.join(entries.where(~is_hot), ["key", "chain"])
    return of_hot.unionByName(of_others).select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows that ``exact_groups`` keeps, with their columns as they came."""
    found = exact_groups(docs, key, text, **settings)
    gone = broadcast_checked(materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_sha256").alias("_sha"))))
    mine = F.sha2(F.coalesce(docs[f"`{text}`"], F.lit("")), 256)
    same = docs[f"`{key}`"].cast("long").eqNullSafe(gone["_gone"]) & (mine == gone["_sha"])
    return docs.join(gone, same, "left_anti")
