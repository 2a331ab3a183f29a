"""Token ids as binary shards in key order, with a perfect-hash index.

A folder holds

``shards/``  one file per shard, in a folder named after its partition and
             number: a head (magic, version, bytes per id, partition, number in
             the partition, ids of the partition before it, documents, ids,
             documents without a key), then key, null mark and id count of
             every document, then the ids of all, little-endian, 16 bits.
``index/``   one file per bucket of key hashes, in a folder named after the
             bucket: a head (magic, version,
             bucket, entries), a minimal perfect hash, and per entry a
             fingerprint of the key, partition, shard, place of the document's
             first id in the shard, id count and number of copies of the key.
``bases``    a table with the ids before each partition and its documents.
``heads``    a table of the shards that hold documents without a key.

A key is found in constant time: its hash names the index file and, through
the perfect hash, the entry; the stored fingerprint tells a foreign key apart;
the entry names the shard file. Only files that are named so are opened: a
join with the wanted names prunes the folders when a scan starts.
Files are written by Spark's own writer, one row a file, so a lost task leaves
nothing behind, and any store that Spark can write will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.llm import word_bpe
from rostermill.llm.bpe import slices
from rostermill.llm.packing import in_key_order
from rostermill.llm.perfect_hash import PerfectHash
from rostermill.llm.wordscan import mix
from rostermill.workdir import staged

#: ids of a shard, unless one document has more
SHARD_IDS = 4_000_000
#: documents of an index bucket, on average
BUCKET_KEYS = 20_000

_MAGIC = b"IDSHARDS"
_HEAD = "<8sIIQQQQQQ"
_HEAD_SIZE = struct.calcsize(_HEAD)
_INDEX_MAGIC = b"IDINDEX_"
_INDEX_HEAD = "<8sIQQ"
_INDEX_HEAD_SIZE = struct.calcsize(_INDEX_HEAD)
_BASES = "part long, base long, docs long"
_HEADS = "part long, shard long"
_ENTRY = np.dtype(
    [("print", "<u8"), ("part", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("ids", "<u8"), ("copies", "<u4")]
)


def _write_files(rows: DataFrame, path: str, *names: str) -> None:
    """One file per row, holding its ``blob`` and a line end, in folders named
    after the columns ``names``."""
    values = rows.selectExpr("cast(blob AS string) AS value", *names)
    values.write.partitionBy(*names).option("maxRecordsPerFile", 1).text(path)


def _read_files(spark: SparkSession, path: str, names: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """(names, content) of files, with ``wanted`` (names) only of those.

    ``names`` are the columns in the folders' names. Numbers are never
    negative; the comparison lets the optimizer prune folders by the join.
    """
    files = spark.read.format("binaryFile").load(path)
    for name in names:
        if name not in files.columns:  # no file at all
            files = files.withColumn(name, F.lit(None).cast("long"))
    files = files.select(*names, "content")
    if wanted is not None:
        near = wanted.select(*[F.col(n).cast(files.schema[n].dataType) for n in names]).distinct()
        # written, so that the names' true size decides how they are joined
        near = staged(near, "names").where(" AND ".join(f"{n} >= 0" for n in names))
        files = files.join(near, names, "left_semi")
    # numbers in folder names are read as int; rows are dealt by type and value
    return files.select(*[F.col(n).cast("long").alias(n) for n in names], "content")


# -- shards -------------------------------------------------------------------


def _shard(keys: pa.Array, ids: list[bytes], part: int, number: int, before: int) -> bytes:
    counts = np.array([len(x) // 2 for x in ids], dtype="<u8")
    null = np.array(keys.is_null().to_pylist(), dtype=np.uint8)
    head = struct.pack(_HEAD, _MAGIC, 2, 2, part, number, before, len(ids), int(counts.sum()), int(null.sum()))
    return b"".join([head, keys.fill_null(0).to_numpy().astype("<i8").tobytes(), null.tobytes(), counts.tobytes(), *ids])


class Shard:
    """A shard file taken apart."""

    def __init__(self, data: bytes):
        magic, version, width, self.part, self.number, self.before, docs, ids, _ = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC or version != 2 or width != 2:
            raise ValueError("not a shard of this version")
        at = _HEAD_SIZE
        self.keys = np.frombuffer(data, "<i8", docs, at)
        self.null = np.frombuffer(data, "u1", docs, at + 8 * docs).astype(bool)
        self.counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.ids = np.frombuffer(data, "<u2", ids, at + 17 * docs)


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode all documents and write ``shards``, ``bases`` and ``heads``.

    Null and empty texts are the end id alone; a null key sorts first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(tokenizer)
        end = np.uint16(end_id).tobytes()
        part = TaskContext.get().partitionId()
        keys: list[pa.Array] = []
        held: list[bytes] = []
        number = size = before = 0
        for batch in batches:
            for piece in slices(batch):
                keys.append(piece.column(0).cast(pa.int64()))
                new = [ids + end for ids in bpe.encode(piece.column(1).to_pylist())]
                held += new
                size += sum(map(len, new)) // 2
                if size >= SHARD_IDS:
                    yield _row(_shard(pa.concat_arrays(keys), held, part, number, before), part, number)
                    number, before = number + 1, before + size
                    keys, held, size = [], [], 0
        if held:
            yield _row(_shard(pa.concat_arrays(keys), held, part, number, before), part, number)

    spark = docs.sparkSession
    blobs = in_key_order(docs, key, text).mapInArrow(run, "blob binary, part long, shard long")
    _write_files(blobs, f"{folder}/shards", "part", "shard")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [struct.unpack_from(_HEAD, x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h[3] for h in heads], pa.int64()),
                    pa.array([h[6] for h in heads], pa.int64()),
                    pa.array([h[5] + h[7] for h in heads], pa.int64()),
                    pa.array([h[4] for h in heads], pa.int64()),
                    pa.array([h[8] for h in heads], pa.int64()),
                ],
                names=["part", "docs", "ids", "shard", "unkeyed"],
            )

    # one row per partition of the write, not per shard or document
    head = F.substring("content", 1, _HEAD_SIZE).alias("head")
    stored = _read_files(spark, f"{folder}/shards", ["part", "shard"]).select(head)
    ends = stored.mapInArrow(sizes, "part long, docs long, ids long, shard long, unkeyed long")
    ends = staged(ends, "heads")
    total, bases = 0, []
    for row in ends.groupBy("part").agg(F.max("ids").alias("ids"), F.sum("docs").alias("docs")).orderBy("part").collect():
        bases.append((row["part"], total, row["docs"]))
        total += row["ids"]
    spark.createDataFrame(bases, _BASES).coalesce(1).write.parquet(f"{folder}/bases")
    ends.where("unkeyed > 0").select("part", "shard").write.parquet(f"{folder}/heads")


def _row(blob: bytes, part: int, number: int) -> pa.RecordBatch:
    arrays = [pa.array([blob], pa.binary()), pa.array([part], pa.int64()), pa.array([number], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["blob", "part", "shard"])


# -- index --------------------------------------------------------------------


def _key_hash(keys: np.ndarray, copy: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) ^ mix(copy.astype(np.uint64) + np.uint64(1)))


def _print(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def write_index(spark: SparkSession, folder: str) -> int:
    """Read the shards' document tables and write ``index``; the bucket count."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                shard = Shard(data)
                real = ~shard.null
                count = int(real.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.keys[real]),
                        pa.array(np.full(count, shard.part), pa.int64()),
                        pa.array(np.full(count, shard.number), pa.int64()),
                        pa.array(shard.first[real]),
                        pa.array(shard.counts[real]),
                    ],
                    names=["key", "part", "shard", "first", "ids"],
                )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "part", "shard", "first"])
        keys = group["key"].to_numpy()
        copy = group.groupby("key").cumcount().to_numpy()
        hashed = _key_hash(keys, copy)
        perfect = PerfectHash.build(hashed)
        entries = np.zeros(len(keys), dtype=_ENTRY)
        at = perfect.numbers(hashed)
        entries["print"][at] = _print(keys)
        for name in ("part", "shard", "first", "ids"):
            entries[name][at] = group[name].to_numpy()
        entries["copies"][at] = group.groupby("key")["key"].transform("size").to_numpy()
        head = struct.pack(_INDEX_HEAD, _INDEX_MAGIC, 1, int(group["bucket"].iloc[0]), len(keys))
        blob = head + perfect.to_bytes() + entries.tobytes()
        return pd.DataFrame({"blob": [blob], "bucket": [int(group["bucket"].iloc[0])]})

    shards = _read_files(spark, f"{folder}/shards", ["part", "shard"]).select("content")
    rows = shards.mapInArrow(tables, "key long, part long, shard long, first long, ids long")
    docs = spark.read.schema(_BASES).parquet(f"{folder}/bases").agg(F.sum("docs")).first()[0] or 0
    buckets = max(1, -(-docs // BUCKET_KEYS))
    built = rows.withColumn("bucket", _bucket("key", buckets)).groupBy("bucket").applyInPandas(build, "blob binary, bucket long")
    _write_files(built, f"{folder}/index", "bucket")
    return buckets


def lookup(spark: SparkSession, folder: str, buckets: int, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where the documents of some keys lie: key, part, shard, first, ids.

    Unknown and null keys give no row; a key written several times gives a row
    for each.
    """

    def find(wanted: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        out = {name: np.zeros(0, np.int64) for name in ("key", "part", "shard", "first", "ids")}
        if len(files) and len(wanted):
            data = memoryview(files["blob"].iloc[0])
            magic, version, _, count = struct.unpack_from(_INDEX_HEAD, data)
            if magic != _INDEX_MAGIC or version != 1:
                raise ValueError("not an index of this version")
            perfect, size = PerfectHash.from_bytes(data[_INDEX_HEAD_SIZE :])
            entries = np.frombuffer(data, _ENTRY, count, _INDEX_HEAD_SIZE + size)

            def entry(known: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                at = perfect.numbers(_key_hash(known, copy))
                good = at >= 0
                known, at = known[good], at[good]
                good = entries["print"][at] == _print(known)
                return known[good], at[good]

            known = wanted["key"].to_numpy()
            known, at = entry(known, np.zeros(len(known), dtype=np.int64))
            copies = entries["copies"][at].astype(np.int64)
            if (copies > 1).any():
                copy = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                known, at = entry(np.repeat(known, copies), copy)
            out = {"key": known} | {n: entries[n][at].astype(np.int64) for n in ("part", "shard", "first", "ids")}
        return pd.DataFrame(out)

    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    wanted = wanted.withColumn("bucket", _bucket("key", buckets))
    files = _read_files(spark, f"{folder}/index", ["bucket"], wanted).withColumnRenamed("content", "blob")
    return (
        wanted.groupBy("bucket")
        .cogroup(files.groupBy("bucket"))
        .applyInPandas(find, "key long, part long, shard long, first long, ids long")
    )


# -- reading ------------------------------------------------------------------


def scan(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """Every stored document with its ids, in 32-bit form; with ``wanted``
    (part, shard) those of some shards.

    Returns part, shard, first, unkeyed, start (ids of all documents before
    it), n_tokens, ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                shard = Shard(data)
                for low in range(0, len(shard.counts), 2000):
                    part = slice(low, low + 2000)
                    first, counts = shard.first[part], shard.counts[part]
                    wide = shard.ids[int(first[0]) : int(first[-1] + counts[-1])].astype("<u4").tobytes()
                    cut = (first - first[0]) * 4
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(first), shard.part), pa.int64()),
                            pa.array(np.full(len(first), shard.number), pa.int64()),
                            pa.array(first),
                            pa.array(shard.null[part]),
                            pa.array(first + shard.before),
                            pa.array(counts),
                            pa.array(
                                [wide[a : a + 4 * n] for a, n in zip(cut.tolist(), counts.tolist())], pa.binary()
                            ),
                        ],
                        names=["part", "shard", "first", "unkeyed", "within", "n_tokens", "ids"],
                    )

    rows = _read_files(spark, f"{folder}/shards", ["part", "shard"], wanted).select("content").mapInArrow(
        run, "part long, shard long, first long, unkeyed boolean, within long, n_tokens long, ids binary"
    )
    bases = spark.read.schema(_BASES).parquet(f"{folder}/bases").select("part", "base")
    # one base per write partition: a bounded table
    return rows.join(F.broadcast(bases), "part").select(
        "part", "shard", "first", "unkeyed", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids"
    )


def read_keys(spark: SparkSession, folder: str, buckets: int, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored documents of some keys: doc_id, start, n_tokens, ids_crc32.

    Places come from the index, and only the shards that they name are read;
    if a null key is asked for, documents stored without a key follow with a
    null doc_id. ``ids_crc32`` is taken over all ids in 32-bit form.
    """
    places = lookup(spark, folder, buckets, keys, key).select(
        F.col("key").alias("doc_id"), "part", "shard", "first", F.col("ids").alias("indexed")
    )
    places = staged(places, "places")
    shards = places.select("part", "shard")
    unkeyed = keys.where(F.col(key).isNull()).limit(1).count() > 0
    if unkeyed:
        shards = shards.union(spark.read.schema(_HEADS).parquet(f"{folder}/heads"))
    stored = scan(spark, folder, shards).select("part", "shard", "first", "unkeyed", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return (
        stored.join(places, ["part", "shard", "first"], "left")
        .where((F.col("unkeyed") & F.lit(unkeyed)) | (F.col("indexed") == F.col("n_tokens")))
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )
