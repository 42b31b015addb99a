"""Token ids in raw binary files, with keyed access by a minimal perfect hash.

A data set is a folder of

- ``ids-<shard>.bin``: token ids of documents in ascending order of key, little
  endian, two bytes each if the vocabulary allows, else four, without header;
- ``index-<bucket>.npz``: for the keys of a bucket a minimal perfect hash
  (levels of bit arrays), and at each key's slot a stored fingerprint of the
  key, the shard, the first id's place in it and the number of ids;
- ``manifest.json``: the id width, the buckets, and ids per shard.

A key's bucket and slot are computed, never searched, so a lookup takes the
same time at any size. Tasks write under names of their own and rename at the
end; a repeated task writes the same bytes, so losing an executor does no harm.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah.llm.common import partitions
from tezgah.llm.tokens import BARE, encoder
from tezgah.sources.shared import scratch_path

END = 1
#: Bit array cells per key in a level of the hash.
SPARE = 2
LEVELS = 64
#: Keys per index file, about.
BUCKET_KEYS = 1 << 20
INDEX = "key long, shard int, first long, n_ids long"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64-bit numbers of keys and a seed (the finalizer of splitmix64, a fixed rule)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


class PerfectHash:
    """A minimal perfect hash of different 64-bit keys: ``slot`` numbers them from 0 without gaps.

    A level is a bit array; a key owns the cell it hashes to if no other key
    left does, and goes on to the next level otherwise. A key's slot is the rank
    of its cell. Keys that were not in the set get some slot or -1; the
    fingerprint stored at the slot tells them apart.
    """

    def __init__(self, bits: np.ndarray, starts: np.ndarray) -> None:
        self.bits, self.starts = bits, starts
        self.ranks = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, starts = [], [0]
        left = np.unique(keys)
        if len(left) != len(keys):
            raise ValueError("keys must differ")
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys collide in every level")
            cells = (_mixed(left, len(levels)) % np.uint64(SPARE * len(left))).astype(np.int64)
            alone = np.bincount(cells, minlength=SPARE * len(left)) == 1
            levels.append(alone)
            starts.append(starts[-1] + len(alone))
            left = left[~alone[cells]]
        return cls(np.concatenate(levels or [np.zeros(0, bool)]), np.array(starts, np.int64))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (a, b) in enumerate(zip(self.starts, self.starts[1:], strict=False)):
            if not len(left):
                break
            cells = a + (_mixed(keys[left], level) % np.uint64(b - a)).astype(np.int64)
            own = self.bits[cells]
            slots[left[own]] = self.ranks[cells[own]]
            left = left[~own]
        return slots


def _prints(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(keys, 1 << 21) % np.uint64(buckets)).astype(np.int64)


def _at(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _put(path: str, name: str, data: bytes) -> None:
    store, folder = _at(path)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{folder}/{name}")


def _get(path: str, name: str) -> bytes:
    store, folder = _at(path)
    with store.open_input_stream(f"{folder}/{name}") as file:
        return file.read()


def _shard_writer(path: str, tokenizer: str, dtype: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, BARE, dtype).encode
        end, width = np.array([END], dtype).tobytes(), np.dtype(dtype).itemsize
        store, folder = _at(path)
        out, shard, at = None, None, 0
        own = f"{folder}/.ids-{uuid.uuid4().hex}"
        for batch in batches:
            keys, parts = batch.column("doc_id"), [raw + end for raw in encode(batch.column("text").to_pylist())]
            if not parts:
                continue
            if out is None:
                shard = batch.column("shard")[0].as_py()
                out = store.open_output_stream(own)
            out.write(b"".join(parts))
            sizes = np.array([len(p) // width for p in parts], np.int64)
            firsts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(sizes), shard, np.int32)), pa.array(firsts), pa.array(sizes)], ["key", "shard", "first", "n_ids"])
        if out is not None:
            out.close()
            store.move(own, f"{folder}/ids-{shard}.bin")

    return write


def _index_writer(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        bucket = None

        def close() -> pa.RecordBatch:
            key, shard, first, n = (np.concatenate(x) for x in zip(*held, strict=True))
            hashed = PerfectHash.of(np.unique(key))
            slots = hashed.slot(key)
            order = np.lexsort((first, slots))  # a key's rows side by side
            heads = order[np.flatnonzero(np.diff(slots[order], prepend=-1))]
            rows = np.bincount(slots)
            file = io.BytesIO()
            np.savez(file, bits=np.packbits(hashed.bits), n_bits=len(hashed.bits), starts=hashed.starts, prints=_prints(key[heads]), rows=rows, shard=shard[order], first=first[order], n_ids=n[order])
            _put(path, f"index-{bucket}.npz", file.getvalue())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([len(key)], pa.int64())], ["bucket", "n"])

        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            columns = [batch.column(c).to_numpy() for c in ("key", "shard", "first", "n_ids")]
            cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else []
            for a, b in zip(cuts, [*cuts[1:], len(buckets)], strict=True):
                if held and buckets[a] != bucket:
                    yield close()
                bucket = int(buckets[a])
                held.append([c[a:b] for c in columns])
        if held:
            yield close()

    return write


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, dtype: str = "<u2", shards: int | None = None) -> str:
    """Writes the data set and returns its folder.

    ``docs`` has ``doc_id`` and ``text``; NULL texts are empty. Rows without
    ``doc_id`` have no key and are left out; rows that repeat a key are all
    written, one after the other by text, and found together. No rows make a data set without shards. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    store, folder = _at(path)
    store.create_dir(folder, recursive=True)
    keyed = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = shards or partitions(spark)
    ordered = keyed.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.select("doc_id", "text", F.spark_partition_id().alias("shard")).mapInArrow(_shard_writer(path, tokenizer, dtype), INDEX)
    index_path = f"{path}/written.parquet"
    written.write.parquet(index_path)
    entries = spark.read.schema(INDEX).parquet(index_path)
    totals = {int(r.shard): (int(r.ids), int(r.keys)) for r in entries.groupBy("shard").agg(F.sum("n_ids").alias("ids"), F.count("*").alias("keys")).collect()}  # a row per shard
    buckets = max(partitions(spark), -(-sum(k for _, k in totals.values()) // BUCKET_KEYS))
    dealt = with_bucket(entries, "key", buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    dealt.mapInArrow(_index_writer(path), "bucket long, n long").agg(F.sum("n")).collect()
    _put(path, "manifest.json", json.dumps({"dtype": dtype, "buckets": buckets, "shards": {str(k): v[0] for k, v in sorted(totals.items())}}).encode())
    return path


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    @F.pandas_udf("long")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(keys.to_numpy(), buckets))

    return df.withColumn("bucket", of(key))


def open_manifest(path: str) -> dict:
    return json.loads(_get(path, "manifest.json"))


class Index:
    """One bucket's index file."""

    def __init__(self, path: str, bucket: int) -> None:
        with np.load(io.BytesIO(_get(path, f"index-{bucket}.npz"))) as file:
            self.hash = PerfectHash(np.unpackbits(file["bits"], count=int(file["n_bits"])).astype(bool), file["starts"])
            self.prints, self.rows, self.shard, self.first, self.n_ids = (file[x] for x in ("prints", "rows", "shard", "first", "n_ids"))
        self.begins = np.cumsum(self.rows) - self.rows

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each row of the keys that are there: its key, shard, place and number of ids."""
        slots = self.hash.slot(keys)
        there = slots >= 0
        there[there] = self.prints[slots[there]] == _prints(keys[there])
        slots, rows = slots[there], self.rows[slots[there]]
        at = np.repeat(self.begins[slots] - (np.cumsum(rows) - rows), rows) + np.arange(rows.sum())
        return np.repeat(keys[there], rows), self.shard[at], self.first[at], self.n_ids[at]


def _finder(path: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, index = None, None
        for batch in batches:
            keys, buckets = batch.column("key").to_numpy(), batch.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else []
            for a, b in zip(cuts, [*cuts[1:], len(buckets)], strict=True):
                if buckets[a] != bucket:
                    bucket = int(buckets[a])
                    index = Index(path, bucket)
                key, shard, first, n = index.find(keys[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(shard), pa.array(first), pa.array(n)], ["key", "shard", "first", "n_ids"])

    return find


def find_keys(keys: DataFrame, path: str) -> DataFrame:
    """``(key, shard, first, n_ids)`` of each row of each key that the data set has, by its index files alone."""
    manifest = open_manifest(path)
    spark = keys.sparkSession
    if not manifest["shards"]:
        return spark.createDataFrame([], INDEX)
    named = keys.toDF("key").where("key is not null")
    dealt = with_bucket(named, "key", manifest["buckets"]).repartition(manifest["buckets"], "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_finder(path), INDEX)


def read_ids(found: DataFrame, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the payload of each key found.

    ``start`` counts the ids of all documents before. The checksum is of the
    ids as four bytes each, whatever the width in the files.
    """
    spark: SparkSession = found.sparkSession
    manifest = open_manifest(path)
    dtype = np.dtype(manifest["dtype"])
    starts, at = {}, 0
    for shard, n in sorted((int(k), v) for k, v in manifest["shards"].items()):
        starts[shard] = at
        at += n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _at(path)
        shard, file = None, None
        for batch in batches:
            sums, begins = [], []
            for s, first, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "n_ids")), strict=True):
                if s != shard:
                    shard, file = s, store.open_input_file(f"{folder}/ids-{s}.bin")
                raw = file.read_at(n * dtype.itemsize, first * dtype.itemsize)
                sums.append(zlib.crc32(np.frombuffer(raw, dtype).astype("<u4").tobytes()))
                begins.append(starts[s] + first)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(begins, pa.int64()), batch.column("n_ids"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    width = partitions(spark)
    dealt = found.repartition(width, "shard", F.shiftright("first", 22)).sortWithinPartitions("shard", "first")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
