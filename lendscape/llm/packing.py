"""Best-fit packing of documents into bins of tokens, with conflicts.

Documents are dealt by hash into shards of bounded size and packed there by
decreasing length. Open bins lie in the order of their free space and carry
bitmaps of the sources and duplicate clusters they hold. The search starts at
the tightest bin that is large enough and goes on to its successors until one
holds neither the document's source nor its cluster; without one, a bin is
opened. Documents longer than a bin fill whole bins first; their rest is packed.

Only ids, sources, cluster hashes and lengths are shuffled. Shards are counted
before they are packed: one that was dealt over twice its size (repeated rows
share their hash) is dealt again by row number, so memory stays bounded and no
shard ever starts over.

Defined cases: a NULL text is a document of length 0, which takes room in the
tightest bin that allows it; a NULL source is a source of its own; repeated rows
are packed one by one and, being of one cluster, into different bins; an empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import table, text_of, words_of
from lendscape.session import keep

CAPACITY = 2048
SHARD = 4096
RESULT = "doc_id long, piece int, bin long, start int, length int"


class Bins:
    """Open bins of one shard."""

    def __init__(self, capacity: int, first: int = 0):
        self.capacity, self.next = capacity, first
        self.free: list[tuple[int, int]] = []  # free space and bin, ascending
        self.held: dict[int, tuple[int, int]] = {}  # bitmaps of sources and clusters per bin
        self.sources: dict = {}
        self.clusters: dict = {}

    def _bit(self, seen: dict, value) -> int:  # noqa: ANN001
        return 1 << seen.setdefault(value, len(seen))

    def place(self, length: int, source, cluster) -> tuple[int, int]:  # noqa: ANN001
        """Bin and offset of one document."""
        source, cluster = self._bit(self.sources, source), self._bit(self.clusters, cluster)
        for i in range(bisect_left(self.free, (length, -1)), len(self.free)):
            room, number = self.free[i]
            sources, clusters = self.held[number]
            if not (sources & source or clusters & cluster):
                del self.free[i]
                break
        else:
            room, number, sources, clusters = self.capacity, self.next, 0, 0
            self.next += 1
        insort(self.free, (room - length, number))
        self.held[number] = (sources | source, clusters | cluster)
        return number, self.capacity - room

    def place_all(self, length: int, source, cluster) -> Iterator[tuple[int, int, int, int]]:  # noqa: ANN001
        """``piece, bin, start, length`` of a document of any length."""
        piece = 0
        while length > self.capacity:
            yield piece, self.next, 0, self.capacity
            self.next, length, piece = self.next + 1, length - self.capacity, piece + 1
        yield piece, *self.place(length, source, cluster), length


def deal(items: DataFrame, shard: int = SHARD) -> DataFrame:
    """``items`` with ``shard``: by hash, and by ``row`` as well where the hash alone deals too many.

    Rows of an ordinary shard keep it whatever their numbers; the number only tells repeated rows apart.
    """
    shards = max(1, -(-items.count() // shard))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)).cast("long"))
    counts = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    parts = keep(counts.where(F.col("n") > 2 * shard).select("shard", F.ceil(F.col("n") / shard).alias("parts")), "parts")
    part = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0))
    return dealt.join(parts, "shard", "left").withColumn("shard", F.col("shard") + part * F.lit(shards)).drop("parts")


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``doc_id, piece, bin, start, length`` for ``items`` (``doc_id, source, cluster, length, row``), a written table."""
    dealt = deal(items, shard)
    names = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("bin", pa.int64()), ("start", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bins = None, None
        for batch in batches:
            out = []
            for number, doc, source, cluster, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != current:
                    current, bins = number, Bins(capacity)
                for piece, at, start, size in bins.place_all(length, source, cluster):
                    out.append((doc, piece, (number << 32) + at, start, size))
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, names, strict=True)], schema=names)

    dealt = dealt.repartition("shard").sortWithinPartitions("shard", F.desc("length"), "doc_id", "source", "cluster")
    return dealt.select("shard", "doc_id", "source", "cluster", "length").mapInArrow(run, RESULT)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Packs words; documents of one cluster have the same text."""
    text = text_of(F.col("text"))
    items = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("cluster"), F.size(words_of(text)).alias("length"),
        F.monotonically_increasing_id().alias("row"),
    )
    return pack(keep(items, "lengths"), capacity, shard)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
