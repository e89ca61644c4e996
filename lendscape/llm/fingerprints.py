"""Order MinHash fingerprints of documents.

A text's k-mers are numbered by occurrence. Each of ``m`` hash functions picks
the ``l`` smallest numbered k-mers; they are put back in text order and hashed as
a tuple. Two fingerprints agree in a place where both the chosen k-mers and
their order agree, so that the share of agreeing places follows edit distance.

Texts meet their neighbours by one shuffle: blocks of consecutive ids from
approximate quantiles, the first document of every block copied to the block
before it.

Defined cases: a NULL text is empty; an empty text has the fingerprint ``""``,
alike (1) only to another empty one; a text shorter than a k-mer is one k-mer;
rows with equal ids follow each other by text, rows without an id come last; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import partitions, table, text_of

K, PLACES, PICKED, SEED = 8, 64, 2, 20240101
BLOCK = 2048
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-known 64-bit finalizer (fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(text: str, k: int = K) -> np.ndarray:
    """Hashes of all runs of ``k`` code points; of the whole text where it is shorter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    k = min(k, len(points))
    if not k:
        return points
    n = len(points) - k + 1
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + points[i : i + n]
    return _mix(total + np.uint64(k))


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How many equal hashes stand before each."""
    n = len(hashes)
    if n < 1 << 24:  # hash and position fit one word: sorting values is faster than sorting indices
        packed = np.sort((hashes & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64))
        order, value = (packed & np.uint64((1 << 24) - 1)).astype(np.int64), packed >> np.uint64(24)
    else:
        order = np.argsort(hashes, kind="stable")
        value = hashes[order]
    starts = np.ones(n, bool)
    starts[1:] = value[1:] != value[:-1]
    count = np.zeros(n, np.uint64)
    if not starts.all():
        place = np.arange(n)
        count[order] = (place - np.maximum.accumulate(np.where(starts, place, 0))).astype(np.uint64)
    return count


def _parameters(places: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 32, (2, places, 1), dtype=np.uint32)
    return draw[0], draw[1] | np.uint32(1)


def fingerprint(text: str, k: int = K, places: int = PLACES, picked: int = PICKED, seed: int = SEED, _known: dict = {}) -> np.ndarray:  # noqa: B006
    """``places`` 16-bit values; none for an empty text."""
    grams = kmers(text, k)
    n = len(grams)
    if not n:
        return np.zeros(0, np.uint16)
    if (places, seed) not in _known:
        _known[places, seed] = _parameters(places, seed)
    salt, factor = _known[places, seed]
    keys = (_mix(grams + occurrences(grams) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(places)
    top = np.uint32(0xFFFFFFFF)
    values, spots = [], []
    for low in range(0, n, BLOCK):
        ranked = keys[low : low + BLOCK] ^ salt
        ranked *= factor
        for _ in range(min(picked, ranked.shape[1])):
            spot = ranked.argmin(axis=1)
            values.append(ranked[rows, spot])
            spots.append(spot + low)
            ranked[rows, spot] = top
    value, spot = np.stack(values), np.stack(spots)
    if n > BLOCK:
        order = np.argsort(value, axis=0, kind="stable")[:picked]
        spot = np.take_along_axis(spot, order, axis=0)
    spot = np.sort(spot, axis=0)
    tuples = np.zeros(places, np.uint64)
    for row in spot:
        tuples = _mix(tuples * np.uint64(0x9E3779B97F4A7C15) + grams[row])
    return (tuples >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing places."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float(np.count_nonzero(a == b) / len(a))


def as_text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _blocks(ids: DataFrame, column: str, blocks: int) -> list[float]:
    """Cuts between blocks of consecutive ids; as many numbers as blocks at most."""
    wanted = [i / blocks for i in range(1, blocks)]
    cuts = ids.agg(F.percentile_approx(column, wanted or [0.5])).first()[0] or []
    # Bucketizer compares as doubles; any monotone cut keeps neighbours together.
    return [-float("inf"), *(sorted({float(c) for c in cuts}) or [0.0]), float("inf")]


def fingerprint_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, with the next document by descending id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(F.col(text)).alias("text"))
    count = partitions(spark)
    ids = rows.select("doc_id", F.col("doc_id").cast("double").alias("number"))
    splits = _blocks(ids, "doc_id", count)
    cut = Bucketizer(splits=splits, inputCol="number", outputCol="cut", handleInvalid="keep")
    blocks = len(splits)  # one more than there are ranges: the last takes rows without an id
    block = (F.lit(blocks - 2) - F.col("cut")).cast("int")
    block = F.when(F.col("doc_id").isNull(), blocks - 1).otherwise(block)
    # The id that each block starts with: one row per block.
    heads = cut.transform(ids).groupBy(block.alias("block")).agg(F.max("doc_id").alias("head")).orderBy("block").collect()
    if not heads:
        return spark.createDataFrame([], RESULT)
    used = [h["block"] for h in heads]
    before = {used[i]: used[i - 1] for i in range(len(used))}
    placed = cut.transform(rows.withColumn("number", F.col("doc_id").cast("double"))).select("doc_id", "text", block.alias("block"))
    # Blocks that start with this id, each to be copied to the block before it.
    is_head = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for h in heads for x in (h["block"], h["head"]))), F.col("block")) == F.col("doc_id"), F.lit(False)) | (
        F.col("block") == blocks - 1
    )
    previous = F.element_at(F.create_map(*(F.lit(x) for a, b in before.items() for x in (a, b))), F.col("block"))
    copies = F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("copy")))
    copies = F.when(is_head, F.concat(copies, F.array(F.struct(previous.alias("block"), F.lit(True).alias("copy"))))).otherwise(copies)
    sent = placed.select("doc_id", "text", F.explode(copies).alias("to")).select("to.block", "to.copy", "doc_id", "text")
    return _stream(sent, blocks)


def _stream(sent: DataFrame, blocks: int) -> DataFrame:
    names = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next one is still to come
        for batch in batches:
            out = []
            for block, copy, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if copy and (held is None or held[0] != block):
                    continue  # further copies: the first one closed the block
                own = fingerprint(text)
                if held is not None and held[0] == block:
                    _, prior, before, marks = held
                    changed = edited(before, text)
                    changed_marks = fingerprint(changed)
                    out.append(
                        {"doc_id": prior, "n_chars": len(before), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                         "fingerprint": as_text(marks), "edited_fingerprint": as_text(changed_marks),
                         "near_edited": likeness(marks, changed_marks), "near_next": likeness(marks, own)}
                    )
                held = None if copy else (block, doc, text, own)
            yield pa.RecordBatch.from_pylist(out, schema=names)

    placed = sent.repartitionById(blocks, F.col("block"))
    ordered = placed.sortWithinPartitions("block", "copy", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.select("block", "copy", "doc_id", "text").mapInArrow(walk, RESULT)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))
