"""Phrase collocations by dynamic itemset counting.

The documents are dealt to ``SHARDS`` shards, which are scanned in turn, again and
again. Words are counted from the first scan on. A longer phrase becomes active
once both its subphrases (all words but the last, all but the first) have reached
the threshold in what has been counted so far; it is counted from the next scan
on, until it has seen every shard once. So phrases of all lengths are counted in
the same scans, and scanning ends a full cycle after the last subphrase arrived.

A scan counts inside the tasks, on integers that number the words of the task's
own text, and sends each phrase once with its count. Which phrases are active is
told to the tasks by two bitmaps of fixed size (``FILTER_BITS``): reached, and
reached during the last cycle. A bitmap lets some others pass as well, so every
phrase that is new to the counts is first held against the subphrases themselves;
the counts are exact.

Most pairs of frequent words are rare themselves. One scan in advance adds up the
pairs by hash in ``PAIR_COUNTERS`` counters; an active pair whose counter stays below
the threshold can't reach it and isn't sent. Where there are far more pairs than
counters this prunes less, and changes no result.

Defined cases: a NULL text has no words; a NULL language is ``und``; repeated rows
count one by one; phrases with equal scores and counts are ordered by their UTF-8
bytes; an empty table gives an empty result; columns of other names are not read.
A text of any length is cut only between pieces, which no phrase spans.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendscape.llm.common import table, text_of
from lendscape.session import keep, new_path

# Fixed values
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
ABSORB_PCT = 80
REPORT = 2000

SHARDS = 3
FILTER_BITS = 1 << 25  # 4 MB each, whatever the input; raise it where phrases are counted in billions
PAIR_COUNTERS = 1 << 25  # a byte each in every task of the scan in advance
COUNTERS = 1 << 12  # in a row
TASKS_PER_CORE = 4  # of the scan in advance, whose tasks all send their counters
CHUNK = 16 << 20  # bytes of text that a task counts at a time
BUCKET = 1 << 15  # bits that bitmap_construct_agg() holds in a row
SLICES = 64  # of a language, before its best phrases meet in one task

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
NORMAL = bytes.maketrans(UPPER + ENDS + b"\t", LOWER + b"." * len(ENDS) + b" ")
PRIME, FACTOR = (1 << 31) - 1, 1_103_515_245
WEIGHTS = np.cumprod(np.full(1 << 10, 0x9E3779B97F4A7C15, np.uint64))  # of a word's bytes; longer words take them again

COUNTS = "lang string, phrase string, n int, h long, c long"
REACHED = "lang string, phrase string, n int, h long, since int"


def chunks(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of a normal text of about ``size`` bytes, cut where pieces end."""
    start = 0
    while len(text) - start > size:
        end = text.find(b".", start + size)
        if end < 0:
            break
        yield text[start : end + 1]
        start = end + 1
    yield text[start:]


def _bits(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def split_words(text: bytes) -> pa.Array:
    """Words and ends of pieces in normal text, in text order: all that stands between blanks."""
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == ord(" "))
    lengths = np.diff(gaps, prepend=-1, append=len(text)) - 1
    lengths = lengths[lengths > 0]
    kind, width = (pa.string(), np.int32) if len(text) < 1 << 31 else (pa.large_string(), np.int64)
    offsets = np.zeros(len(lengths) + 1, width)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(text.replace(b" ", b""))])


def hash_words(words: pa.Array, seed: int) -> np.ndarray:
    """Numbers below ``PRIME`` for words that are not empty, from all their bytes."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, ends, data = words.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(ends, np.int64, len(words) + 1)
    data = np.frombuffer(data, np.uint8, offsets[-1])
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    sums = np.add.reduceat((data + np.uint64(1)) * WEIGHTS[place % len(WEIGHTS)], offsets[:-1])
    mixed = (sums ^ (WEIGHTS[1:2] * np.uint64(seed))) * WEIGHTS[2]
    return (mixed >> np.uint64(33)).astype(np.int64) % PRIME


def encode(text: bytes, seed: int):
    """Distinct words of normal text, their hashes, which of them are words, and their numbers in text order."""
    tokens = split_words(text).dictionary_encode()
    words = tokens.dictionary.cast(pa.large_string())
    ids = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    is_word = pc.not_equal(words, ".").to_numpy(zero_copy_only=False)
    return words, hash_words(words, seed), is_word, ids


def count_phrases(
    text: bytes, seed: int, lengths: list[int], reached: np.ndarray, recent: np.ndarray, pairs: np.ndarray
) -> Iterator[tuple]:
    """``n, phrases, hashes, counts`` per length for normal text; 0 is the number of all words."""
    words, hashes, is_word, ids = encode(text, seed)
    k = len(words)
    if not k:
        return
    if 1 in lengths:
        counts = np.bincount(ids, minlength=k)
        some = np.flatnonzero(is_word)
        if len(some):
            yield 0, pa.array([""], pa.large_string()), np.zeros(1, np.int64), counts[some].sum(keepdims=True)
            yield 1, words.take(pa.array(some)), hashes[some], counts[some]
    # Arrays by position: the hash of the phrase of n words that starts there, and what is known of it.
    h, old, new = hashes[ids], (_bits(reached, hashes) & is_word)[ids], _bits(recent, hashes)[ids]
    code = ids
    for n in range(2, max(lengths) + 1):
        if len(ids) < n:
            return
        ok = old[:-1] & old[1:]
        active = ok & (new[:-1] | new[1:]) if n in lengths else np.zeros(len(ok), bool)
        at = np.flatnonzero(ok)
        last = ids[at + n - 1]
        grown, codes = np.zeros(len(ok), np.int64), np.zeros(len(ok), np.int64)
        grown[at] = (h[at] * FACTOR + hashes[last]) % PRIME
        before = code[at]
        if k**n >= 1 << 62:  # number the distinct first words anew, so that the product fits
            before = np.unique(before, return_inverse=True)[1]
        codes[at] = before * k + last
        h, code = grown, codes
        wanted = np.flatnonzero(active & _bits(pairs, h) if n == 2 else active)
        if len(wanted):
            _, first, counts = np.unique(code[wanted], return_index=True, return_counts=True)
            first = wanted[first]
            parts = [words.take(pa.array(ids[first + i])) for i in range(n)]
            yield n, pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), h[first], counts
        old, new = np.zeros(len(ok), bool), np.zeros(len(ok), bool)
        old[at], new[at] = _bits(reached, h[at]), _bits(recent, h[at])


def normal_parts(batches: Iterable[pa.RecordBatch], chunk: int) -> Iterator[tuple[str, int, bytes]]:
    """``language, seed of its hashes, normal text`` in parts of about ``chunk`` bytes."""
    texts: dict[str, list[bytes]] = {}
    held = 0

    def parts() -> Iterator[tuple[str, int, bytes]]:
        for lang, own in texts.items():
            normal = b".".join(own).translate(NORMAL).replace(b".", b" . ")
            seed = zlib.crc32(lang.encode("utf-8", "surrogatepass") + b"\0")
            for part in chunks(normal, 2 * chunk):
                yield lang, seed, part

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            texts.setdefault(lang, []).append(text)
            held += len(text)
            if held >= chunk:
                yield from parts()
                texts, held = {}, 0
    yield from parts()


def _counter(lengths: list[int], filters, chunk: int):
    names = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int32()), ("h", pa.int64()), ("c", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, seed, part in normal_parts(batches, chunk):
            for n, phrases, hashes, counts in count_phrases(part, seed, lengths, *filters.value):
                rows = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang), rows), phrases.cast(pa.string()), pa.repeat(pa.scalar(n, pa.int32()), rows),
                     pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())], schema=names,
                )

    return count


def frequent_pairs(dealt: DataFrame, least: int, chunk: int) -> np.ndarray:
    """Bitmap of the counters of pairs of words that reach ``least``: no pair below it is as frequent."""
    most = min(least, 255)
    fields = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def rows(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = list(blocks)
        for low in range(0, len(keys), 1024):
            part = keys[low : low + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([blocks[b].tobytes() for b in part], pa.binary())], schema=fields)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIR_COUNTERS, np.uint8)
        for _, seed, part in normal_parts(batches, chunk):
            _, hashes, is_word, ids = encode(part, seed)
            if len(ids) < 2:
                continue
            ok, h = is_word[ids], hashes[ids]
            ok = ok[:-1] & ok[1:]
            at, counts = np.unique((h[:-1][ok] * FACTOR + h[1:][ok]) % PRIME & (PAIR_COUNTERS - 1), return_counts=True)
            total[at] = np.minimum(total[at] + counts, most)
        blocks = total.reshape(-1, COUNTERS)
        yield from rows({int(b): blocks[b] for b in np.flatnonzero(blocks.any(axis=1))})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, done = None, np.zeros(COUNTERS, np.int64), {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != last and last is not None:
                    done[last] = np.packbits(total >= most, bitorder="little")
                    total = np.zeros(COUNTERS, np.int64)
                last = block
                total += np.frombuffer(counts, np.uint8)
        if last is not None:
            done[last] = np.packbits(total >= most, bitorder="little")
        yield from rows(done)

    tasks = TASKS_PER_CORE * dealt.sparkSession.sparkContext.defaultParallelism
    counted = dealt.select("lang", F.col("text").cast("binary").alias("text")).coalesce(tasks).mapInArrow(count, "block int, counts binary")
    summed = counted.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, counts binary")
    found = np.zeros(PAIR_COUNTERS // 8, np.uint8)
    for block, bits in summed.collect():  # a bit for each counter
        found[block * (COUNTERS // 8) : (block + 1) * (COUNTERS // 8)] = np.frombuffer(bits, np.uint8)
    return found


def _bitmap(reached: DataFrame) -> tuple[np.ndarray, set[int]]:
    """Bits of the hashes of ``reached``, a few megabytes whatever the number of rows; and the lengths found."""
    bit = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = reached.select("n", bit.alias("bit")).groupBy("n", F.shiftright("bit", 15).alias("bucket"))
    found, lengths = np.zeros(FILTER_BITS // 8, np.uint8), set()
    for n, bucket, bits in rows.agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(BUCKET - 1)))).collect():
        found[bucket * (BUCKET // 8) : (bucket + 1) * (BUCKET // 8)] |= np.frombuffer(bits, np.uint8)
        lengths.add(n)
    return found, lengths


def _first_words(phrase: str = "phrase") -> Column:
    return F.expr(f"substr({phrase}, 1, length({phrase}) - locate(' ', reverse({phrase})))")


def _last_words(phrase: str = "phrase") -> Column:
    return F.expr(f"substr({phrase}, locate(' ', {phrase}) + 1)")


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, chunk: int = CHUNK
) -> DataFrame:
    """``lang, phrase, n, f`` of every phrase of 1 to ``longest`` words that occurs ``least`` times in its
    language; rows with ``n`` 0 hold the number of all words of a language."""
    spark = docs.sparkSession
    folder = new_path(spark, "collocations")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(F.col(text)).alias("text"))
    rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).write.partitionBy("shard").parquet(f"{folder}/shards")
    dealt = spark.read.schema("lang string, text string, shard int").parquet(f"{folder}/shards")
    pairs = frequent_pairs(dealt, least, chunk)
    reached = state = None
    nothing = np.zeros(FILTER_BITS // 8, np.uint8)
    arrived: dict[int, np.ndarray] = {}  # bitmap of the phrases that reached the threshold in each scan of the last cycle
    grow: dict[int, set[int]] = {}  # and their lengths
    old, step, last = nothing.copy(), 0, shards - 1
    while step <= last:
        recent = [s for s in arrived if s >= step - shards]
        lengths = sorted({n + 1 for s in recent for n in grow[s]} | ({1} if step < shards else set()))
        new = np.bitwise_or.reduce([nothing, *(arrived[s] for s in recent)])
        arrived = {s: arrived[s] for s in recent}
        filters = spark.sparkContext.broadcast((old, new, pairs))
        shard = dealt.where(F.col("shard") == step % shards).select("lang", F.col("text").cast("binary").alias("text"))
        counted = shard.mapInArrow(_counter(lengths, filters, chunk), COUNTS) if lengths else spark.createDataFrame([], COUNTS)
        rows = counted.selectExpr("lang", "phrase", "n", "h", "cast(NULL AS int) AS act", "cast(NULL AS int) AS since", "0L AS old", "c AS new")
        if state is not None:
            rows = rows.unionByName(state.selectExpr("lang", "phrase", "n", "h", "act", "since", "c AS old", "0L AS new"))
        both = rows.groupBy("lang", "phrase").agg(*(F.max(c).alias(c) for c in ("n", "h", "act", "since")), *(F.sum(c).alias(c) for c in ("old", "new")))
        both = keep(both.withColumn("act", F.when(F.col("n") <= 1, 0).otherwise(F.col("act"))), "counted")
        if reached is not None:
            verified = keep(_verified(both.where("act IS NULL"), reached), "verified")
            both = both.where("act IS NOT NULL").unionByName(verified)
        both = both.where((F.col("act") <= step) & (F.col("act") > step - shards)).withColumn("c", F.col("old") + F.col("new"))
        both = both.withColumn("since", F.coalesce("since", F.when(F.col("c") >= least, F.lit(step)))).drop("old", "new")
        ends = F.col("act") == step - shards + 1
        complete = both.where(ends & ((F.col("c") >= least) | (F.col("n") == 0)))
        complete.select("lang", "phrase", "n", F.col("c").alias("f")).write.parquet(f"{folder}/found/step={step}")
        state = both.where(~ends)
        newly = both.where((F.col("since") == step) & F.col("n").between(1, longest - 1))
        newly.select("lang", "phrase", "n", "h").write.parquet(f"{folder}/reached/since={step}")
        reached = spark.read.schema(REACHED).parquet(f"{folder}/reached")
        now, lengths = _bitmap(reached.where(F.col("since") == step))
        if lengths:
            arrived[step], grow[step] = now, lengths
            old = old | now
            last = max(last, step + shards)
        filters.destroy()
        step += 1
    return spark.read.schema("lang string, phrase string, n int, f long, step int").parquet(f"{folder}/found").drop("step")


def _verified(rows: DataFrame, reached: DataFrame) -> DataFrame:
    """Phrases that are new to the counts, where both subphrases have really reached the threshold."""
    known = reached.select("lang", "phrase", F.col("since").alias("seen"))
    first = known.select(F.col("lang").alias("l1"), F.col("phrase").alias("p1"), F.col("seen").alias("s1"))
    second = known.select(F.col("lang").alias("l2"), F.col("phrase").alias("p2"), F.col("seen").alias("s2"))
    df = rows.withColumns({"a": _first_words(), "b": _last_words()})
    df = df.join(first, (df["lang"] == F.col("l1")) & (df["a"] == F.col("p1")))
    df = df.join(second, (df["lang"] == F.col("l2")) & (df["b"] == F.col("p2")))
    return df.withColumn("act", F.greatest("s1", "s2") + 1).select(*rows.columns)


def scored(found: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of phrases of two and more words, at their lowest-scoring cut."""
    cuts = found.where("n >= 2").select(
        "lang", "phrase", F.col("f").alias("a"), F.posexplode(F.sequence(F.lit(1), F.col("n") - 1)).alias("_", "k"), F.split("phrase", " ").alias("w")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    left = found.where("n >= 1").select(F.col("lang").alias("l1"), F.col("phrase").alias("p1"), F.col("f").alias("l"))
    right = found.where("n >= 1").select(F.col("lang").alias("l2"), F.col("phrase").alias("p2"), F.col("f").alias("r"))
    df = cuts.join(left, (cuts["lang"] == left["l1"]) & (cuts["first"] == left["p1"]))
    df = df.join(right, (df["lang"] == right["l2"]) & (df["rest"] == right["p2"]))
    score = F.expr(f"cast((cast(a AS decimal(20, 0)) * {SCALE}) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0))) AS bigint)")
    df = df.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    return df.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )


def absorbed(found: DataFrame, pct: int = ABSORB_PCT) -> DataFrame:
    """``lang, phrase`` of what lies inside a longer phrase that occurs nearly as often."""
    longer = found.where("n >= 3").select("lang", "n", F.col("f").alias("longer"), F.split("phrase", " ").alias("w"))
    inner = F.expr(
        "flatten(transform(sequence(2, n - 1), k -> transform(sequence(1, n - k + 1), i -> array_join(slice(w, i, k), ' '))))"
    )
    most = longer.select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    both = most.join(found.where("n >= 2").select("lang", "phrase", "f"), ["lang", "phrase"])
    exact = F.expr(f"cast(longer AS decimal(20, 0)) * 100 >= cast(f AS decimal(20, 0)) * {pct}")
    return both.where(exact).select("lang", "phrase")


def collocations(found: DataFrame, report: int = REPORT) -> DataFrame:
    """The best phrases of every language, from the counts of ``frequent_phrases``."""
    df = scored(found).join(absorbed(found), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language may hold nearly all phrases: the best of each slice are enough
    part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*order)
    df = df.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= report).drop("rank")
    df = df.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= report)
    totals = found.where("n = 0").select(F.col("lang").alias("own"), F.col("f").alias("n"))
    df = df.join(totals, df["lang"] == totals["own"])
    return df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(frequent_phrases(table(spark, sf_dir, "documents").select("lang", "text")))
