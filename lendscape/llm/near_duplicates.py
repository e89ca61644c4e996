"""Near-duplicate detection with SetSketch registers.

A register is the smallest hash of a set's members under one hash function, as
an exponential variate on an exponentially spaced scale, truncated: it merges by
maximum and two sets agree in a register with a probability close to their
Jaccard similarity. Values of several registers together make a band; documents
that share a band are candidates. Their similarity is estimated by likelihood
from how many registers agree, are greater and are smaller, jointly with the
known set sizes, and candidates that are not far below the limit are verified
on their full shingle sets.

No large group is expanded into pairs. Each bucket compares its members with one
of them, members found alike form components, and only buckets that still hold
several components go on, first with other members in the middle. Of what is left,
buckets of a few members, where unlike texts met by chance, are compared pair by
pair; large ones are joined once more with the whole test as the join's condition,
so that no candidate stays untested and only links come out.

Defined cases: a NULL or blank text has no shingles and links with nothing;
texts with the same words are one class; rows that repeat an id are judged by
their own text; rows without an id take the component of their class, NULL where
no row of the class has an id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscape.llm.common import fresh, table, text_of
from lendscape.llm.graph import components
from lendscape.session import keep

# Parameters. A pair at the limit of 0.8 shares no band with probability (1 - 0.8**5)**40 = 1.2e-7.
BANDS, ROWS = 40, 5
BASE, RATE, TOP = 1.001, 20.0, 65534
LIMIT_PCT = 80
SLACK = 6  # standard errors of the estimate
HUB_ROUNDS = 2
FEW = 32  # members of a bucket that is expanded into pairs
SEED = 7
BLOCK = 512


# Functions travel to workers by value, where a cache object would look for this package.
def _tables(_known: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if not _known:
        rng = np.random.default_rng(SEED)
        byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        byte[[32, 9, 10, 11, 12, 13]] = 0
        _known[0] = byte, rng.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _known[0]


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-known 64-bit finalizer (fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FACTOR = 0x9E3779B97F4A7C15


def _powers(n: int, _known: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the factor and of its inverse; ``n`` is a power of two."""
    if n not in _known:
        up, down = np.full(n, FACTOR, np.uint64), np.full(n, pow(FACTOR, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _known[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _known[n]


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, A-Z lowered; words are separated by ASCII white space."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    start = ~space
    start[1:] &= space[:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(10, int(len(raw)).bit_length()))
    sums = np.add.reduceat(_tables()[0][raw] * up[: len(raw)], starts)
    return _mix(sums * down[starts])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; of the whole sequence where it is shorter."""
    width = min(width, len(words))
    if not width:
        return words
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * np.uint64(FACTOR) + words[i : i + len(total)]
    return np.unique(_mix(total + np.uint64(width)))


def sketch(members: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; all zero for an empty one."""
    factor = _tables()[1]
    low = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    if not len(members):
        return np.zeros(len(factor), np.uint16)
    for i in range(0, len(members), BLOCK):
        np.minimum(low, (members[i : i + BLOCK] * factor).min(axis=1), out=low)
    value = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def estimate(na: np.ndarray, a: np.ndarray, nb: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of greatest likelihood, given the set sizes; one row per pair.

    On a finely spaced scale a register agrees with probability J, is greater in
    the first set with u - vJ and in the second with v - uJ, where u and v are the
    sets' shares of the summed sizes. The root of the derivative is closed.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    m = a.shape[1]
    same = m - more - less
    u = na / (na + nb)
    v = 1 - u
    p, q, r = u * v * m, same * (u * u + v * v) + v * v * more + u * u * less, same * u * v
    root = (q - np.sqrt(np.maximum(q * q - 4 * p * r, 0))) / (2 * p)
    return np.clip(root, 0, np.minimum(u / v, v / u))


def sketch_documents(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, digest, n, registers`` per row of ``docs`` (``doc_id, text``); the digest stands for the words."""
    names = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("registers", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, registers = [], [], []
            for text in batch.column(1).to_pylist():
                words = word_hashes(text)
                members = shingles(words, width)
                digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                sizes.append(len(members))
                registers.append(sketch(members).tobytes() if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(registers, pa.binary())], schema=names
            )

    return docs.mapInArrow(run, "doc_id long, digest binary, n long, registers binary")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, digest, members`` per row: the full shingle sets as hashes."""
    names = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                words = [word_hashes(t) for t in part.column(1).to_pylist()]
                digests = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
                members = [shingles(w, width).view(np.int64) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests, pa.binary()), pa.array(members, pa.list_(pa.int64()))], schema=names
                )

    return docs.mapInArrow(run, "doc_id long, digest binary, members array<long>")


def band_keys(registers: Column) -> Column:
    wide = 2 * ROWS
    return F.array(*(F.xxhash64(F.lit(i), F.substring(registers, i * wide + 1, wide)) for i in range(BANDS)))


@F.pandas_udf(T.DoubleType())
def _likely(na: pd.Series, a: pd.Series, nb: pd.Series, b: pd.Series) -> pd.Series:
    if not len(na):
        return pd.Series([], dtype=float)
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (a, b))
    return pd.Series(estimate(na.to_numpy(float), x, nb.to_numpy(float), y))


def _plausible(pairs: DataFrame, sketches: DataFrame, limit: float) -> DataFrame:
    """Pairs whose estimate is not far below the limit."""
    a = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    b = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    least = limit - SLACK * math.sqrt(limit * (1 - limit) / (BANDS * ROWS))
    # Sets whose sizes differ too much can't be alike.
    sized = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").where(F.least("na", "nb") >= (limit - 1e-9) * F.greatest("na", "nb"))
    return sized.where(_likely("na", "ra", "nb", "rb") >= least).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, limit_pct: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").withColumn("common", F.size(F.array_intersect("ma", "mb")).cast("long"))
    union = F.size("ma") + F.size("mb") - F.col("common")
    return both.where(100 * F.col("common") >= limit_pct * union).select("a", "b")


def _hub_pairs(members: DataFrame, chosen: Column) -> DataFrame:
    """Every member of a bucket with the bucket's chosen member of another component."""
    hubs = members.groupBy("key").agg(chosen.alias("hub"))
    hubs = hubs.select("key", F.col("hub.node").alias("hub"), F.col("hub.component").alias("hub_component"))
    met = members.join(hubs, "key").where(F.col("component") != F.col("hub_component"))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _few_pairs(few: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """All pairs of different components inside buckets of at most ``FEW`` members, but for those tested.

    Chance makes most of these buckets. In large corpora they tie nearly all texts
    together, so pairs are sought by bucket, never by what hangs together.
    """
    member = F.struct("node", "component")
    held = few.groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("all"))
    one = held.select("all", F.posexplode("all").alias("at", "a"))
    both = one.select("a", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("b")).where("a.component <> b.component")
    pairs = both.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    for done in tested:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    return pairs


def _rest_links(left: DataFrame, sets: DataFrame, limit_pct: int) -> DataFrame:
    """Links between different components of the buckets ``left``, each node sent once.

    Buckets that share members form a group; within it, pairs that share a
    bucket are held against the limit inside the join. Sets travel as their
    difference from the set of the group's first node, which is short where all
    are nearly alike: |x ^ y| = |dx| + |dy| - 2 |dx & dy|.
    """
    low = left.groupBy("key").agg(F.min("node").alias("b"))
    groups = components(left.join(low, "key").select(F.col("node").alias("a"), "b")).withColumnRenamed("component", "group")
    nodes = left.groupBy("node").agg(F.collect_set("key").alias("keys"), F.first("component").alias("component"))
    centre = sets.select(F.col("node").alias("group"), F.col("members").alias("centre"))
    full = nodes.join(groups, "node").join(sets, "node").join(centre, "group")
    apart = F.concat(F.array_except("members", "centre"), F.array_except("centre", "members"))
    full = keep(full.select("group", "node", "component", "keys", F.size("members").alias("n"), apart.alias("apart")), "rest")
    a, b = (full.select(*(F.col(c).alias(f"{c}_{x}") for c in full.columns)) for x in "ab")
    most = (100 - limit_pct) * (F.col("n_a") + F.col("n_b"))  # of the symmetric difference, times 100 + limit
    da, db = F.size("apart_a"), F.size("apart_b")
    linked = (
        (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & ((100 + limit_pct) * F.abs(da - db) <= most)
        & F.arrays_overlap("keys_a", "keys_b")
        & ((100 + limit_pct) * (da + db - 2 * F.size(F.array_intersect("apart_a", "apart_b"))) <= most)
    )
    met = a.join(b, (F.col("group_a") == F.col("group_b")) & linked)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, limit_pct: int = LIMIT_PCT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(F.col(text)).alias("text"))
    rows = keep(sketch_documents(own, width), "sketches")
    # The class's row with the smallest id stands for all rows with the same words. Classes are
    # numbered, because an id that repeats with other words may be the smallest of several.
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "n", "registers")).alias("x")
    nodes = rows.where("n > 0").groupBy("digest").agg(first).where("x.doc_id is not null")
    numbered = nodes.withColumn("node", F.monotonically_increasing_id())
    nodes = keep(numbered.select("node", F.col("x.doc_id").alias("smallest"), "digest", F.col("x.n").alias("n"), F.col("x.registers").alias("registers")), "classes")
    spread = nodes.select("node", F.explode(band_keys(F.col("registers"))).alias("key"))
    buckets = spread.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = keep(spread.join(buckets.select("key").hint("merge"), "key").withColumn("component", F.col("node")), "members")
    involved = keep(members.select("node").distinct(), "involved")
    # How many are involved has no bound: these joins never broadcast.
    part = keep(nodes.join(involved.hint("merge"), "node"), "involved-sketches")
    ids = part.select(F.col("smallest").alias("doc_id"), "digest", "node")
    texts = own.join(ids.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    sets = shingle_sets(texts, width).join(ids, ["doc_id", "digest"])
    sets = keep(sets.dropDuplicates(["node"]).select("node", "members"), "sets")

    limit, tested, links, labels = limit_pct / 100, [], None, None
    left = members
    for turn in range(HUB_ROUNDS + 1):
        if turn < HUB_ROUNDS:
            order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "component") if turn else F.struct("node", "component")
            pairs = _hub_pairs(left, F.min(order))
            for done in tested:
                pairs = pairs.join(done, ["a", "b"], "left_anti")
            tested.append(keep(pairs, "candidates"))
            found = _verified(keep(_plausible(tested[-1], part, limit), "plausible"), sets, limit_pct)
        else:
            # How many buckets are large has no bound: these joins never broadcast.
            large = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).select("key")
            large = keep(large, "large")
            few = keep(_few_pairs(left.join(large.hint("merge"), "key", "left_anti"), tested), "few")
            found = _verified(keep(_plausible(few, part, limit), "plausible"), sets, limit_pct)
            found = found.union(_rest_links(left.join(large.hint("merge"), "key", "left_semi"), sets, limit_pct)).distinct()
        found = keep(found, "links")
        links = found if links is None else links.union(found)
        labels = keep(components(links), "labels")
        if turn == HUB_ROUNDS:
            break
        named = left.drop("component").join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
        left = keep(named.join(mixed, "key"), "mixed")
        if left.isEmpty():
            break

    names = nodes.select("digest", "node", "smallest").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = names.groupBy("component").agg(F.min("smallest").alias("component_id"))
    names = names.join(least.hint("merge"), "component").select("digest", "component_id")
    joined = rows.select("doc_id", "digest", "n").join(names.hint("merge"), "digest", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, limit_pct: int = LIMIT_PCT) -> DataFrame:
    """One row of each group, with its own columns: that of the smallest id, and of its rows the first.

    Rows are told apart by a number, so ids may repeat or be missing; a row with
    an id goes before one without. Rows without words belong to no group and stay.
    """
    row, name, size, component = fresh(docs, "_row", "_gone", "_size", "_component")
    # Written, because numbers given twice could differ.
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    verdict = near_duplicates(numbered, width, limit_pct, doc_id=row).where(F.col("n_shingles") > 0)
    verdict = keep(verdict.select(F.col("doc_id").alias(name), F.col("component_id").alias(component)), "verdict")
    groups = verdict.groupBy(component).agg(F.count(F.lit(1)).alias(size)).where(F.col(size) > 1).select(component)
    # How many rows have a copy has no bound: these joins never broadcast.
    grouped = verdict.join(groups.hint("merge"), component)
    ids = numbered.select(F.col("doc_id").alias("_id"), F.col(row).alias("_number"))
    grouped = keep(grouped.join(ids.hint("merge"), F.col(name) == F.col("_number")).select(name, component, "_id"), "grouped")
    place = F.struct(F.isnull("_id").alias("no_id"), F.col("_id").alias("id"), F.col(name).alias("row"))
    best = grouped.groupBy(component).agg(F.min(place)["row"].alias("_best"))
    gone = keep(grouped.select(name).join(best.select("_best").hint("merge"), F.col(name) == F.col("_best"), "left_anti"), "dropped")
    return numbered.join(gone.hint("shuffle_hash"), F.col(row) == F.col(name), "left_anti").select(*docs.columns)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS g
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(words), 2))) AS i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION SELECT r.a, CASE WHEN e.a = r.b THEN e.b ELSE e.a END FROM r JOIN e ON r.b IN (e.a, e.b)),
k AS (SELECT a AS doc_id, min(b) AS component FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(k.component, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
