"""Spelling variants: words within one edit, found by search schemes over FM-indexes.

A word and its near word agree on one half of the word exactly, and the one
error lies in the other half. Words are therefore dealt by their exact half (one
row as a query, a few as something to find), and every block of dealt rows gets
an FM-index of its delimited vocabulary in both reading directions. A query
matches its exact part first, letter by letter, as an interval of suffix ranks,
then extends across the other part allowing one error (another letter, one more
or one less), and ends at the delimiter; a suffix that begins with a delimiter has
the rank of its word. With one error each search extends in one direction only:
right halves run on the forward index, left halves on the index of reversed words.

A half shared by more than ``LIMIT`` words is dealt again by halving the part that
holds the error, so that no group has to meet in one task; a part of one letter
ends this, and bounds the group by the square of the alphabet.

Defined cases: a NULL text has no words; a NULL id counts as an empty one where
ids choose what is deleted; repeated rows count one by one; a word with no near
word has ``n_near`` 0, no form, and is its own root; of near words with equal
counts the first in code-point order is the form; an empty table gives an empty
result; columns of other names are not read. Words hold no U+0000.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import table, text_of
from lendscape.session import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values
LETTERS = "a-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TYPO_EVERY = 199
FORM_FACTOR = 5

LIMIT = 20_000  # words that share a part, beyond which it is dealt again
BLOCK = 50_000  # words in an index, about
FOUND = "word string, n_near long, best_n long, best string"


def typed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """``word`` per run of letters of at least ``least``; a few runs, chosen by checksum, lose a letter first."""
    lower = F.translate(text_of(F.col(text)), UPPER, LOWER)
    # a run is a longest one, so runs that are too short already hold no match of this length
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    df = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    code = F.crc32(F.encode(F.concat(F.col("id"), F.lit(":"), F.col("run")), "utf-8"))
    df = df.select("run", code.alias("code"))
    place = F.expr("cast(code % length(run) as int)")
    cut = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    word = F.when(F.col("code") % TYPO_EVERY == 0, cut).otherwise(F.col("run"))
    return df.select(word.alias("word")).where(F.length("word") >= least)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words that occur often enough."""
    return typed_words(docs, doc_id, text).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# Routing. A row says: word, its count, how many letters at its start (a) and end (z)
# are exact, and for queries how many equal letters at the start mean that another
# row of the same query finds the word already (f).


def _parts(rows: DataFrame, queries: bool) -> DataFrame:
    """Rows dealt by either half of the part that may hold the error, ``m`` letters long in the query."""
    inner = F.length("word") - F.col("a") - F.col("z")
    if queries:
        sizes = F.array(inner)
    else:
        sizes = F.filter(F.array(inner - 1, inner, inner + 1), lambda m: m >= 2)
    rows = rows.withColumn("m", F.explode(sizes))
    half = F.floor(F.col("m") / 2).cast("int")
    rest = (F.col("m") - half).cast("int")

    def part(side: str, a: Column, z: Column, text: Column, f: Column) -> Column:
        return F.struct(
            F.concat_ws("\u0000", F.col("key"), F.concat(F.col("m").cast("string"), F.lit(side)), text).alias("key"),
            a.alias("a"), z.alias("z"), f.alias("f"),
        )

    left = part("<", F.col("a") + half, F.col("z"), F.expr("substr(word, a + 1, cast(floor(m / 2) as int))"), F.col("f"))
    right = part(
        ">", F.col("a"), F.col("z") + rest,
        F.expr("substr(word, length(word) - z - (m - cast(floor(m / 2) as int)) + 1, m - cast(floor(m / 2) as int))"), F.col("a") + half,
    )
    return rows.select("word", "n", F.explode(F.array(left, right)).alias("p")).select("p.key", "word", "n", "p.a", "p.z", "p.f")


def deal(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows ``key, word, n, a, z, f, query``: near words meet under one key, and no key holds many words."""
    whole = words.where(F.length("word") >= 2).select(
        F.lit("").alias("key"), "word", F.col("n").cast("long").alias("n"), F.lit(0).alias("a"), F.lit(0).alias("z"), F.lit(0).alias("f")
    )
    queries, targets, done = whole, whole, []
    while True:
        queries, targets = _parts(queries, True), _parts(targets, False)
        # what the end of recursion bounds is dealt no further
        sizes = targets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).select("key")
        large = keep(sizes, "large-parts")
        if large.isEmpty():
            break
        open_ = queries.where(F.length("word") - F.col("a") - F.col("z") >= 2)
        again = keep(open_.join(large, "key", "left_semi").select("key").distinct(), "dealt-again")
        if again.isEmpty():
            break
        for rows, query in ((queries, True), (targets, False)):
            done.append(rows.join(again, "key", "left_anti").withColumn("query", F.lit(query)))
        queries, targets = (keep(rows.join(again, "key", "left_semi"), "dealt") for rows in (queries, targets))
    rows = [*done, queries.withColumn("query", F.lit(True)), targets.withColumn("query", F.lit(False))]
    total = rows[0]
    for more in rows[1:]:
        total = total.unionByName(more)
    return total


def suffix_ranks(codes: np.ndarray, bits: int) -> np.ndarray:
    """Starts of all suffixes in sorted order, by doubling from as many letters as an integer holds."""
    n, step = len(codes), 62 // bits
    padded = np.concatenate([codes, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(step):
        key = (key << bits) | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        if rank[order[-1]] == n - 1:
            return order
        following = np.zeros(n, np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + following
        step *= 2


class FmIndex:
    """Sorted distinct words between delimiters, searched from their ends to their starts."""

    def __init__(self, words: list[str]):
        text = np.frombuffer(("\0" + "".join(w + "\0" for w in words)).encode("utf-32-le"), np.uint32)
        self.letters, codes = np.unique(text, return_inverse=True)
        codes = codes.astype(np.int64)
        self.size = len(codes)
        order = suffix_ranks(codes, max(1, int(len(self.letters) - 1).bit_length()))
        last = codes[order - 1]  # the letter before each suffix, in the order of suffixes
        by_letter = np.argsort(last, kind="stable")
        self.last = last
        self.steps = last[by_letter] * self.size + by_letter

    def codes(self, words: list[str], length: int) -> np.ndarray:
        """Codes of words of one length; -1 for letters that no indexed word has."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
        at = np.searchsorted(self.letters, text)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == text
        return np.where(known, at, -1)

    def extend(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes with one more letter in front; a letter of -1 empties them."""
        base = letter * self.size
        a, b = np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)
        return a, np.where(letter < 0, a, b)

    def before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of (interval, letter that stands before one of its suffixes), without delimiters."""
        n = len(self.letters)
        width = high - low
        wide = np.flatnonzero(width > n)
        some = np.flatnonzero(width <= n)
        lengths = width[some]
        starts = np.repeat(low[some] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        pairs = np.concatenate([np.repeat(some, lengths) * n + self.last[starts], np.repeat(wide, n) * n + np.tile(np.arange(n), len(wide))])
        pairs = np.unique(pairs[pairs % n != 0])
        return pairs // n, pairs % n

    def near(self, patterns: np.ndarray, exact: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, indexed word) with exactly one error, none in the last ``exact`` and first ``tail`` letters."""
        count, length = patterns.shape
        none = np.zeros(0, np.int64)
        who = np.arange(count)
        low, high = self.extend(np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, self.size))

        def go(state, letter):
            w, a, b = state
            a, b = self.extend(letter, a, b)
            some = a < b
            return w[some], a[some], b[some]

        def join(x, y):
            return tuple(np.concatenate(c) for c in zip(x, y, strict=True))

        clean, once = (who, low, high), (none, none, none)
        for j in range(length - 1, length - 1 - exact, -1):
            clean = go(clean, patterns[clean[0], j])
        for j in range(length - 1 - exact, tail - 1, -1):
            which, letter = self.before(clean[1], clean[2])
            one = tuple(c[which] for c in clean)
            grown = go(one, letter)  # one letter more: patterns[:, j] is still to come
            once = join(once, grown)
            once = go(once, patterns[once[0], j])
            other = letter != patterns[one[0], j]
            changed = go(tuple(c[other] for c in one), letter[other])
            once = join(join(once, changed), clean)  # another letter; one letter less
            clean = go(clean, patterns[clean[0], j])
        which, letter = self.before(clean[1], clean[2])
        once = join(once, go(tuple(c[which] for c in clean), letter))
        for j in range(tail - 1, -1, -1):
            once = go(once, patterns[once[0], j])
        who, low, high = go(once, np.zeros(len(once[0]), np.int64))
        # a suffix that begins with a delimiter has the rank of its word; rank 0 is the end of the text
        some = low > 0
        pairs = np.unique(who[some] * self.size + low[some])
        return pairs // self.size, pairs % self.size - 1


def near_in_block(targets: dict[str, int], queries: list[tuple[str, int, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """``word, number of near words, largest count, its word`` per query that finds any."""
    groups: dict[tuple[int, int, int], list[tuple[str, int]]] = {}
    for word, a, z, f in queries:
        groups.setdefault((len(word), a, z), []).append((word, f))
    forward = sorted(targets)
    backward = sorted(w[::-1] for w in targets)
    indexes: dict[bool, FmIndex] = {}
    for (length, a, z), own in groups.items():
        reverse = a > z
        words = backward if reverse else forward
        if reverse not in indexes:
            indexes[reverse] = FmIndex(words)
        index = indexes[reverse]
        for low in range(0, len(own), 4096):
            part = own[low : low + 4096]
            patterns = index.codes([w[::-1] if reverse else w for w, _ in part], length)
            found: dict[int, list] = {}
            for q, t in zip(*(x.tolist() for x in index.near(patterns, max(a, z), min(a, z))), strict=True):
                word, f = part[q]
                other = words[t][::-1] if reverse else words[t]
                if f and other.startswith(word[:f]):
                    continue
                n = targets[other]
                best = found.setdefault(q, [0, 0, ""])
                best[0] += 1
                if n > best[1] or n == best[1] and other < best[2]:
                    best[1], best[2] = n, other
            for q, (near, n, other) in found.items():
                yield part[q][0], near, n, other


def _search(block: int):
    names = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def answer(targets: dict, queries: list) -> Iterator[pa.RecordBatch]:
        rows = list(near_in_block(targets, queries)) if targets and queries else []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), names.types, strict=True)], schema=names)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets: dict[str, int] = {}
        queries: list[tuple[str, int, int, int]] = []
        last = None
        for batch in batches:
            for key, word, n, a, z, f, query in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last and len(targets) >= block:
                    yield from answer(targets, queries)
                    targets, queries = {}, []
                last = key
                if query:
                    queries.append((word, a, z, f))
                else:
                    targets[word] = n
        yield from answer(targets, queries)

    return search


def near_words(words: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``words`` (columns ``word, n``) that has a near word."""
    rows = deal(words, limit).repartition("key").sortWithinPartitions("key")
    found = rows.select("key", "word", "n", "a", "z", "f", "query").mapInArrow(_search(block), FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best")
    )


def group_variants(words: DataFrame, factor: int = FORM_FACTOR, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word; ``words`` is read more than once: give a written table."""
    near = near_words(words, limit, block)
    df = words.join(near, "word", "left")
    chosen = F.col("best_n") >= factor * F.col("n")
    df = keep(
        df.select(
            "word", F.when(chosen, F.col("best")).alias("form"), F.col("n").cast("long").alias("n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    # A form is more frequent than its word, so chains end; their length halves each round.
    links = df.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(onward, "root", "left_semi").isEmpty():
            break
        links = keep(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return df.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return group_variants(keep(words, "vocabulary"))
