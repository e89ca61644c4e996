r"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines decides where a chunk
ends, so that a passage is cut the same way wherever it stands and whatever
precedes it. A line of fifty words or more (49 blanks: counting blanks is much cheaper than
splitting words) is a chunk of its own. Chunks of
several lines (or one such long line) that occur more than once anywhere are
compared byte by byte; the first occurrence by document id and position stays,
the others are removed.

With ``runs`` (as in the corpus pipeline) every repeated passage goes, however it
is cut into chunks: a line also goes if it lies in a run of lines of fifty words or more
that stands earlier, and a text shorter than that goes if the whole of it stands
earlier as a text. Two windows per line cover any such run: the shortest ones of
fifty words that start and that end with the line. Lines without words don't
count; words are separated by the white space of the contract. Windows are
compared by two independent hashes, 124 bits together. A window that overlaps
its own first occurrence stays.

Everything is a DataFrame expression. Hashes travel first; texts of chunks only
where a hash repeats.

Defined cases: a NULL text is an empty one; documents without an id come after
all others; rows that repeat both id and text are the same document, and keep or
lose the same chunks; chunks below ``min_chars`` characters stay; an empty table
gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import WORD, fresh, table, text_of, words_of
from lendscape.session import keep

# Fixed values
DIVISOR = 3
MODULUS, FACTOR = 1_000_003, 31
LONG_LINE = 49  # blanks: fifty words
MIN_CHARS = 50
RUN_WORDS = 50
LEVELS = 6  # 2**6 - 1 lines of a word each are more than a run holds before its last line


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def with_chunks(docs: DataFrame, text: str, divisor: int = DIVISOR, long_line: int = LONG_LINE) -> tuple[DataFrame, str]:
    r"""``docs`` with an array of chunks, and its name. Every line of a chunk starts with a blank.

    With the blank, two line feeds in a row can only be a chunk's end: one join
    and one split cut a text of any length in linear time.
    """
    lines, hash_, long_, chunks = fresh(docs, "_lines", "_hash", "_long", "chunks")
    step = docs.withColumn(lines, F.split(text_of(docs[text]), "\n"))
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long"))
    long = F.transform(lines, lambda x: blanks(x) >= long_line)
    # Both are used twice: as columns they are computed once.
    step = step.withColumns({hash_: hashes, long_: long})
    hashes, long = F.col(hash_), F.col(long_)
    # Neighbours are zipped in, not looked up: the optimizer may inline these
    # arrays, and a lookup of an inlined array would compute it for every line.
    before = F.slice(F.concat(F.array(F.lit(0).cast("long")), hashes), F.lit(1), F.size(lines))
    after = F.slice(long, F.lit(2), F.size(lines))
    zipped = F.arrays_zip(
        F.col(lines).alias("line"), hashes.alias("hash"), before.alias("before"), long.alias("long"), after.alias("after")
    )

    def marked(x: Column) -> Column:
        ends = ((x["hash"] * FACTOR + x["before"]) % MODULUS % divisor == 0) | x["long"] | x["after"]
        return F.concat(F.lit(" "), x["line"], F.when(ends & x["after"].isNotNull(), "\n").otherwise(""))

    step = step.withColumn(chunks, F.split(F.array_join(F.transform(zipped, marked), "\n"), "\n\n"))
    return step.select(*(step[c] for c in docs.columns), chunks), chunks


def word_count(line: Column) -> Column:
    """Words of a line; splitting at blanks is cheaper and mostly enough."""
    return F.size(F.when(line.rlike(r"[\x09-\x0D]"), words_of(line)).otherwise(F.array_remove(F.split(line, " "), "")))


def run_windows(own: DataFrame) -> DataFrame:
    """``id, version, start, n, first, last, a, b`` per window of ``own`` (``id, t``).

    ``start`` and ``n`` count lines with words, ``first`` and ``last`` all lines.
    Blocks of 1, 2, 4 ... lines by doubling; a window is the sum of at most one
    block of each size and its last line, so the time is linear in the lines.
    """
    text = text_of(F.col("t"))
    line = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(
            i.alias("at"), F.least(word_count(x), F.lit(RUN_WORDS)).alias("n"), F.xxhash64(x).alias("a"),
            F.conv(F.substring(F.md5(x.cast("binary")), 1, 15), 16, 10).cast("long").alias("b"),
        ),
    )
    step = own.select("id", F.xxhash64(text).alias("version"), F.filter(line, lambda z: z["n"] > 0).alias("s0"))

    def joined(x: Column, y: Column) -> list[Column]:
        return [(x["n"] + y["n"]).alias("n"), F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(F.lit(1), x["b"], y["b"]).alias("b")]

    def doubled(k: int):  # noqa: ANN202
        return lambda x, i: F.struct(i.alias("at"), *joined(x, F.get(f"s{k}", i + (1 << k))))

    for k in range(LEVELS - 1):
        step = step.withColumn(f"s{k + 1}", F.transform(f"s{k}", doubled(k)))

    def windows(back: bool) -> Column:
        """Windows by the line they start (or, going back, end) with."""

        def grown(k: int):  # noqa: ANN202
            size = 1 << k

            def one(x: Column) -> Column:
                y = F.get(f"s{k}", x["at"] - (size - 1) if back else x["at"])
                return F.when(x["n"] + y["n"] < RUN_WORDS, F.struct(x["own"].alias("own"), (x["at"] + (-size if back else size)).alias("at"), *joined(x, y))).otherwise(x)

            return one

        state = F.transform(
            "s0", lambda x, i: F.struct(i.alias("own"), i.alias("at"), F.lit(0).alias("n"), F.lit(int(back)).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        )
        for k in reversed(range(LEVELS)):
            state = F.transform(state, grown(k))

        def ended(x: Column) -> Column:
            y = F.get("s0", x["at"])
            n, a, b = joined(x, y)
            start, end = (x["at"], x["own"]) if back else (x["own"], x["at"])
            return F.struct(
                start.alias("start"), (end - start + 1).alias("n"), F.get("s0", start)["at"].alias("first"), F.get("s0", end)["at"].alias("last"),
                a, b, x["n"].alias("before"), y["n"].alias("end"),
            )

        found = F.filter(F.transform(state, ended), lambda x: x["before"] + x["end"] >= RUN_WORDS)
        if back:  # a window that is shortest from its start, too, is known already
            found = F.filter(found, lambda x: x["before"] + x["end"] - F.get("s0", x["start"] + x["n"] - 1)["n"] >= RUN_WORDS)
        return F.transform(found, lambda x: F.struct(*(x[c].alias(c) for c in ("start", "n", "first", "last", "a", "b"))))

    s0, last = F.col("s0"), F.get("s0", F.size("s0") - 1)["at"]
    short = F.aggregate(s0, F.lit(0), lambda n, x: F.least(n + x["n"], F.lit(RUN_WORDS))) < RUN_WORDS
    whole = F.struct(
        F.lit(0).alias("start"), F.size(s0).alias("n"), F.get("s0", F.lit(0))["at"].alias("first"), last.alias("last"),
        F.xxhash64(F.transform(s0, lambda x: x["a"])).alias("a"), F.xxhash64(F.transform(s0, lambda x: x["b"])).alias("b"),
    )
    spans = F.when((F.size(s0) > 0) & short, F.array(whole)).otherwise(F.concat(windows(False), windows(True)))
    return step.select("id", "version", F.inline(spans))


def repeated_lines(own: DataFrame) -> DataFrame:
    """``id, version, line``: lines of runs that stand earlier in ``own`` (``id, t``)."""
    windows = run_windows(own)
    place = F.struct(F.isnull("id").alias("no_id"), "id", "version", "start")
    repeated = keep(windows.groupBy("a").count().where("count > 1").select("a"), "repeated-windows")
    found = keep(windows.join(repeated.hint("merge"), "a", "left_semi"), "repeated-runs")
    first = found.groupBy("a", "b").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high").drop("high")
    low = F.col("low")
    own_first = F.col("id").eqNullSafe(low["id"]) & (F.col("version") == low["version"]) & (F.col("start") < low["start"] + F.col("n"))
    return found.join(first, ["a", "b"]).where(~own_first).select("id", "version", F.explode(F.sequence("first", "last")).alias("line"))


def _marks(lines: Column) -> Column:
    """An array that is true at the positions ``lines``; built from their gaps, so in linear time."""
    ordered = F.sort_array(lines)
    before = F.concat(F.array(F.lit(-1)), F.slice(ordered, F.lit(1), F.greatest(F.size(ordered) - 1, F.lit(0))))
    gaps = F.zip_with(ordered, before, lambda x, y: F.concat(F.array_repeat(F.lit(False), x - y - 1), F.array(F.lit(True))))
    return F.when(F.size(lines) > 0, F.flatten(gaps)).otherwise(F.array().cast("array<boolean>"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    divisor: int = DIVISOR, long_line: int = LONG_LINE, runs: bool = False,
) -> tuple[DataFrame, str]:
    """``docs`` with ``text`` replaced, and a struct ``removed`` of counts; and that column's name.

    ``runs`` removes repeated runs of lines, too.
    """
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    cut, chunks = with_chunks(own, "t", divisor, long_line)
    chunk = F.col("chunk")
    several = chunk.contains("\n")
    pieces = (
        cut.select("id", F.xxhash64(text_of(F.col("t"))).alias("version"), F.posexplode_outer(chunks).alias("at", "chunk"))
        # A single line has one blank in front.
        .where((F.length(chunk) >= min_chars) & (several | (blanks(chunk) > long_line)))
        .select("id", "version", "at", F.xxhash64("chunk").alias("hash"), "chunk")
    )
    place = F.struct(F.isnull("id").alias("no_id"), "id", "version", "at")
    repeated = pieces.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    repeated = keep(repeated.where(F.col("low") != F.col("high")).select("hash"), "repeated-hashes")
    # How much repeats has no bound: these joins never broadcast.
    texts = keep(pieces.join(repeated.hint("merge"), "hash", "left_semi"), "repeated-chunks")
    first = texts.groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(F.col("first") != F.col("last")).select(F.col("hash").alias("h"), F.col("chunk").alias("c"), "first")
    gone = texts.join(first, (texts["hash"] == first["h"]) & (texts["chunk"] == first["c"])).where(place != F.col("first"))
    gone = gone.select("id", "version", "at", F.lit(None).cast("int").alias("line"))
    if runs:
        gone = gone.unionByName(repeated_lines(own).withColumn("at", F.lit(None).cast("int")))
    gone = gone.groupBy("id", "version").agg(F.collect_set("at").alias("gone"), F.collect_set("line").alias("lines"))
    gone = keep(gone, "removed-chunks").select(
        F.col("id").alias("_gid"), F.col("version").alias("_gversion"), F.col("gone").alias("_gone"), F.col("lines").alias("_glines")
    ).hint("merge")

    drop, removed, rest, in_runs = fresh(docs, "_drop", "removed", "_rest", "_in_runs")
    none = F.array().cast("array<int>")
    joined = docs.join(
        gone, docs[doc_id].eqNullSafe(gone["_gid"]) & (F.xxhash64(text_of(docs[text])) == gone["_gversion"]), "left"
    ).select(*(docs[c] for c in docs.columns), F.coalesce(gone["_gone"], none).alias(drop), F.coalesce(gone["_glines"], none).alias(in_runs))
    joined, chunks = with_chunks(joined, text, divisor, long_line)
    if runs:
        return _without_lines(docs, joined, text, chunks, drop, in_runs, removed)
    count_lines = F.transform(
        F.filter(chunks, lambda c, k: F.array_contains(drop, k)), lambda c: F.size(F.split(c, "\n"))
    )
    joined = joined.withColumn(
        rest, F.array_join(F.filter(chunks, lambda c, k: ~F.array_contains(drop, k)), "\n")
    ).withColumn(
        removed,
        F.struct(
            F.size(chunks).cast("long").alias("n_chunks"),
            F.size(drop).cast("long").alias("n_removed_chunks"),
            F.aggregate(count_lines, F.lit(0), lambda n, k: n + k).cast("long").alias("n_removed_lines"),
        ),
    )
    # The blank goes from every line start, and from nowhere else.
    clean = F.when(F.size(drop) == 0, joined[text]).otherwise(F.regexp_replace(rest, r"(^|\n) ", "$1"))
    return joined.select(*((clean.alias(text) if c == text else joined[c]) for c in docs.columns), removed), removed


def _without_lines(docs: DataFrame, joined: DataFrame, text: str, chunks: str, drop: str, in_runs: str, removed: str) -> tuple[DataFrame, str]:
    """The lines of ``joined`` that are neither in the chunks ``drop`` nor among the lines ``in_runs``."""
    in_chunks = F.flatten(F.transform(chunks, lambda c, k: F.array_repeat(F.array_contains(drop, k), F.size(F.split(c, "\n")))))
    # Zipped, not looked up: see with_chunks.
    zipped = F.arrays_zip(F.split(text_of(joined[text]), "\n").alias("line"), in_chunks.alias("c"), _marks(F.col(in_runs)).alias("r"))
    left = F.filter(zipped, lambda z: ~F.coalesce(z["c"], F.lit(False)) & ~F.coalesce(z["r"], F.lit(False)))
    (lines,) = fresh(joined, "_left")
    joined = joined.withColumn(lines, F.when((F.size(drop) > 0) | (F.size(in_runs) > 0), F.transform(left, lambda z: z["line"])))
    counts = F.struct(
        F.size(chunks).cast("long").alias("n_chunks"),
        F.size(drop).cast("long").alias("n_removed_chunks"),
        F.coalesce(F.size(F.split(text_of(joined[text]), "\n")) - F.size(lines), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
    clean = F.when(F.isnull(lines), joined[text]).otherwise(F.array_join(lines, "\n"))
    return joined.select(*((clean.alias(text) if c == text else joined[c]) for c in docs.columns), counts.alias(removed)), removed


def drop_repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Cleaned documents; those of which no word is left go, exact copies among them."""
    cleaned, _ = remove_repeats(docs, doc_id, text, runs=True)
    return cleaned.where(text_of(F.col(text)).rlike(WORD)).select(*docs.columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned, removed = remove_repeats(docs)
    return cleaned.select("doc_id", f"{removed}.*", text_of(F.col("text")).alias("text"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS i, len(s) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
h AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS x,
         length(line) - length(replace(line, ' ', '')) >= 49 AS wide FROM l),
b AS (
  SELECT *, (x * 31 + coalesce(lag(x) OVER w, 0)) % 1000003 % 3 = 0 OR wide OR coalesce(lead(wide) OVER w, false) AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM b),
c AS (
  SELECT doc_id, pos, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n_lines, bool_or(wide) AS wide FROM k GROUP BY doc_id, pos),
r AS (
  SELECT *, length(chunk) + n_lines >= 50 AND (n_lines > 1 OR wide)
            AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) > 1 AS gone FROM c)
SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks,
       CAST(coalesce(sum(n_lines) FILTER (gone), 0) AS BIGINT) AS n_removed_lines,
       coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM r GROUP BY doc_id
"""
