"""Quality rules with verdicts on hosts.

Each document is measured and held against a few rules. Failures are then
added up by host (the document's source), the failure rates of small hosts are
pulled towards the common rate by an empirical beta prior, and the verdict on
the host is joined back: documents of a rejected host have to pass the strict
rules too, documents of other hosts only the base rules.

Everything is a DataFrame expression; windows of words are compared by hash
inside the row, so no text is shuffled.

Defined cases: a NULL text has no words and fails; a NULL source is a host of
its own; repeated rows are judged (and counted for their host) one by one; an
empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import WORD, fresh, table, text_of, words_of
from lendscape.session import keep

# Fixed values
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
STRICT_SYMBOL_PCT = 10
STRICT_DUP_LINE_PCT = 30
STRICT_WORD_CHARS = (2, 14)
MAX_HOST_RATE = 0.5
RULES = ["few_words", "repeats", "symbols", "dup_lines", "word_length"]


def _covered(starts: Column, width: int) -> Column:
    """Positions covered by windows of ``width`` at ascending ``starts``."""
    following = F.slice(starts, F.lit(2), F.size(starts))
    gaps = F.zip_with(following, F.slice(starts, F.lit(1), F.size(starts) - 1), lambda b, a: F.least(b - a, F.lit(width)))
    return F.aggregate(gaps, F.lit(width), lambda total, gap: total + gap)


def _joined(hashes: str, width: int):
    """Hash of a window and of the one that starts ``width`` words later."""
    return lambda h, i: F.xxhash64(h, F.get(hashes, i + width))


def measure(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of counts; and its name."""
    words, lines, hashes, ordered, starts, out = fresh(docs, "_words", "_lines", "_hashes", "_ordered", "_starts", "quality")
    own = [docs[c] for c in docs.columns]
    whole = text_of(docs[text])
    step = docs.select(
        *own, words_of(whole).alias(words), F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD)).alias(lines)
    )
    # Windows of two, four and eight words by doubling. Items are taken by index:
    # a slice inside a lambda would copy the whole array each time.
    step = step.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        step = step.withColumn(hashes, F.transform(hashes, _joined(hashes, width)))
    step = step.withColumn(hashes, F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))))
    # Most texts repeat no window; only the others sort theirs.
    step = step.withColumn(
        ordered,
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    step = step.withColumn(
        starts,
        F.sort_array(
            F.transform(
                F.filter(
                    F.col(ordered),
                    lambda s, k: F.coalesce(F.get(ordered, k - 1)["h"] == s["h"], F.lit(False))
                    | F.coalesce(F.get(ordered, k + 1)["h"] == s["h"], F.lit(False)),
                ),
                lambda s: s["i"],
            )
        ),
    )
    whole = text_of(step[text])
    measured = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.when(
            reduce(or_, (whole.contains(c) for c in SYMBOLS)),
            F.length(whole) - F.length(F.regexp_replace(whole, f"[{SYMBOLS}]", "")),
        ).otherwise(0).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.size(starts) > 0, _covered(F.col(starts), WINDOW)).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    return step.select(*(step[c] for c in docs.columns), measured.alias(out)), out


def rules(q: Column) -> dict[str, Column]:
    """Failed rules of a measured document; the first two are the base."""
    low, high = STRICT_WORD_CHARS
    return {
        "few_words": q["n_words"] < MIN_WORDS,
        "repeats": 100 * q["n_repeat_words"] > MAX_REPEAT_PCT * q["n_words"],
        "symbols": 100 * q["n_symbols"] > STRICT_SYMBOL_PCT * q["n_words"],
        "dup_lines": 100 * q["n_dup_lines"] > STRICT_DUP_LINE_PCT * q["n_lines"],
        "word_length": (q["word_chars"] < low * q["n_words"]) | (q["word_chars"] > high * q["n_words"]),
    }


def base_failed(q: Column) -> Column:
    failed = rules(q)
    return failed["few_words"] | failed["repeats"]


def strict_failed(q: Column) -> Column:
    failed = rules(q)
    return failed["symbols"] | failed["dup_lines"] | failed["word_length"]


def host_rates(measured: DataFrame, quality: str, host: str = "source") -> DataFrame:
    """Shrunk failure rate of every host and rule: ``host, n_docs, rule, n_failed, rate``.

    The beta prior of a rule comes from the hosts' counts by the method of
    moments, hosts weighted by their documents. What chance alone spreads the
    rates of hosts is taken off first; where no spread is left, the prior weighs
    as much as a thousand documents.
    """
    failed = rules(F.col(quality))
    counts = (
        measured.groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), *(F.count_if(failed[r]).alias(r) for r in RULES))
        .select("host", "n_docs", F.explode(F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*RULES))).alias("rule", "n_failed"))
    )
    counts = keep(counts, "host-counts")
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    sums = counts.groupBy("rule").agg(
        F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.sum(f).alias("f"), F.sum(f * f / n).alias("ff")
    )
    # Weighted squares of the rates' distances from the mean: (k - 1) p q by chance, the rest by a correlation within hosts.
    common = sums.withColumn("mean", F.col("f") / F.col("n"))
    chance = F.col("k") - 1
    excess = F.try_divide(F.col("ff") - F.col("f") * F.col("mean"), F.col("mean") * (1 - F.col("mean"))) - chance
    within = F.try_divide(excess, F.col("n") - F.col("nn") / F.col("n") - chance)
    prior = common.withColumn("within", within)
    weight = F.when(F.col("within") > 0, 1 / F.col("within") - 1)
    prior = prior.select(
        F.col("rule").alias("prior_rule"), "mean", F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.coalesce(weight, F.lit(1000.0)))).alias("weight")
    )
    return counts.join(prior, counts["rule"] == prior["prior_rule"]).select(
        "host", "n_docs", "rule", "n_failed",
        ((F.col("n_failed") + F.col("mean") * F.col("weight")) / (F.col("n_docs") + F.col("weight"))).alias("rate"),
    )


def judge(measured: DataFrame, quality: str, host: str = "source", max_rate: float = MAX_HOST_RATE) -> tuple[DataFrame, str, str]:
    """Adds ``host_rejected`` and ``kept`` (or free names like these), and names them.

    ``measured`` is read twice: give it as a written table.
    """
    rejected, kept, key = fresh(measured, "host_rejected", "kept", "_host")
    bad = host_rates(measured, quality, host).groupBy(F.col("host").alias(key)).agg(F.max("rate").alias("_rate"))
    bad = keep(bad.where(F.col("_rate") > max_rate).select(key, F.lit(True).alias(rejected)), "rejected-hosts")
    joined = measured.join(bad, measured[host].eqNullSafe(bad[key]), "left")
    q = F.col(quality)
    flag = F.coalesce(F.col(rejected), F.lit(False))
    return (
        joined.select(
            *(measured[c] for c in measured.columns),
            flag.alias(rejected),
            (~base_failed(q) & ~(flag & strict_failed(q))).alias(kept),
        ),
        rejected,
        kept,
    )


def filter_quality(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    measured, quality = measure(docs)
    written = keep(measured, "measured")
    judged, _, kept = judge(written, quality, host, max_rate)
    return judged.where(F.col(kept)).select(*docs.columns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured, quality = measure(docs)
    written = keep(measured.select("doc_id", "source", quality), "measured")
    judged, rejected, kept = judge(written, quality)
    q = F.col(quality)
    return judged.select(
        "doc_id", *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed(q).alias("base_failed"), F.col(kept).alias("kept"), F.col(rejected).alias("host_rejected"),
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS row_id
  FROM d),
win AS (
  SELECT row_id, i, array_to_string(words[i:i+7], ' ') AS g
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS i) WHERE len(words) >= 8),
dup AS (SELECT row_id, i FROM win QUALIFY count(*) OVER (PARTITION BY row_id, g) > 1),
cover AS (
  SELECT row_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS nxt FROM dup) GROUP BY row_id),
m AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cover USING (row_id)),
r AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2, 100 * n_symbols > 10 * n_words AS f3,
         100 * n_dup_lines > 30 * n_lines AS f4, word_chars < 2 * n_words OR word_chars > 14 * n_words AS f5
  FROM m),
h AS (
  SELECT source, count(*) AS n, unnest([count(*) FILTER (f1), count(*) FILTER (f2), count(*) FILTER (f3),
         count(*) FILTER (f4), count(*) FILTER (f5)]) AS f, unnest([1, 2, 3, 4, 5]) AS rule
  FROM r GROUP BY source),
u AS (
  SELECT rule, count(*) AS k, sum(CAST(n AS DOUBLE)) AS n, sum(CAST(n AS DOUBLE) * n) AS nn, sum(CAST(f AS DOUBLE)) AS f,
         sum(CAST(f AS DOUBLE) * f / n) AS ff
  FROM h GROUP BY rule),
v AS (
  SELECT rule, f / n AS mean,
         ((ff - f * (f / n)) / nullif((f / n) * (1 - f / n), 0) - (k - 1)) / nullif(n - nn / n - (k - 1), 0) AS within
  FROM u),
p AS (
  SELECT rule, mean, greatest(1.0, least(1000.0, coalesce(CASE WHEN within > 0 THEN 1 / within - 1 END, 1000.0))) AS weight
  FROM v),
bad AS (SELECT source FROM h JOIN p USING (rule) GROUP BY source HAVING max((f + mean * weight) / (n + weight)) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND NOT (b AND (f3 OR f4 OR f5)) AS kept, b AS host_rejected
FROM (SELECT r.*, EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM r.source) AS b FROM r)
"""
