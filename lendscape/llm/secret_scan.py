"""Secret scan over a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. A blob
is scanned once per rule version: pairs of blob and rule version that the
ledger lists already are left out, the rest is scanned through one
representative row each and added to the ledger. Findings are joined back to
all paths that ever held the blob.

Everything is a DataFrame expression. A regular expression gives both its
matches and the gaps between them; their lengths add up to positions.

Defined cases: a NULL text is an empty blob; NULL paths are rows like others;
repeated rows get the same findings each; a rule that matches nothing adds
nothing; an empty table gives an empty result and leaves the ledger as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import fresh, table, text_of
from lendscape.session import keep, new_path
from lendscape.sources.tables import table_exists


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Letters of the names in either case, spelled out because engines
# differ in what else a case-insensitive match folds.
NAMES = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
BASE_RULES = (
    Rule("assign", rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def rule_version(rule: Rule) -> str:
    """A changed rule is another version; its rank in the list doesn't matter."""
    return sha256(repr(rule).encode()).hexdigest()[:16]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, though lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), 0)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    pairs = F.arrays_zip(F.split(text, rule.pattern).alias("gap"), matches.alias("hit"), measured.alias("part"))
    none = F.array().cast(SPAN)

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        good = F.coalesce(F.length(pair["part"]) >= rule.least, F.lit(False))  # the last gap has no match after it
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(good, F.concat(state["found"], F.array(span))).otherwise(state["found"]).cast(SPAN).alias("found"),
        )

    def in_blocks(p: Column) -> Column:
        """Pairs by blocks, as an array that grows is copied at each step: only one of a block's length is."""
        n = F.size(p)
        width = F.greatest(F.lit(8), F.ceil(F.cbrt(n))).cast("int")
        block = lambda b: F.sequence(b * width, F.least((b + 1) * width, n) - 1)
        size = lambda s, i: s + F.length(F.get(p, i)["gap"]) + F.coalesce(F.length(F.get(p, i)["hit"]), F.lit(0))
        sizes = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), lambda b: F.aggregate(block(b), F.lit(0), size))

        def placed(t: Column) -> Column:
            ahead = lambda b: F.aggregate(F.filter(t, lambda x, j: j < b), F.lit(0), lambda s, x: s + x)
            start = lambda b: F.struct(ahead(b).alias("at"), none.alias("found"))
            return F.flatten(F.transform(t, lambda x, b: F.aggregate(block(b), start(b), lambda s, i: step(s, F.get(p, i)))["found"]))

        return _bound(sizes, placed)

    return F.when(text.rlike(rule.pattern), _bound(pairs, in_blocks)).otherwise(none)


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans ``start, rank, kind, end`` (code points, end exclusive) by start, then kind as listed."""
    return F.sort_array(F.concat(*(_spans(text, r, i) for i, r in enumerate(rules))))


def content_address(text: Column) -> Column:
    return F.unhex(F.sha2(text_of(text).cast("binary"), 256))


def scan_versions(versions: DataFrame, path: str, text: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with the column ``spans``, after bringing the ledger at ``ledger`` up to date.

    The ledger is a Parquet folder ``blob, rule, spans``; ``rule`` is the rule's
    version. One writer at a time; a run that dies before its write commits adds
    nothing and is simply repeated.
    """
    spark = versions.sparkSession
    blob, spans = fresh(versions, "_blob", "spans")
    addressed = versions.withColumn(blob, content_address(F.col(text)))
    first = addressed.groupBy(F.col(blob).alias("blob")).agg(F.min(path).alias("_path"))
    wanted = [rule_version(r) for r in rules]
    every = F.array(*map(F.lit, wanted))
    known = spark.read.parquet(ledger).select("blob", "rule") if table_exists(spark, ledger) else None
    if known is None:
        unseen = first.withColumn("_rules", every)
    else:
        listed = known.where(F.col("rule").isin(wanted)).groupBy("blob").agg(F.collect_set("rule").alias("_known"))
        unseen = first.join(listed, "blob", "left").withColumn(
            "_rules", F.array_except(every, F.coalesce("_known", F.array().cast("array<string>")))
        )
        unseen = unseen.where(F.size("_rules") > 0).drop("_known")
    # One row per unseen blob carries its text; the join is on content and path.
    source = addressed.select(F.col(blob).alias("_b"), F.col(path).alias("_p"), text_of(F.col(text)).alias("_t"))
    scanned = source.join(
        unseen.hint("shuffle_hash"), (source["_b"] == unseen["blob"]) & source["_p"].eqNullSafe(unseen["_path"])
    )
    found = F.array(
        *(
            F.struct(
                F.lit(rule_version(r)).alias("rule"),
                F.when(F.array_contains("_rules", rule_version(r)), _spans(F.col("_t"), r, i)).alias("spans"),
            )
            for i, r in enumerate(rules)
        )
    )
    # Repeated rows of a path scan their blob more than once; one entry stays.
    results = scanned.select("blob", F.filter(found, lambda x: x["spans"].isNotNull()).alias("found")).dropDuplicates(["blob"])
    results.select("blob", F.inline("found")).write.mode("append").parquet(ledger)
    hits = (
        spark.read.parquet(ledger)
        .where(F.col("rule").isin(wanted) & (F.size("spans") > 0))
        # Ranks may have moved since an older run wrote them.
        .select("blob", F.explode("spans").alias("s"), (F.array_position(every, F.col("rule")) - 1).cast("int").alias("_rank"))
        .groupBy("blob")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.struct(F.col("s.start").alias("start"), F.col("_rank").alias("rank"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"))
                )
            ).alias("_hits")
        )
    )
    hits = keep(hits, "blob-findings")
    return addressed.join(hits, addressed[blob] == hits["blob"], "left").select(
        *(addressed[c] for c in versions.columns), F.coalesce(hits["_hits"], F.array().cast(SPAN)).alias(spans)
    )


def digest_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_versions(docs, "doc_id", "text", new_path(spark, "ledger"))
    s = F.col("spans")
    base = F.filter(s, lambda x: x["rank"] < len(BASE_RULES))
    counts = [
        F.size(F.filter(F.transform(s, lambda x: x["rank"]), lambda k: k == i)).cast("long").alias(f"n_{r.kind}")  # noqa: B023
        for i, r in enumerate(BASE_RULES)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(digest_text(base).cast("binary"), 256).alias("base_sha256"), digest_text(s).alias("spans")
    )


def _oracle() -> str:
    """Positions by the same sums of lengths, in SQL."""
    kinds, columns = [], []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        group = f"regexp_extract_all(t, '{pattern}', {r.group})"
        kinds.append(f"SELECT row_id, {i} AS rank, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{pattern}') AS gaps, "
                     f"regexp_extract_all(t, '{pattern}') AS hits, {group} AS parts FROM d WHERE regexp_matches(t, '{pattern}')")  # fmt: skip
    for r in BASE_RULES:
        columns.append(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}")
    word = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row_id FROM documents),
k AS ({" UNION ALL ".join(kinds)}),
x AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM k),
p AS (
  SELECT row_id, rank, kind, length(hits[i]) AS n, length(parts[i]) AS m, least,
         CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda g: length(g))), 0) AS BIGINT) AS s
  FROM x),
f AS (SELECT row_id, rank, kind, s, s + n AS e FROM p WHERE m >= least),
g AS (
  SELECT row_id, {", ".join(columns)},
         string_agg({word}, ',' ORDER BY s, rank) FILTER (rank < {len(BASE_RULES)}) AS base,
         string_agg({word}, ',' ORDER BY s, rank) AS spans
  FROM f GROUP BY row_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row_id)
"""


OP4_SQL = _oracle()
