"""Mixing sources to target weights by histograms over hash thresholds.

A document's hash comes from its id alone, so runs agree and no row is sorted. Tokens are
summed by source and hash bucket; the running sum over a source's few buckets finds the one
in which its budget ends; only that bucket is split again, until the end of the budget
is one hash value. Documents below it are taken, and rows of exactly that value share what
is left in proportion. Budgets nest: a larger one takes all that a smaller one takes.

A source whose target exceeds its size takes every document once and the excess by the same
threshold a second time.

Scale: one scan of the texts writes (id, source, size, hash), which all passes read; a pass
shuffles pre-aggregated sums only, at most ``BUCKETS`` rows per source and task, however
large a source is. Targets are a table of one row per source.

A null text has size 0. Null sources are one source, named last. Repeated rows count
each; documents without an id hash alike, and share at the threshold. An empty table gives
an empty result. Other columns are kept by ``mix`` and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.llm.storage import join_checked, stored

BITS = (12, 12, 12, 12, 12)  # of the hash, one level after another
HASH_BITS = sum(BITS)
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # total of all targets, times all sizes
MOST = 2  # times a document may be taken


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the id's MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Target of each source: by weight, never over ``MOST`` times its size.

    With ``x`` as words per unit of weight, a source stops where ``x`` times its weight meets its
    limit. Sources in order of limit per weight stop one after the other, so running sums over
    that order give each possible ``x``, and the right one is the first that the next
    source does not stop. One row per source: a small table.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    number = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), number + 1))
    per = per.withColumn("limit", MOST * F.col("source_size").cast("double"))
    everything = W.partitionBy(F.lit(1))
    per = per.withColumn("total", F.sum("source_size").over(everything) * SHARE[0] / SHARE[1])
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    stopped = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("x", (F.col("total") - stopped) / open_weight)
    holds = F.col("x") * F.col("weight") <= F.col("limit")
    candidate = F.struct((F.col("limit") / F.col("weight")).alias("at"), F.col("source").isNull().alias("last"), "source", "x")
    per = per.withColumn("x", F.min(F.when(holds, candidate)).over(everything)["x"])
    target = F.when(F.col("x").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("x") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def _boundaries(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source: the hash at which its budget ends, what is left there, and the words of that hash.

    ``rows``: source, size, hash; ``budgets``: source, budget. Sources are keys of
    joins through ``key``.
    """
    state = budgets.select("key", F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("prefix"))
    shift, current = HASH_BITS, rows
    for bits in BITS:
        shift -= bits
        prefix = F.shiftright("hash", shift)
        counts = current.groupBy("key", prefix.alias("bucket")).agg(F.sum("size").alias("words"))
        counts = join_checked(counts, state.select("key", "left"), ["key"])
        until = F.sum("words").over(W.partitionBy("key").orderBy("bucket"))
        ends = counts.withColumn("until", until).filter(F.col("until") > F.col("left"))
        state = stored(
            ends.groupBy("key").agg(F.min(F.struct("bucket", "until", "words", "left")).alias("e")).select(
                "key", (F.col("e.left") - F.col("e.until") + F.col("e.words")).alias("left"),
                F.col("e.bucket").alias("prefix"), F.col("e.words").alias("words"),
            )
        )
        bound = state.select("key", "prefix")
        current = join_checked(rows, bound, ["key"]).filter(prefix == F.col("prefix")).drop("prefix")
    return state


def source_key(source: Column) -> Column:
    """A key without nulls, and unlike any other source's for the null source."""
    return F.concat(F.when(source.isNull(), "0").otherwise("1"), F.coalesce(source, F.lit("")))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), id_hash(F.col("doc_id")).alias("hash"),
        source_key(F.col("source")).alias("key"),
    )


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source: size, target, and how its budget ends (rounds, bound, rest, bound_words).

    ``rows``: source, size, hash, key of each document.
    """
    targets = stored(source_targets(rows, weights))
    named = targets.select(
        source_key(F.col("source")).alias("key"), "source_size", "target",
        F.round("target").cast("bigint").alias("words"),
    )
    named = named.withColumn("rounds", F.expr("words div greatest(source_size, 1)"))
    named = named.withColumn("budget", F.col("words") - F.col("rounds") * F.col("source_size"))
    ends = _boundaries(rows.select("key", "size", "hash"), named)
    return stored(
        named.join(ends.withColumnsRenamed({"prefix": "bound", "left": "rest", "words": "bound_words"}), "key", "left")
    )


def _taken(size: Column, hashed: Column, plan: str = "plan") -> Column:
    """Words that the mix takes of a row, given its source's plan."""
    p = {c: F.col(f"{plan}.{c}") for c in ("rounds", "bound", "rest", "bound_words")}
    part = (size * p["rest"] / p["bound_words"]).cast("bigint")
    more = F.when(hashed < p["bound"], size).when(hashed == p["bound"], part).otherwise(F.lit(0))
    return (p["rounds"] * size + more).cast("bigint")


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each row of ``docs``."""
    rows = stored(_measured(docs))
    plan = plan_mix(rows, weights)
    packed = plan.select("key", F.struct(*[c for c in plan.columns if c != "key"]).alias("plan"))
    return join_checked(rows, packed, ["key"]).select(
        "doc_id", "size", "plan.source_size", "plan.target", _taken(F.col("size"), F.col("hash")).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Rows of which the mix takes words, with all their columns, and ``size`` and ``taken``.

    An input column named size or taken gives way to the new one.
    """
    plan = plan_mix(stored(_measured(docs)), weights)
    packed = plan.select("key", F.struct(*[c for c in plan.columns if c != "key"]).alias("plan"))
    columns = [c for c in docs.columns if c not in ("size", "taken")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), word_count(F.col("text")).alias("size"),
        id_hash(F.col("doc_id")).alias("hash"), source_key(F.col("source")).alias("key"),
    )
    taken = join_checked(rows, packed, ["key"]).select(
        "row.*", "size", _taken(F.col("size"), F.col("hash")).alias("taken")
    )
    return taken.filter("taken > 0")


SQL = """
WITH r AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS hash FROM documents),
p AS (SELECT source, sum(size) AS source_size FROM r GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight,
    2 * source_size::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE * 3 / 2 AS total FROM p),
f AS (SELECT *, (total - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS x
    FROM w WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT first(x ORDER BY most / weight, source NULLS LAST) AS x FROM f WHERE x * weight <= most),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(most, g.x * weight) AS target FROM f, g),
u AS (SELECT *, CAST(round(target) AS BIGINT) AS words, CAST(round(target) AS BIGINT) // greatest(source_size, 1) AS rounds FROM t),
h AS (SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS until FROM r GROUP BY source, hash)
SELECT r.doc_id, r.size, u.source_size, u.target, CAST(u.rounds * r.size + CASE
    WHEN h.until <= u.words - u.rounds * u.source_size THEN r.size
    WHEN h.until - h.words >= u.words - u.rounds * u.source_size THEN 0
    ELSE r.size * (u.words - u.rounds * u.source_size - h.until + h.words) // h.words END AS BIGINT) AS taken
FROM r JOIN u ON r.source IS NOT DISTINCT FROM u.source JOIN h ON h.source IS NOT DISTINCT FROM r.source AND h.hash = r.hash
"""
