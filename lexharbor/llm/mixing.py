"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD_PATTERN

# Offsets tried for a source's last, fractional repetition; the one nearest its target is used.
OFFSETS = 16
WEIGHTS = (3.0, 1.0, 2.0)


def words_in(text: str = "text") -> Column:
    """Words of a text separated by ASCII white space; none in a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def weights_in_turn(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, total`` with ``weight``: the given ones in turn, by code point, null last.

    One row per source; the table of sources alone is put in order.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(given, (rank % len(weights)).cast("int")))


def fill(sources: DataFrame, share: float, epochs: float) -> DataFrame:
    """Targets of ``source, total, weight``: ``share`` of all, none above ``epochs`` totals.

    Sources that their weighted share would lift above the cap stop there and the rest is shared
    anew until none is above. Each round is one aggregation over the sources; the level only
    rises, so at most as many rounds as sources are needed.
    """
    cap = F.col("total") * F.lit(float(epochs))
    table = sources.withColumn("cap", cap)
    total, weight = table.agg(F.sum("total"), F.sum("weight")).first()
    whole = float(share) * (total or 0)
    level = whole / weight if weight else 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, free = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        new = (whole - capped) / free if free else level
        if not free or new <= level:
            break
        level = new
    return table.withColumn("target", F.least(F.col("cap"), F.lit(level) * F.col("weight"))) \
        .drop("cap")


def chance(seed: int, value: Column) -> Column:
    """A number from 0 to 1, fixed by the seed and the value."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 7)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** 7))


def mix(docs: DataFrame, share: float = 1.5, epochs: float = 2.0,
        weights: tuple[float, ...] = WEIGHTS, seed: int = 7,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """How often each document goes into the mix: ``doc_id, source, size, source_size, target,
    repeats, taken``.

    A source's documents are each taken ``floor(target / source_size)`` times and an even share of
    them once more: in order of size (then of a seeded hash), every k-th, from the one of
    ``OFFSETS`` seeded starts whose sum comes nearest the target. So every size is represented
    alike and a source misses its target by a part of one document. Ranks are counts of the
    smaller sizes of a source and of the smaller hash digits of a size, plus a place within the
    group, so no task sorts a whole source. A null text or source is kept, with size 0 or as a source of its own; documents
    of size 0 are taken zero words; rows that repeat a ``doc_id`` count each for itself; an empty
    table gives no rows; extra columns are not read but for those to ``carry``, which also settle
    ties of rows that repeat an id.
    """
    size = words_in()
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                                   size.alias("size"), key.alias("key"), *carry), "mix-sizes")
    rows = rows.withColumn("digit", F.substring("key", 1, 2))
    totals = rows.groupBy("source").agg(F.sum("size").alias("total"))
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))
    targets = materialize(fill(materialize(weights_in_turn(totals, weights), "mix-sources"),
                               share, epochs)
                          .withColumn("ratio", F.when(F.col("total") > 0,
                                                      F.col("target") / F.col("total"))
                                      .otherwise(F.lit(0.0)))
                          .withColumn("whole", F.floor("ratio"))
                          .withColumn("rest", F.col("ratio") - F.col("whole"))
                          .withColumn("begin", chance(seed, name)), "mix-targets")
    group = ["source", "size", "digit"]
    upto = (Window.unboundedPreceding, -1)
    sizes = rows.groupBy("source", "size").count()
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(*upto)
    sizes = sizes.select(F.col("source").alias("z_source"), F.col("size").alias("z_size"),
                         F.coalesce(F.sum("count").over(smaller), F.lit(0)).alias("under"))
    alike = Window.partitionBy("source", "size").orderBy("digit").rowsBetween(*upto)
    groups = (rows.groupBy(*group).count()
              .withColumn("within", F.coalesce(F.sum("count").over(alike), F.lit(0)))
              .join(sizes, F.col("source").eqNullSafe(F.col("z_source"))
                    & (F.col("size") == F.col("z_size")))
              .select(*group, (F.col("under") + F.col("within")).alias("offset")))
    inner = F.row_number().over(Window.partitionBy(*group).orderBy("key", "doc_id", *carry))
    placed = (rows.join(groups.withColumnsRenamed({"source": "g_source", "size": "g_size",
                                                   "digit": "g_digit"}),
                        F.col("source").eqNullSafe(F.col("g_source"))
                        & (F.col("size") == F.col("g_size")) & (F.col("digit") == F.col("g_digit")))
              .withColumn("place", F.col("offset") + inner - 1)
              .drop("g_source", "g_size", "g_digit", "offset", "digit", "key"))
    known = (placed.join(targets.withColumnRenamed("source", "t_source"),
                         F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source"))
    once = [_once_more(F.col("place"), F.col("rest"), F.col("begin"), j) for j in range(OFFSETS)]
    sums = known.groupBy("source").agg(*[F.sum(F.when(c, F.col("size")).otherwise(0)).alias(f"x{j}")
                                         for j, c in enumerate(once)])
    sums = sums.join(targets.withColumnRenamed("source", "t_source"),
                     F.col("source").eqNullSafe(F.col("t_source")))
    miss = [F.struct(F.abs(F.col("whole") * F.col("total") + F.col(f"x{j}") - F.col("target"))
                     .alias("miss"), F.lit(j).alias("j")) for j in range(OFFSETS)]
    best = sums.select(F.col("source").alias("b_source"), F.least(*miss)["j"].alias("start"))
    picked = F.coalesce(*[F.when(F.col("start") == j, c) for j, c in enumerate(once)])
    return (known.join(best, F.col("source").eqNullSafe(F.col("b_source")))
            .withColumn("repeats", F.col("whole") + picked.cast("long"))
            .select("doc_id", "source", "size", F.col("total").alias("source_size"), "target",
                    "repeats", (F.col("size") * F.col("repeats")).alias("taken"), *carry))


def _once_more(place: Column, rest: Column, begin: Column, j: int) -> Column:
    at = begin + F.lit(j / OFFSETS)
    return F.floor(rest * (place + 1) + at) > F.floor(rest * place + at)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS total,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * total AS cap,
         (1.5::DOUBLE * sum(total) OVER () - coalesce(sum(2.0::DOUBLE * total) OVER (
            ORDER BY 2.0::DOUBLE * total / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * total / weight, source
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals),
chosen AS (SELECT max(level) AS level FROM levels),
targets AS (
  SELECT source, total, target, total > 0 AS some,
         CASE WHEN total > 0 THEN target / total ELSE 0 END AS ratio,
         ('0x' || substr(md5('7:' || coalesce('s' || source, '-')), 1, 7))::BIGINT / 268435456.0::DOUBLE AS start
  FROM (SELECT l.source, l.total, least(cap, c.level * weight) AS target
        FROM levels l CROSS JOIN chosen c)),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.total, t.target, floor(t.ratio) AS whole,
         t.ratio - floor(t.ratio) AS rest, t.start,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.key, s.doc_id) - 1 AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
tries AS (
  SELECT p.*, j, (floor(rest * (place + 1) + (start + j / 16.0::DOUBLE))
                  > floor(rest * place + (start + j / 16.0::DOUBLE)))::BIGINT AS more
  FROM placed p CROSS JOIN range({OFFSETS}) r(j)),
best AS (
  SELECT source, first(j ORDER BY miss, j) AS j FROM (
    SELECT source, j, abs(any_value(whole * total) + sum(size * more) - any_value(target)) AS miss
    FROM tries GROUP BY source, j) GROUP BY source)
SELECT doc_id, size::BIGINT AS size, total AS source_size, target,
       (size * (whole + more))::BIGINT AS taken
FROM tries t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.j = b.j
"""
