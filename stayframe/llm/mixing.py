"""Mixing sources to target weights by repetition rates.

Word counts are summed per source (partial sums before the shuffle, so a hot
source costs one row per task); targets and rates are computed on the table of
sources; each document is then taken floor(rate) times plus once more when its
hash-seeded uniform draw is below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.llm.common import WORDS, pick

CAP = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
_DRAWS = 2 ** 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5(seed:doc_id:md5(text)); the same on every run.

    The text tells rows without an id, or with the same one, apart.
    """
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                   F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(_DRAWS))


def targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> the same with target double.

    All sizes are shared by weight; a source stops at ``cap`` times its size and
    the excess is shared among the rest by weight until none is above.  Closed
    form: with sources in order of cap * size / weight, those below the water
    level are full.  The level after the first k are full is
    (total - their caps) / (weights of the rest); the first k whose level does
    not exceed the next source's ratio is the answer.  One row per source is the
    whole input of these windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    wheel = F.array(*[F.lit(w) for w in weights])
    ranked = (sizes.withColumn("_i", F.row_number().over(by_name))
              .withColumn("_w", F.element_at(wheel, ((F.col("_i") - 1) % len(weights) + 1).cast("int")))
              .withColumn("_cap", F.lit(cap) * F.col("source_size"))
              .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    order = Window.orderBy("_ratio", "_i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (ranked
              .withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
              .withColumn("_rest", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
              .withColumn("_level", F.col("_left") / F.col("_rest"))
              .withColumn("_fits", F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))))
    first = F.first("_fits", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("_water", first).select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_w") * F.coalesce("_water", F.lit(0.0))).alias("target"))


def mix_plan(df: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, rate, copies, taken.

    copies is floor(rate) plus one Bernoulli copy; rate = target / source_size
    (0 where a source has no words).  Nulls: a null text has size 0; a null
    source is a source of its own, last in order; a null doc_id counts as ''.
    Rows that share an id (or have none) draw apart if their texts differ; rows
    with equal id and text count each and draw alike.  Empty table: empty result.
    Other columns are ignored.
    """
    docs = pick(df, doc_id="bigint", text="string", source="string").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("u"))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, cap, weights).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (docs.join(plan, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("rate", rate)
            .withColumn("copies", (F.floor("rate") + F.when(
                F.col("u") < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("bigint"))
            .select("doc_id", "size", "source_size", "target", "rate", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed_documents(df: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS,
                    seed: str = SEED) -> DataFrame:
    """The mix itself: each row repeated as often as the plan takes it, all columns kept.

    Columns are addressed by position, so further ones may have any name.  Nulls,
    repeats and an empty table as in ``mix_plan``; a row without copies goes.
    """
    at = {n: f"c{df.columns.index(n)}" for n in ("doc_id", "text", "source")}
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    sizes = (pick(df, source="string", text="string")
             .groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size")))
    rates = targets(sizes, cap, weights).select(
        F.col("source").alias("_mix_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_mix_rate"))
    u = draw(F.col(at["doc_id"]).cast("bigint"), F.col(at["text"]).cast("string"), seed)
    extra = F.when(u < F.col("_mix_rate") - F.floor("_mix_rate"), 1).otherwise(0)
    return (flat.join(rates, F.col(at["source"]).cast("string").eqNullSafe(F.col("_mix_source")))
            .withColumn("_mix_copy", F.explode(F.array_repeat(
                F.lit(1), (F.floor("_mix_rate") + extra).cast("int"))))
            .drop("_mix_source", "_mix_rate", "_mix_copy").toDF(*df.columns))


OP6_SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS i FROM s),
c AS (SELECT *, (i - 1) % 3 + 1 AS w, {CAP} * source_size AS cap FROM w),
r AS (SELECT *, cap / w AS ratio FROM c),
k AS (SELECT a.source, a.source_size, a.w, a.cap, a.ratio,
        (SELECT CAST(sum(source_size) AS BIGINT) FROM r)
          - coalesce((SELECT CAST(sum(b.cap) AS BIGINT) FROM r b WHERE (b.ratio, b.i) < (a.ratio, a.i)), 0) AS left_over,
        (SELECT CAST(sum(b.w) AS BIGINT) FROM r b WHERE (b.ratio, b.i) >= (a.ratio, a.i)) AS rest, a.i
      FROM r a),
l AS (SELECT coalesce((SELECT left_over / rest FROM k WHERE left_over / rest <= ratio ORDER BY ratio, i LIMIT 1), 0) AS water),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * water) AS target FROM k, l),
m AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.digest), 1, 8)) AS BIGINT) / {float(_DRAWS)} AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, rate,
       CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM m
"""
