"""Mixing sources to target weights along a curriculum that varies over training time.

Training time runs from 0 to 1. The weight of a source is a polygon over it. Its integral says how
many words the source gives in total, its running integral how many it has to give by each moment.
The documents of a source lie one after the other on a line of words, which is repeated until the
target is reached; inverting the running demand at the start of a document gives the moment at which
it is trained on, and sorting by that moment gives the order of training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridagro.llm.common import WORD, join_groups, read, row_key, stored, unused

#: Weights by the rank of the source and the share of all words that the mix takes.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
#: A document is taken this often at most.
REPEATS = 2
#: Factors on the weight at the start, the middle and the end of training, repeating by rank; each polygon has the mean 1.
CURRICULUM = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (0.75, 1.25, 0.75))

_HASH_BITS = 60


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int, curriculum) -> DataFrame:
    """Per source: source_size, docs, target and its polygon ``factors``, from rows (source, size).

    There is one row per source from here on, so the windows over all of them see few rows. Targets
    are proportional to the integrated weights and stop at ``repeats`` times the source's size; what
    is above goes to the others by weight: with the sources in the order of cap / weight, the level
    of the rest only rises while sources are capped, so the final level is the largest one.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    polygons = F.array(*[F.array(*[F.lit(float(x)) for x in line]) for line in curriculum])
    area = [sum((a + b) / 2 for a, b in zip(line, line[1:])) / (len(line) - 1) for line in curriculum]
    ranked = each.withColumn("rank", rank).select(
        "source", "source_size", "docs",
        (F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))) + 1)
         * F.element_at(F.array(*[F.lit(a) for a in area]), F.pmod("rank", F.lit(len(area))) + 1)).alias("weight"),
        F.element_at(polygons, F.pmod("rank", F.lit(len(area))) + 1).alias("factors"),
    )
    line = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    given = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    level = (share * F.sum("source_size").over(everything) - given) / open_weight
    capped = ranked.withColumn("cap", repeats * F.col("source_size").cast("double")).withColumn("level", level)
    capped = capped.withColumn("level", F.max("level").over(everything))
    return capped.select("source", "source_size", "docs", F.least("cap", F.col("weight") * F.col("level")).alias("target"), "factors")


def moment(done: Column, factors: Column, points: int) -> Column:
    """The time at which a source has given the share ``done`` of its target.

    Each piece of the polygon is a quadratic in the running integral; pieces are tried in order.
    """
    width = 1.0 / (points - 1)
    areas = [(factors[i] + factors[i + 1]) / 2 * width for i in range(points - 1)]
    total = sum(areas[1:], areas[0])
    out, reached = F.lit(1.0), [F.lit(0.0)]
    for area in areas:
        reached.append(reached[-1] + area)
    for i in reversed(range(points - 1)):
        left = done * total - reached[i]
        slope = (factors[i + 1] - factors[i]) / width
        # the root of factors[i] x + slope x^2 / 2 = left that stays finite for slope 0
        x = F.try_divide(2 * left, factors[i] + F.sqrt(F.greatest(F.lit(0.0), factors[i] * factors[i] + 2 * slope * left)))
        out = F.when(done * total <= reached[i + 1], i * width + F.coalesce(x, F.lit(0.0))).otherwise(out)
    return F.least(out, F.lit(1.0))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, curriculum=CURRICULUM) -> DataFrame:
    """One row per document: key, tie, doc_id, source, size, source_size, target, taken, visits.

    ``docs`` has doc_id, text and source. A size is the number of words, 0 for a null text. Sources
    are ranked by code point, null last, and get ``weights`` and ``curriculum`` polygons in turn.
    ``visits`` holds (epoch, words, position) for each time that the document is trained on; the last
    visit before the target may be cut short. Order within a source is by the MD5 of the doc_id, so
    runs agree. Documents without words are never visited. ``key`` and ``tie`` name the row (see
    ``training_order``). An empty table gives no rows.

    A source may hold any share of the documents: its line is cut into about sqrt(n) slices of about
    sqrt(n) documents, sums are taken inside slices and then over slices.
    """
    points = len(curriculum[0])
    name = F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    sizes = docs.select(
        row_key(docs, "source").alias("key"), docs["doc_id"], docs["source"], name.alias("name"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sizes = stored(sizes, "sizes")
    targets = stored(source_targets(sizes, weights, share, repeats, curriculum), "targets")
    total = targets.agg(F.sum("docs")).first()[0] or 0
    # nulls would not meet in the join
    coded = sizes.withColumn("code", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    sourced = join_groups(coded, targets.withColumn("code", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source"), "code", "docs", total)

    place = F.conv(F.substring("name", 1, _HASH_BITS // 4), 16, 10).cast("double") / float(1 << _HASH_BITS)
    sliced = sourced.withColumn("slice", F.floor(place * F.ceil(F.sqrt("docs"))))
    sums = sliced.groupBy("code", "slice").agg(F.sum("size").alias("slice_size"))
    before = F.sum("slice_size").over(Window.partitionBy("code").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("slice_size")
    offsets = sums.select("code", "slice", before.alias("offset"))
    running = F.sum("size").over(Window.partitionBy("code", "slice").orderBy("name", "size", "key").rowsBetween(Window.unboundedPreceding, 0))
    lined = sliced.withColumn("start", running - F.col("size")).join(offsets, ["code", "slice"])
    lined = lined.withColumn("start", F.col("start") + F.col("offset")).withColumn("tie", F.row_number().over(Window.partitionBy("code", "slice", "key").orderBy("start")))

    def visit(epoch: Column) -> Column:
        start = F.col("start") + epoch * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - start))
        return F.struct(epoch.cast("int").alias("epoch"), words.alias("words"), moment(F.try_divide(start.cast("double"), F.col("target")), F.col("factors"), points).alias("position"))

    visits = F.filter(F.array(*[visit(F.lit(e)) for e in range(repeats)]), lambda v: v["words"] > 0)
    return lined.withColumn("visits", visits).select(
        "key", "tie", "doc_id", "source", "size", "source_size", "target",
        F.aggregate("visits", F.lit(0).cast("long"), lambda total, v: total + v["words"]).alias("taken"), "visits",
    )


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The documents as they are trained on: all their columns, then epoch, taken and position.

    One row per visit, range-partitioned and sorted by position. Where ``docs`` has a column named
    epoch, taken or position, the new one gets underscores in front. ``options`` are those of ``mix``.
    """
    key, tie, epoch, taken, position = unused(docs, "key", "tie", "epoch", "taken", "position")
    visits = mix(docs, **options).select(F.col("key").alias(key), F.col("tie").alias(tie), F.explode("visits").alias("visit"))
    visits = visits.select(key, tie, F.col("visit.epoch").alias(epoch), F.col("visit.words").alias(taken), F.col("visit.position").alias(position))
    rows = docs.withColumn(key, row_key(docs, "source"))
    rows = rows.withColumn(tie, F.row_number().over(Window.partitionBy(key).orderBy("doc_id")))
    ordered = rows.join(visits, [key, tie]).drop(key, tie)
    return ordered.repartitionByRange(F.col(position), F.col("doc_id")).sortWithinPartitions(position, "doc_id", epoch)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    first = F.round(F.element_at("visits", 1)["position"], 6)
    rows = mixed.select("doc_id", "source", "size", "source_size", "target", "taken", F.when(F.size("visits") > 0, first).alias("position"))
    return rows.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


OP1_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS name FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
         [[1.5, 1.0, 0.5], [0.5, 1.0, 1.5], [0.75, 1.25, 0.75]][rank % 3 + 1]::DOUBLE[] AS f FROM ranked),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT source, source_size, f, least(cap, weight * max(level) OVER ()) AS target FROM levels),
lined AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.f,
         (sum(size) OVER (PARTITION BY s.source ORDER BY name, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, greatest(0, least(size, round(target)::BIGINT - start)) AS first,
         greatest(0, least(size, round(target)::BIGINT - start - source_size)) AS second,
         start / target * ((f[1] + f[2]) / 4 + (f[2] + f[3]) / 4) AS done FROM lined)
SELECT doc_id, source, size, source_size, target, first + second AS taken,
       CASE WHEN first > 0 THEN round(CASE WHEN done <= (f[1] + f[2]) / 4
         THEN 2 * done / (f[1] + sqrt(greatest(0, f[1] * f[1] + 4 * (f[2] - f[1]) * done)))
         ELSE 0.5 + 2 * (done - (f[1] + f[2]) / 4) / (f[2] + sqrt(greatest(0, f[2] * f[2] + 4 * (f[3] - f[2]) * (done - (f[1] + f[2]) / 4)))) END, 6) END AS position
FROM taken
"""
