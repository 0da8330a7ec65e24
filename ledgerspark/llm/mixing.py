"""Mixing sources to target weights: whole epochs first, then a weighted sample without replacement.

Each document draws an exponential key with its quality weight as rate (Efraimidis-Spirakis: the
smallest keys are a sample in which heavier documents come first). A source takes as many whole
epochs as its target allows; what is left of the target goes to its documents in key order until
their summed sizes reach it. The document on the edge gives its first words only.

Nothing sorts a whole source: keys are cut into buckets of bounded size, bucket sums tell the
bucket in which the target is reached, and only that bucket is sorted. What comes out is one
row per source, a plan, that decides about any document by its key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.operators.keyed import spread_join
from ledgerspark.session import written

#: Weights of the sources by their order, repeating; share of all words that the mix takes, in
#: halves; no source and no document is taken more often than MOST times.
WEIGHTS = (5, 2, 1)
HALVES, MOST = 3, 2
#: Documents per bucket of keys, at the mean.
BUCKET = 1_000
#: Quality weights are held between these. The bound keeps buckets small: none is expected to hold
#: more than HEAVIEST / LIGHTEST times the mean.
LIGHTEST, HEAVIEST = 0.25, 4.0

# Blanks are the space and the ASCII control characters from tab to carriage return.
_BLANK, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def n_words(text: str) -> Column:
    """Words of a text; 0 if it is null or blank."""
    marks = F.regexp_replace(text, f"{_BLANK}*+{_WORD}++{_BLANK}*+", "x")
    return F.when(F.col(text).rlike(_WORD), F.length(marks)).otherwise(0).cast("long")


def draw(id_col: str, text_col: str, seed: int) -> Column:
    """A number between 0 and 1 from a digest of id and whole text; the same in every run."""
    known = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return (F.conv(F.substring(F.md5(known), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def key(drawn: Column, weight: Column) -> Column:
    """An exponential key; an unknown or impossible weight counts as 1."""
    w = F.when(F.isnan(weight) | weight.isNull() | (weight <= 0), F.lit(1.0)).otherwise(weight.cast("double"))
    return -F.ln(drawn) / F.least(F.greatest(w, F.lit(LIGHTEST)), F.lit(HEAVIEST))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """``doc_id, source, size, drawn`` of every whole text; all that the plan needs."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), draw(id_col, text_col, seed).alias("drawn"))


def with_quality(light: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``weight`` from quality labels of 0 and 1: 0.5 to 2, and 1 where there is none.

    Rows without id have no label; they do not go through the join.
    """
    quality = labels.where("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    named = light.where("doc_id is not null").join(quality, "doc_id", "left").select(*light.columns, (F.lit(0.5) + F.lit(1.5) * F.col("quality")).alias("weight"))
    blank = light.where("doc_id is null").withColumn("weight", F.lit(None).cast("double"))
    return named.unionByName(blank).withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, by code point with null last, without bringing all sources together."""
    order = F.col("source").asc_nulls_last()
    parts = written(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, however many sources there are.
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_here")).select("part", F.coalesce(F.sum("n_here").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return parts.join(counts, "part").select(*sources.columns, (F.col("before") + place - 1).alias("rank"))


def targets(light: DataFrame, weights: tuple[int, ...] = WEIGHTS, halves: int = HALVES, most: int = MOST) -> DataFrame:
    """``source, n, source_size, target`` (words), one row per source.

    Sources share ``halves`` / 2 of all words by weight. None gets more than ``most`` times its
    size; the excess is shared again by weight among the others until none is above. Every
    round is one small aggregate and settles at least one more source.
    """
    if not halves <= 2 * most:
        raise ValueError("the share cannot exceed what the sources may give")
    known = light.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    known = written(_ranked(known).withColumn("share", weight))
    level, seen = 0.0, None
    while True:
        above = F.col("source_size") * most < F.lit(level) * F.col("share")
        capped, words, held, shares = known.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("share"))), F.lit(0))).first()
        if capped == seen or not shares:
            break
        level, seen = (halves * words - 2 * most * held) / (2 * shares), capped
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.lit(level) * F.col("share"))
    return known.select("source", "n", "source_size", target.alias("target"))


def _with_goals(light: DataFrame, goals: DataFrame, how_many: DataFrame) -> DataFrame:
    """Rows of documents with the row of their source; a source of very many rows is dealt to
    many tasks, by the counts in ``how_many``, and a null source is one like others."""
    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("of", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))

    counts = named(how_many).select("of", F.col("n").alias("_rows"))
    return spread_join(named(light), named(goals).drop("source"), ["of"], counts=counts, how="inner").drop("of")


def plan(light: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, n, source_size, target, copies, edge, rest, tied``, one row per source.

    Documents are taken ``copies`` times, those with a key below ``edge`` once more, and those on
    it share ``rest`` words in proportion to their sizes (``tied`` in all; equal rows have equal
    keys). ``light`` holds ``source, size, key``.
    """
    words = F.floor(F.col("target") + 0.5).cast("long")
    copies = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("copies", copies).withColumn("wanted", words - F.col("copies") * F.col("source_size"))
    goals = written(goals.withColumn("buckets", F.ceil(F.col("n") / BUCKET)))
    open_goals = goals.where("wanted > 0").select("source", "wanted", "buckets")
    spread = F.floor((F.lit(1.0) - F.exp(-F.col("key") * LIGHTEST)) * F.col("buckets"))
    rows = _with_goals(light.select("source", "size", "key"), open_goals, goals).select("source", "size", "key", "wanted", F.least(spread, F.col("buckets") - 1).alias("bucket"))

    def reached(sums: DataFrame, order: str) -> DataFrame:
        upto = F.sum("words").over(Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        return sums.withColumn("before", upto - F.col("words")).where((F.col("before") < F.col("wanted")) & (F.col("before") + F.col("words") >= F.col("wanted")))

    there = reached(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max("wanted").alias("wanted")), "bucket")
    there = there.select(F.col("source").alias("of"), F.col("bucket").alias("at"), (F.col("wanted") - F.col("before")).alias("left"))
    inside = rows.join(there, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))).groupBy("source", "key").agg(F.sum("size").alias("words"), F.max("left").alias("wanted"))
    edges = reached(inside, "key").select(F.col("source").alias("of"), F.col("key").alias("edge"), (F.col("wanted") - F.col("before")).alias("rest"), F.col("words").alias("tied"))
    return written(goals.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "n", "source_size", "target", "copies", "edge", "rest", "tied"))


def _extra() -> Column:
    """Words beyond the whole copies, from a row's key and its source's plan."""
    number = "decimal(19,0)"
    part = F.expr(f"cast(cast(size as {number}) * cast(rest as {number}) div tied as long)")
    return F.when(F.col("key") < F.col("edge"), F.col("size")).when(F.col("key") == F.col("edge"), part).otherwise(0)


def taken(light: DataFrame, planned: DataFrame) -> DataFrame:
    """Adds ``source_size, target, copies, extra, taken`` to rows of ``source, size, key``."""
    joined = _with_goals(light, planned.drop("n"), planned).withColumn("extra", _extra())
    return joined.withColumn("taken", F.col("copies") * F.col("size") + F.col("extra")).select(*light.columns, "source_size", "target", "copies", "extra", "taken")


def mixture(docs: DataFrame, planned: DataFrame, weight: Column, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: the rows of ``docs`` once per epoch that takes them, with ``epoch`` from 1.

    Texts meet the plan's one row per source and nothing else; the text of a document on the
    edge is cut after the last word that is taken.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    facts = docs.select(row.alias("row"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), key(draw(id_col, text_col, seed), weight).alias("key"))
    goals = planned.withColumnRenamed("source", "of").select("of", "copies", "edge", "rest", "tied")
    rows = facts.join(goals, F.col("source").eqNullSafe(F.col("of"))).withColumn("extra", _extra())
    again = F.col("copies") + F.when(F.col("extra") > 0, 1).otherwise(0)
    rows = rows.where("size > 0").select("row", "size", "copies", "extra", F.explode(F.when(again > 0, F.sequence(F.lit(1).cast("long"), again))).alias("epoch"))
    text = F.col(f"row.`{text_col}`")
    cut = F.array_join(F.slice(F.split(text, f"(?<={_WORD})(?={_BLANK})"), F.lit(1), F.col("extra").cast("int")), "")
    partly = (F.col("epoch") > F.col("copies")) & (F.col("extra") < F.col("size"))
    return rows.select(*[F.when(partly, cut).otherwise(text).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.col("epoch").cast("int").alias("epoch"))


def mixed(docs: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document with what the mix takes of it.

    A null or blank text has no words and gives none; null ids and null sources (a source of
    their own, the last) take part like others; repeated rows are documents of their own and
    give equal parts; other columns and their names do not matter. The result depends on the
    rows alone, never on how they are dealt to tasks. A text of any length is counted whole;
    a document may give part of its words where the target is reached. An empty table gives an
    empty table.
    """
    light = with_quality(written(measured(docs, seed=seed)), labels)
    light = written(light.select("doc_id", "source", "size", key(F.col("drawn"), F.col("weight")).alias("key")))
    return taken(light, plan(light, targets(light)))


MIXING_SQL = r"""
WITH quality AS (SELECT doc_id, avg(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.text, '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496) / coalesce(0.5 + 1.5 * q, 1.0) AS key
  FROM documents d LEFT JOIN quality USING (doc_id)),
sources AS (
  SELECT source, sum(size) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS share
  FROM docs GROUP BY source),
filled AS (
  SELECT *, (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY source_size / share, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (2 * sum(share) OVER (ORDER BY source_size / share, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level,
         row_number() OVER (ORDER BY source_size / share, source NULLS LAST) AS place
  FROM sources),
goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, share * (SELECT level FROM filled WHERE level * share <= 2 * source_size ORDER BY place LIMIT 1)) AS target
  FROM filled),
wanted AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END AS BIGINT) AS copies FROM goals),
summed AS (
  SELECT d.doc_id, d.source, d.size, d.key, w.source_size, w.target, w.copies,
         CAST(floor(w.target + 0.5) AS BIGINT) - w.copies * w.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) - sum(d.size) OVER (PARTITION BY d.source, d.key) AS before,
         sum(d.size) OVER (PARTITION BY d.source, d.key) AS tied
  FROM docs d JOIN wanted w ON d.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(copies * size + CASE WHEN before + tied < rest THEN size WHEN before >= rest THEN 0
            ELSE size * (rest - before) // tied END AS BIGINT) AS taken
FROM summed
"""
