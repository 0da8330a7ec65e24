"""Removal of lines that spread over many sites.

Every distinct line gets a HyperLogLog sketch of the sites it stands on, merged by aggregation.
Lines whose estimate is near the threshold get an exact distinct count. A line on enough sites is
boilerplate: it stays in the document with the smallest id that holds it and is removed
elsewhere, so no content leaves the corpus entirely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.session import written

#: Distinct sites from which a line is boilerplate.
SITES = 10
#: log2 of the sketch's registers: relative standard error 1.04 / sqrt(2 ** 12) = 1.6 %.
REGISTERS = 12
#: Estimates within so many standard errors (and one site at least) of the threshold are checked.
ERRORS = 5


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _content(text: Column) -> Column:
    """A number of the whole text: rows of one id, or without id, may have different texts."""
    return F.struct(F.xxhash64(text).alias("hash"), F.hash(text).alias("hash2"), F.length(text).alias("size"))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per line with something in it; equal lines, but for outer blanks, have equal keys."""
    at = docs.select(F.col(id_col).alias("id"), _content(F.col(text_col)).alias("content"), F.col(site_col).alias("site"), F.posexplode(_split(F.col(text_col))).alias("pos", "line"))
    line = F.trim("line")
    return at.where(line != "").select("id", "content", "site", "pos", F.xxhash64(line).alias("key"), F.hash(line).alias("key2"))


def spread_lines(docs: DataFrame, min_sites: int = SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Keys of the lines on at least ``min_sites`` sites, with the id that keeps each.

    A null site is no site; a line without any is never boilerplate.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    keys = ["key", "key2"]
    sketched = written(
        lines.groupBy(*keys).agg(F.hll_sketch_agg("site", REGISTERS).alias("sketch"), F.min("id").alias("keeper"))
        .select(*keys, "keeper", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") > min_sites / 2))
    band = max(1.0, ERRORS * 1.04 / 2 ** (REGISTERS / 2) * min_sites)
    sure = sketched.where(F.col("sites") > min_sites + band).select(*keys, "keeper")
    near = sketched.where(F.abs(F.col("sites") - min_sites) <= band).select(*keys, "keeper")
    # Repeats of a line on a site are merged in each task before anything is shuffled.
    exact = lines.select(*keys, "site").join(near, keys).groupBy(*keys, "keeper", "site").agg(F.count(F.lit(1)).alias("n"))
    checked = exact.groupBy(*keys, "keeper").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites).select(*keys, "keeper")
    return sure.unionByName(checked)


def without_spread_lines(docs: DataFrame, min_sites: int = SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", counts: tuple[str, str] = ("n_lines", "removed_lines")) -> DataFrame:
    """``docs`` with the text freed of boilerplate, and two counts: its lines, and those removed.

    Columns of ``docs`` that are named like the counts give way to them; any other name may occur.
    Every row comes back once; other columns are untouched. A null text stays null with 0 lines;
    blank lines stay; repeated rows lose the same lines, different texts of one id (or of none)
    each their own; a null id keeps nothing for itself (its lines are removed if they are
    boilerplate and another document holds them).
    """
    spread = written(spread_lines(docs, min_sites, id_col, text_col, site_col))
    lines = _lines(docs, id_col, text_col, site_col)
    hits = (lines.join(spread, ["key", "key2"]).where(F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("id")))
            .groupBy("id", "content").agg(F.collect_set("pos").alias("__hits")).select(F.col("id").alias("__id"), F.col("content").alias("__content"), "__hits"))
    joined = docs.join(hits, docs[id_col].eqNullSafe(F.col("__id")) & (_content(docs[text_col]) == F.col("__content")), "left")
    split, drop = _split(F.col(text_col)), F.coalesce("__hits", F.array().cast("array<int>"))
    kept = F.concat_ws("\n", F.filter(split, lambda line, i: ~F.array_contains(F.col("__hits"), i)))
    text = F.when(F.col(text_col).isNull() | F.col("__hits").isNull(), F.col(text_col)).otherwise(kept)
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split))
    return joined.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns if c not in counts], n.alias(counts[0]), F.size(drop).alias(counts[1]))


#: DuckDB SQL for the query over documents.
LINE_DEDUP_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
spread AS (
  SELECT trim(line, ' ') AS line, min(doc_id) AS keeper FROM lines WHERE trim(line, ' ') <> ''
  GROUP BY 1 HAVING count(DISTINCT source) >= {SITES}),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(s.line) AS removed_lines,
         string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (s.line IS NULL) AS text
  FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.line AND l.doc_id <> s.keeper GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE k.n_lines END AS n_lines, k.removed_lines,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d JOIN kept k USING (doc_id)"""
