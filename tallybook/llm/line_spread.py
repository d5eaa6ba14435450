"""Operator 9: cross-site boilerplate lines, found by distinct-site sketches.

A line is a piece of a text between newlines. Each line's sites (values of `source`) go into a
HyperLogLog sketch, which partial aggregation merges before and after one shuffle on the line's
128-bit hash. A line whose estimate is clear of the threshold is decided by the sketch; lines near
it are counted exactly. Lines on `min_sites` sites or more are boilerplate: every occurrence goes
but the first, by doc_id and place in the text.

Defined cases: a null text has no lines and stays null; an empty text is one empty line; a null
source is no site; rows that repeat a doc_id and text count as one document and are treated alike;
a null doc_id sorts before all others; a text of which nothing is left becomes empty; of equal lines the one with the
smallest id, then row hash, then place is the first; a long text is as many rows as it has lines; an empty table gives an empty one;
rows are never dropped; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import fresh, pick, table

MIN_SITES = 5
LOG_SKETCH = 12
#: Four standard errors of a sketch with 2^12 registers.
BAND = 4 * 1.04 / 2 ** (LOG_SKETCH / 2)

ROW_HASH = "xxhash64(`doc_id`, `text`)"


def lines_of(docs: DataFrame) -> DataFrame:
    """A row for each line: where it stands, its site and two independent 64-bit hashes."""
    return docs.selectExpr(
        "doc_id AS d", f"{ROW_HASH} AS r", "source AS site", "posexplode(split(text, '\n')) AS (pos, line)"
    ).selectExpr("d", "r", "site", "pos", "xxhash64(line) AS h1", "xxhash64('line', line) AS h2")


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2 and first occurrence of the lines on min_sites sites or more."""
    lines = lines_of(pick(docs, "doc_id", "text", "source"))
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_SKETCH)).alias("sites"),
        F.min(F.struct("d", "r", "pos")).alias("first"),
    )
    low, high = min_sites * (1 - BAND) - 0.5, min_sites * (1 + BAND) + 0.5
    wide = spread.where(F.col("sites") >= low)
    sure = wide.where(F.col("sites") > high).select("h1", "h2", "first")
    near = wide.where(F.col("sites") <= high).select("h1", "h2", "first")
    exact = (
        lines.select("h1", "h2", "site")
        .join(near, ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return sure.unionByName(near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi"))


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The places of the lines that go, one row per document that loses any."""
    hits = lines_of(pick(docs, "doc_id", "text", "source")).join(boilerplate(docs, min_sites), ["h1", "h2"])
    later = ~F.struct("d", "r", "pos").eqNullSafe(F.col("first"))
    return hits.where(later).groupBy("d", "r").agg(F.collect_set("pos").alias("gone"))


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, counts: bool = False) -> DataFrame:
    """The documents without boilerplate lines; with `counts`, also n_lines and n_removed (long)."""
    names = docs.columns
    row, gone, d, r = (fresh(names, n) for n in ("row_hash", "gone", "gone_id", "gone_row"))
    removed = removed_lines(docs, min_sites).select(
        F.col("d").alias(d), F.col("r").alias(r), F.col("gone").alias(gone)
    )
    joined = docs.withColumn(row, F.expr(ROW_HASH)).join(
        removed, F.expr(f"`{row}` = `{r}` AND doc_id <=> `{d}`"), "left"
    )
    left = F.expr(
        f"if(`{gone}` IS NULL, text, array_join(filter(split(text, '\n'),"
        f" (x, i) -> NOT array_contains(`{gone}`, i)), '\n'))"
    )
    extra = []
    if counts:
        extra = [
            F.expr("CAST(coalesce(size(split(text, '\n')), 0) AS LONG) AS n_lines").alias("n_lines"),
            F.expr(f"CAST(if(`{gone}` IS NULL, 0, size(`{gone}`)) AS LONG)").alias("n_removed"),
        ]
        names = [n for n in names if n.lower() not in ("n_lines", "n_removed")]
    kept = [left.alias(n) if n == "text" else F.col(f"`{n}`") for n in names]
    return joined.select(*kept, *extra)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: lines, lines removed, and the digest of the text that is left."""
    docs = drop_boilerplate(table(spark, sf_dir, "documents"), counts=True)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return docs.select("doc_id", "n_lines", "n_removed", digest)


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT line, min(struct_pack(d := doc_id, p := pos)) AS f FROM l
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), k AS (
  SELECT l.doc_id, count(*) AS n_lines,
         count(*) FILTER (b.line IS NOT NULL AND NOT (b.f.d = l.doc_id AND b.f.p = l.pos)) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.pos)
           FILTER (b.line IS NULL OR (b.f.d = l.doc_id AND b.f.p = l.pos)) AS kept
  FROM l LEFT JOIN b ON l.line = b.line GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
