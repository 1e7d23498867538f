"""Lines that spread over many sites: HyperLogLog sketches per line, exact counts near the threshold, removal.

Every step is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.session import stage

SITES = 5  # distinct sites from which a line is boilerplate
PRECISION = 12  # of the sketches: 1.6 % standard error
NEAR = 0.1  # estimates this near to the threshold, and at least one off, are counted exactly
BREAK = "\n"


def _lines(docs: DataFrame) -> DataFrame:
    """One row per distinct non-blank line of a row: rid, site, line (hash)."""
    lines = F.array_distinct(F.transform(F.filter(F.split("text", BREAK), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    return docs.select("rid", "site", F.explode(lines).alias("line"))


def spread_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """Hashes of the lines that occur at ``sites`` or more sites (``line, site`` hashes), decided exactly."""
    margin = max(1.0, NEAR * sites)
    sketched = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", PRECISION)).alias("seen"))
    sketched = stage(sketched.where(F.col("seen") >= sites - margin), "line-sites")
    sure = sketched.where(F.col("seen") > sites + margin).select("line")
    near = sketched.where(F.col("seen") <= sites + margin).select("line")
    counted = lines.select("line", "site").distinct().join(near, "line").groupBy("line").agg(F.count("*").alias("n"))
    return sure.unionByName(counted.where(F.col("n") >= sites).select("line"))


def remove_boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept``: every text without lines that occur at ``sites`` or more sites.

    ``docs`` needs ``doc_id, source, text``; the source is the site, a null source a site of its own; other columns are
    ignored. Lines end at line feeds and count as equal only if equal to the byte; blank lines are never removed. Kept
    lines are joined by line feeds. A null text counts as empty; an empty text has one empty line. Repeated rows
    are treated alike. Without rows the result is empty.
    """
    site = F.coalesce(F.xxhash64("source"), F.lit(0))
    site = F.when(F.col("source").isNull(), F.lit(-1)).otherwise(site)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), site.alias("site"), F.xxhash64("doc_id", "text", "source").alias("rid"))
    lines = stage(_lines(rows), "lines")
    spread = stage(spread_lines(lines.select("line", "site"), sites), "line-spread")
    # Hits per document: at most its own lines. Rows equal in all three columns share a rid and their hits.
    hits = lines.select("rid", "line").distinct().join(spread, "line").groupBy("rid").agg(F.collect_list("line").alias("hits"))
    # Hits grow with the documents, so both sides are dealt by row at every size.
    joined = rows.select("doc_id", "rid", "text").join(stage(hits, "line-hits").hint("merge"), "rid", "left")
    split = F.split("text", BREAK)
    kept = F.when(F.col("hits").isNull(), split).otherwise(F.filter(split, lambda x: ~F.array_contains("hits", F.xxhash64(x)) | (F.trim(x) == "")))
    joined = joined.select("doc_id", F.size(split).cast("long").alias("n_lines"), kept.alias("kept"))
    return joined.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"), F.array_join("kept", BREAK).alias("kept"))


OP6_SQL = f"""
WITH split AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
spread AS (
  SELECT line FROM split WHERE trim(line, ' ') <> '' GROUP BY line
  HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= {SITES})
SELECT s.doc_id, count(*) AS n_lines, count(b.line) AS n_removed,
       sha256(coalesce(string_agg(s.line, chr(10) ORDER BY s.place) FILTER (WHERE b.line IS NULL), '')) AS kept_sha256
FROM split s LEFT JOIN spread b ON s.line = b.line GROUP BY s.doc_id"""


@query("op6_line_spread", OP6_SQL)
def op6(spark, sf_dir):
    found = remove_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
