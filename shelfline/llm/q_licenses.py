"""Query of the license scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .licenses import COVERAGE, K, K_TEXT, MERGE_GAP, scan_licenses, template_rows


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["phrase"])
    firsts = F.transform(base, lambda s: s["first"].cast("bigint"))

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score",
    )


def _gram(k: int) -> str:
    """k words from a place on, as SQL."""
    return " || ' ' || ".join(["w", *(f"w{j}" for j in range(1, k))])


_TEMPLATES = ",\n  ".join(f"({t}, '{label}', {phrase}, {k}, '{' '.join(gram)}', {at}, {grams}, {most})" for t, label, phrase, k, gram, at, grams, most in template_rows())
#: The same by definition, with every k-gram of every text compared as text.
_SQL = rf"""WITH templates(t, label, phrase, k, gram, tpos, grams, most) AS (VALUES
  {_TEMPLATES}),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
places AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS pos FROM docs),
runs_of AS (SELECT doc_id, pos, w, {", ".join(f"lead(w, {j}) OVER p AS w{j}" for j in range(1, K_TEXT))} FROM places WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
grams AS (
  {" UNION ALL ".join(f"SELECT doc_id, pos, {k} AS k, {_gram(k)} AS gram FROM runs_of WHERE w{k - 1} IS NOT NULL" for k in sorted({K, K_TEXT}))}),
votes AS (SELECT doc_id, t, label, phrase, k, grams, most, tpos, pos, pos - tpos AS diag FROM grams JOIN templates USING (k, gram)),
diagonals AS (
  SELECT doc_id, t, diag, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diag) AS run FROM (
    SELECT doc_id, t, diag, CASE WHEN phrase OR diag - lag(diag) OVER (PARTITION BY doc_id, t ORDER BY diag) > {MERGE_GAP} THEN 1 ELSE 0 END AS fresh
    FROM (SELECT DISTINCT doc_id, t, phrase, diag FROM votes))),
runs AS (SELECT *, max(diag) OVER (PARTITION BY doc_id, t, run) - min(diag) OVER (PARTITION BY doc_id, t, run) AS width FROM diagonals),
placed AS (SELECT v.*, run, CASE WHEN width > most THEN diag END AS alone FROM votes v JOIN runs r USING (doc_id, t, diag)),
ordered AS (
  SELECT *, tpos > coalesce(max(tpos) OVER (PARTITION BY doc_id, t, run, alone ORDER BY pos, tpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS counts
  FROM placed),
judged AS (
  SELECT doc_id, label, phrase, min(pos) AS first, count(*) FILTER (counts)::DOUBLE / grams AS share
  FROM ordered GROUP BY doc_id, t, label, phrase, grams, run, alone),
spans AS (SELECT * FROM judged WHERE share = 1 OR (NOT phrase AND share >= {COVERAGE})),
found AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (doc_id)"""

QUERIES = {"op5_license_scan": op5_license_scan}
ORACLES: dict[str, str] = {"op5_license_scan": _SQL}
