"""Queries over the web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import html_text, urls
from .catalog import query, table

# the rules as the contract states them, longest first, for one CASE
_FITS = """
WITH parts AS (
  SELECT page_id,
         translate(CASE WHEN strpos(url, '://') > 0
                        THEN regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*') ELSE '' END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(url, '://') > 0
              THEN regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES {rules}),
fits AS (
  SELECT page_id, host, path,
         (SELECT h || p || chr(9) || verdict FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
          ORDER BY length(h || p) DESC, verdict DESC, h || p DESC LIMIT 1) AS best
  FROM parts)
SELECT page_id, host, path, split_part(best, chr(9), 1) AS rule,
       CASE WHEN best IS NOT NULL THEN split_part(best, chr(9), 2)
            WHEN list_has_any(regexp_split_to_array(host, '[^\\p{{L}}\\p{{N}}]+'), [{words}]) THEN 'block'
            ELSE 'allow' END AS verdict
FROM fits"""


@query(
    _FITS.format(
        rules=", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES),
        words=", ".join(f"'{w}'" for w in urls.BLOCKED_WORDS),
    )
)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))
