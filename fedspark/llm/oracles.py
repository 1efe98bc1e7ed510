"""SQL for the rows of those corpus queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from .url_filters import LOWER, TWO_LABEL_SUFFIXES, UPPER

_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _strength(level: str, name: str) -> str:
    """Mean and prior strength of a level's groups, by moments."""
    return f"""{name}_sums AS (SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, CAST(count(*) AS DOUBLE) AS k, CAST(sum(n * n) AS DOUBLE) AS nn, sum(CAST(bad AS DOUBLE) * bad / n) AS bb FROM {level}),
{name}_share AS (SELECT *, bad / n AS mean, n - nn / n - (k - 1) AS room, bb - n * (bad / n) * (bad / n) AS spread FROM {name}_sums),
{name} AS (SELECT coalesce(mean, 0.0) AS mean, CASE WHEN n IS NULL OR mean IN (0.0, 1.0) OR room <= 0 THEN 1000.0e0
    WHEN (spread / (mean * (1 - mean)) - (k - 1)) / room <= 0 THEN 1000.0e0
    ELSE least(1000.0e0, greatest(1.0e0, 1 / ((spread / (mean * (1 - mean)) - (k - 1)) / room) - 1)) END AS s FROM {name}_share)"""


URL_FILTERS = f"""
WITH parsed AS (SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
cut AS (SELECT *, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS two, regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS three FROM parsed),
seen AS (SELECT page_id, host, path, CASE WHEN two IN ({_TWO}) THEN two ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix,
    CASE WHEN two IN ({_TWO}) THEN CASE WHEN three <> '' THEN three ELSE host END WHEN two <> '' THEN two ELSE host END AS domain FROM cut),
labelled AS (SELECT doc_id, max(greatest(1 - quality, toxic)) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, domain, suffix, count(*) AS n, sum(bad) AS bad FROM seen JOIN labelled ON page_id = doc_id GROUP BY host, domain, suffix),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
{_strength("suffixes", "l1")},
{_strength("domains", "l2")},
{_strength("hosts", "l3")},
a AS (SELECT suffix, (bad + l1.mean * l1.s) / (x.n + l1.s) AS m, x.n + l1.s + 1 AS w FROM suffixes x, l1),
b AS (SELECT x.suffix, domain, (bad + a.m * l2.s) / (x.n + l2.s) AS m, x.n + l2.s + 1 AS w FROM domains x JOIN a ON x.suffix = a.suffix, l2),
c AS (SELECT host, (bad + b.m * l3.s) / (x.n + l3.s) AS m, x.n + l3.s + 1 AS w FROM hosts x JOIN b ON x.domain = b.domain, l3),
judged AS (SELECT page_id, seen.host, path, coalesce(c.m - 1.645 * sqrt(c.m * (1 - c.m) / c.w) > 0.5, b.m - 1.645 * sqrt(b.m * (1 - b.m) / b.w) > 0.5, a.m - 1.645 * sqrt(a.m * (1 - a.m) / a.w) > 0.5, false) AS bad
    FROM seen LEFT JOIN c ON seen.host = c.host LEFT JOIN b ON seen.domain = b.domain LEFT JOIN a ON seen.suffix = a.suffix),
ruled AS (SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM judged)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bad THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
