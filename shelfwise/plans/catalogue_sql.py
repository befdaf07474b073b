"""SQL twins of the feature tables, as common table expressions."""

from __future__ import annotations

from shelfwise.plans.catalogue import (
    CAT_FLAGS, FLOP_MAX, GENRE_FLAGS, HIT_MIN, METADATA_SQL, PANEL_SQL, TAG_FLAGS, TAGS_SQL, TEXT_SQL,
)


def _tier(n: str) -> str:
    return f"CASE WHEN {n} >= 10 THEN 'AAA' WHEN {n} >= 3 THEN 'Establecido' ELSE 'Novato' END"


RAW = f"meta AS ({METADATA_SQL}), tags AS ({TAGS_SQL}), txt AS ({TEXT_SQL}), panel AS ({PANEL_SQL})"
LABEL = f"CASE WHEN owners_lower_bound >= {HIT_MIN} THEN 2 WHEN owners_lower_bound >= {FLOP_MAX} THEN 1 ELSE 0 END"
COLLAPSED = """
SELECT appid, CAST(sum(review_count) AS BIGINT) AS ts_total_reviews, CAST(sum(positive_count) AS BIGINT) AS ts_positive,
  CAST(sum(negative_count) AS BIGINT) AS ts_negative, CAST(sum(steam_purchase_count) AS BIGINT) AS ts_steam_purchase,
  CAST(sum(early_access_count) AS BIGINT) AS ts_early_access,
  count(*) FILTER (WHERE review_count > 0) AS ts_months_active,
  round_even(CAST(sum(CAST(avg_playtime_at_review_hrs AS DECIMAL(28,10))) AS DOUBLE) / count(*), 2) AS ts_avg_playtime_hrs,
  CASE WHEN sum(positive_count) + sum(negative_count) > 0
    THEN round_even(CAST(sum(positive_count) AS DOUBLE) / (sum(positive_count) + sum(negative_count)), 3) ELSE 0.0 END
    AS ts_positive_ratio
FROM panel GROUP BY appid"""

ENRICHED = f"""{RAW},
devs AS (SELECT developer, CAST(count(*) AS INTEGER) AS dev_game_count FROM meta GROUP BY 1),
pubs AS (SELECT publisher, CAST(count(*) AS INTEGER) AS pub_game_count FROM meta GROUP BY 1),
enriched AS (SELECT m.* EXCLUDE (price), CASE WHEN price > 200 THEN 200.0 ELSE price END AS price,
  dev_game_count, {_tier('dev_game_count')} AS dev_experience, pub_game_count, {_tier('pub_game_count')} AS pub_experience,
  CAST(year(CAST(release_date AS DATE)) AS INTEGER) AS release_year,
  CAST(month(CAST(release_date AS DATE)) AS INTEGER) AS release_month,
  'Q' || CAST(quarter(CAST(release_date AS DATE)) AS VARCHAR) AS release_quarter,
  CASE WHEN is_free = 1 OR price <= 0 THEN 'F2P' WHEN price < 10 THEN 'Budget' WHEN price < 20 THEN 'Mid'
    ELSE 'Premium' END AS price_tier,
  CAST(coalesce(length(short_description), 0) AS INTEGER) AS short_desc_len,
  t.* EXCLUDE (appid),
  {' + '.join(GENRE_FLAGS)} AS num_genres, {' + '.join(TAG_FLAGS)} AS num_tags, {' + '.join(CAT_FLAGS)} AS num_categories,
  CAST(genre_early_access > 0 AS INTEGER) AS is_early_access
  FROM meta m JOIN tags t USING (appid) LEFT JOIN devs d ON m.developer = d.developer
  LEFT JOIN pubs p ON m.publisher = p.publisher LEFT JOIN txt x USING (appid))"""

MASTER = f"""{ENRICHED},
ts AS ({COLLAPSED}),
labelled AS (SELECT *, {LABEL} AS label FROM enriched WHERE owners_lower_bound > 0),
p0 AS (SELECT avg(CAST(label >= 1 AS INTEGER)) AS p FROM labelled),
dv AS (SELECT developer AS dvd, count(*) AS dvn, sum(CAST(label >= 1 AS INTEGER)) AS dvs FROM labelled GROUP BY 1),
master AS (SELECT l.*, ts.* EXCLUDE (appid),
  CASE label WHEN 2 THEN 'Hit' WHEN 1 THEN 'Rentable' ELSE 'Flop' END AS label_name,
  round_even((dvs - CAST(label >= 1 AS INTEGER) + p * 12.0) / (dvn - 1 + p * 12.0 + (1 - p) * 12.0), 4) AS dev_success_prior
  FROM labelled l JOIN dv ON l.developer = dvd LEFT JOIN ts USING (appid), p0)"""
