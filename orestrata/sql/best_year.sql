-- Best year per series. Written unlike the DataFrame form on purpose (ids by UNION, the winner by
-- max_by) so that the two check each other.
WITH yearly AS (
  SELECT series_id, year, sum(value) AS total, count(value) AS n
  FROM silver_observations
  WHERE period IN (:q1, :q2, :q3, :q4)
  GROUP BY series_id, year
),
winner AS (
  SELECT series_id, max_by(named_struct('year', year, 'total', total, 'n', n), struct(total, -year)) AS w
  FROM yearly
  WHERE n > 0
  GROUP BY series_id
),
ids AS (
  SELECT series_id FROM silver_series
  UNION
  SELECT series_id FROM silver_observations
)
SELECT
  ids.series_id,
  d.series_label,
  winner.w.year  AS best_year,
  winner.w.total AS summed_value,
  winner.w.n     AS quarters_available,
  if(winner.w.year IS NULL, 'no_quarterly_observations', 'ok') AS status
FROM ids
LEFT JOIN winner          ON winner.series_id = ids.series_id
LEFT JOIN silver_series d ON d.series_id = ids.series_id
