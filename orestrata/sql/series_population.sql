-- One series at one period of the year beside the population of the same year, NULL if unknown.
SELECT points.series_id, year, points.period, points.value, p.population
FROM (
  SELECT series_id, year, period, value
  FROM silver_observations
  WHERE period = :period AND series_id = :series
) points
LEFT JOIN silver_population p USING (year)
