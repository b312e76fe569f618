-- Mean and both standard deviations of the population over a closed range of years.
SELECT
  count(*)                AS year_count,
  min(year)               AS start_year,
  max(year)               AS end_year,
  avg(population)         AS mean_population,
  stddev_pop(population)  AS stddev_population,
  stddev_samp(population) AS stddev_sample
FROM silver_population
WHERE year >= :first_year AND year <= :last_year
