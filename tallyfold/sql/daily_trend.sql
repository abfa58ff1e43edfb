SELECT date, IF(coalesce(startswith(environment_type, 'PROD'), false), 'PROD', 'NON-PROD') AS environment_type, daily_cost
FROM IDENTIFIER(:table)
WHERE date BETWEEN :fy_start AND :cutoff
  AND (:cto IS NULL OR cto = :cto)
