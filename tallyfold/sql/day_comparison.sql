SELECT IF(environment <=> 'PROD', 'PROD', 'NON-PROD') AS environment_type,
  CAST(sum(IF(date BETWEEN :current_start AND :current_end, cost, 0)) AS DOUBLE) AS day_current_cost,
  CAST(sum(IF(date BETWEEN :previous_start AND :previous_end, cost, 0)) AS DOUBLE) AS day_previous_cost
FROM IDENTIFIER(:table)
WHERE (date BETWEEN :current_start AND :current_end OR date BETWEEN :previous_start AND :previous_end)
  AND (:cto IS NULL OR cto = :cto)
  AND (:pillar IS NULL OR tr_product_pillar_team = :pillar)
  AND (:product IS NULL OR tr_product_id = :product)
GROUP BY ALL
