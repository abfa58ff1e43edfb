SELECT IF(environment <=> 'PROD', 'PROD', 'NON-PROD') AS environment_type, CAST(sum(cost) AS DOUBLE) AS total_cost
FROM IDENTIFIER(:table)
WHERE date BETWEEN :fy_start AND :fy_end
  AND (:cto IS NULL OR cto = :cto)
  AND (:pillar IS NULL OR tr_product_pillar_team = :pillar)
  AND (:product IS NULL OR tr_product_id = :product)
GROUP BY ALL
