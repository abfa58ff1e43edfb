WITH totals AS (
SELECT cto AS cto_org,
  sum(IF(environment <=> 'PROD', cost, 0)) AS prod,
  sum(IF(environment <=> 'NON-PROD', cost, 0)) AS nonprod,
  sum(cost) AS total
FROM IDENTIFIER(:table)
WHERE date BETWEEN :fy_start AND :cutoff
  AND (:cto IS NULL OR cto = :cto)
  AND (:pillar IS NULL OR tr_product_pillar_team = :pillar)
  AND (:product IS NULL OR tr_product_id = :product)
GROUP BY ALL
)
SELECT cto_org,
  CAST(prod AS DOUBLE) AS prod_ytd_cost,
  CAST(nonprod AS DOUBLE) AS nonprod_ytd_cost,
  CAST(total AS DOUBLE) AS total_ytd_cost,
  CAST(total AS DOUBLE) * 365 / nullif(datediff(:cutoff, :fy_start), 0) AS forecasted_cost,
  CAST(nonprod AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) * 100 AS nonprod_percentage
FROM totals
ORDER BY total_ytd_cost DESC, cto_org
LIMIT :top_n
