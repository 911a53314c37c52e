from brickyard.operators import metrics
from brickyard.plans.sales_star import SalesStar


def test_published_views_answer_sql(spark, sf_small):
    star = SalesStar(spark, sf_small)
    names = star.publish()
    assert {"fact_orders", "dim_product", "dim_date", "bridge_components"} <= set(names)
    sql = spark.sql("""
        SELECT d.product_category, count(DISTINCT f.order_id) AS n_orders
        FROM fact_orders f JOIN dim_product d ON f.product_sk = d.product_sk
        GROUP BY d.product_category""")
    got = {r.product_category: r.n_orders for r in sql.collect()}
    want = {r.product_category: r.n_orders
            for r in metrics.avg_order_value(star.fact_orders(), star.dim_product).collect()}
    assert got == want
