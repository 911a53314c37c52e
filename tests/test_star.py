import datetime as dt

from brickyard.operators import quality as Q
from brickyard.operators.explode import split_explode
from brickyard.operators.star import bridge, distinct_dim, product_dim
from brickyard.sources.seed import size_labels

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
AUD = "src_sys string, src_crt_ts timestamp_ntz, src_upd_ts timestamp_ntz"


def _items(spark):
    return spark.createDataFrame([("p1", "t1", "M", 12.5, "s", T1, T1), ("p2", "t2", "XS", None, "s", T1, T1),
                                  ("p3", "t9", "S", 9.0, "s", T1, T1)],
                                 f"product_id string, product_type_id string, size_code string, price double, {AUD}")


def _types(spark):
    return spark.createDataFrame([("t1", "One", "Classic", "a,b,c"), ("t2", "Two", "Veggie", None)],
                                 "product_type_id string, product_name string, product_category string, "
                                 "component_list string")


def test_product_dim_semantics(spark):
    dim = {r.product_id: r for r in product_dim(_items(spark), _types(spark), size_labels(spark),
                                                run_ts="2024-01-05 00:00:00").collect()}
    assert dim["p1"].size_label == "Medium" and dim["p1"].component_count == 3 and dim["p1"].price_tier == "Standard"
    assert dim["p2"].size_label is None and dim["p2"].price_tier == "Luxury"      # unmatched code, null price
    assert dim["p2"].component_count is None
    assert dim["p3"].product_name is None and dim["p3"].price_tier == "Budget"     # type missing: left join keeps it
    assert dim["p1"].src_crt_ts == T1 and dim["p1"].crt_ts == dt.datetime(2024, 1, 5)
    df = product_dim(_items(spark), _types(spark), size_labels(spark))
    labels = ["Small", "Medium", "Large", "X-Large", "XX-Large"]
    assert Q.check_accepted_values(df, "size_label", labels).count() == 0        # null label passes silently


def _components(spark, rows):
    df = spark.createDataFrame(rows, f"product_type_id string, component_list string, {AUD}")
    return split_explode(df, "component_list", ",", "component", "component_position")


def test_distinct_dim_keeps_one_row_per_load_time(spark):
    comp = _components(spark, [("t1", "a, b", "s", T1, T1), ("t2", "a", "s", T2, T2)])
    dim = distinct_dim(comp, "component", "component_sk").collect()
    a_rows = [r for r in dim if r.component == "a"]
    assert len(a_rows) == 2 and len({r.component_sk for r in a_rows}) == 1


def test_bridge_strict_and_value_from_dimension(spark):
    comp = _components(spark, [("t1", "a, b", "s", T1, T1), ("t2", "a", "s", T1, T1)])
    dim = distinct_dim(comp, "component", "component_sk")
    loose = bridge(comp, dim).collect()
    assert len(loose) == 3 and {r.component for r in loose} == {"a", "b"}
    parent = spark.createDataFrame([("t1",)], "product_type_id string")
    strict = bridge(comp, dim, parent=parent, strict=True).collect()
    assert {r.product_type_id for r in strict} == {"t1"} and len(strict) == 2
    assert [r.component_position for r in sorted(strict, key=lambda r: r.component_position)] == [1, 2]
