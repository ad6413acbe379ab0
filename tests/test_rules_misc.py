import pytest
from pyspark.sql import types as T

from objectlake import Catalog, ObjectQuery, QueryError, fld
from objectlake.functions import count_
from objectlake.functions.timefilter import validate_scan_options
from objectlake.schema import compatibility, schema_for, spark_type, unsupported_fields
from objectlake.streaming.changes import stream_query_fields


@pytest.fixture(scope="module")
def lead_cat(spark):
    cat = Catalog(spark)
    df = spark.createDataFrame(
        [(1, "a", "1 Main St", "x", "grp", "ord", 3, "long text")],
        "Id long, Name string, Address string, Location string, `Group` string, `Order` string, "
        "`Offset` int, Description string")
    cat.register("Lead", df, field_types={"Address": "address", "Location": "location",
                                          "Description": "textarea"})
    return cat


def test_compound_fields_skipped_and_rejected(lead_cat):
    assert lead_cat.object("Lead").columns == ["Id", "Name", "Group", "Order", "Offset", "Description"]
    assert "Address" in lead_cat.object("Lead", skip_types=()).columns
    with pytest.raises(QueryError, match="Compound"):
        ObjectQuery(lead_cat, "Lead").select("Address").to_df()


def test_keyword_like_field_names(lead_cat):
    row = (ObjectQuery(lead_cat, "Lead").select("Group", "Order", "Offset")
           .where(fld("Order") == "ord").order_by("Group").to_df().first())
    assert tuple(row) == ("grp", "ord", 3)
    out = (ObjectQuery(lead_cat, "Lead").select("Group", count_().alias("n")).group_by("Group").to_df().first())
    assert out.n == 1


def test_stream_fields_skip_long_text(lead_cat):
    from objectlake.streaming.changes import stream_schema
    assert stream_query_fields(lead_cat, "Lead") == ["Id", "Name", "Address", "Location", "Group", "Order",
                                                      "Offset"]
    assert stream_schema(lead_cat, "Lead").fieldNames() == stream_query_fields(lead_cat, "Lead")


def test_type_mapping_and_checks():
    assert spark_type("_boolean") == T.BooleanType() and spark_type("currency") == T.DoubleType()
    assert spark_type("picklist") == T.StringType() and spark_type("datetime") == T.TimestampType()
    assert spark_type("complexvalue") == T.ArrayType(T.StringType())
    st = schema_for([("Id", "id", False), ("T", "time", True), ("Amount", "currency", True)])
    assert st["T"].metadata == {"logicalType": "time-micros"} and st["Id"].dataType == T.StringType()
    bad = T.StructType([T.StructField("b", T.BinaryType()), T.StructField("m", T.MapType(T.StringType(),
                                                                                          T.StringType()))])
    assert len(unsupported_fields(bad)) == 2
    actual = T.StructType([T.StructField("Id", T.LongType(), False), T.StructField("Name", T.StringType(), True),
                           T.StructField("Extra", T.StringType())])
    assert compatibility(actual, T.StructType([T.StructField("id", T.LongType(), False)])) == []
    assert compatibility(actual, T.StructType([T.StructField("Name", T.StringType(), False)]))
    assert compatibility(actual, T.StructType([T.StructField("Name", T.StringType(), False)]),
                         check_nullability=False) == []
    assert compatibility(actual, T.StructType([T.StructField("Id", T.IntegerType())]))
    assert compatibility(actual, T.StructType([T.StructField("Nope", T.IntegerType())]))


def test_scan_option_validation():
    assert validate_scan_options("2019-01-01T00:00:00Z", None, "2 hours", None, "queryAll") == []
    f = validate_scan_options("yesterday", "2019-13-01", "2 abc", "1 HOURS,2", "select")
    assert len(f) == 5


def test_provided_schema_checked(cat):
    from objectlake import CatalogError
    ok = cat.object("Account", schema=T.StructType([T.StructField("name", T.StringType(), False),
                                                    T.StructField("ID", T.LongType())]))
    assert ok.columns == ["ID", "name"]
    with pytest.raises(CatalogError) as e:
        cat.object("Account", schema=T.StructType([T.StructField("Name", T.IntegerType()),
                                                   T.StructField("Nope", T.StringType()),
                                                   T.StructField("Id", T.LongType())]))
    assert len(e.value.failures) == 2
    loose = cat.object("Account", schema=T.StructType([T.StructField("Nope", T.StringType()),
                                                       T.StructField("Id", T.LongType())]), check_schema=False)
    assert loose.columns == ["Id"]


def test_category_selectors(spark):
    from objectlake.operators.category import category_nodes, closure
    edges = spark.createDataFrame([("a1", "A"), ("a2", "A"), ("a11", "a1"), ("A", "ROOT"), ("B", "ROOT")],
                                  "child string, parent string")
    nodes = lambda sel, names: sorted(r.node for r in category_nodes(spark, edges, sel, names).collect())
    assert nodes("AT", ["a1", "zzz"]) == ["a1"]
    assert nodes("BELOW", ["A"]) == ["A", "a1", "a11", "a2"]
    assert nodes("ABOVE", ["a11"]) == ["A", "ROOT", "a1", "a11"]
    assert nodes("ABOVE_OR_BELOW", ["a1"]) == ["A", "ROOT", "a1", "a11"]
    pairs = {(r.ancestor, r.descendant) for r in closure(spark, edges).collect()}
    assert ("ROOT", "a11") in pairs and ("a11", "a11") in pairs and ("a1", "a2") not in pairs


def test_discover_lake_objects(spark):
    from objectlake import Catalog
    cat = Catalog(spark)
    names = cat.discover("/root/testdata/sf0.001")
    assert {"orders", "customer", "lineitem", "events"} <= set(names)
    assert cat.fields("region") == ["r_regionkey", "r_name"]
    summary = {r.name: r.row_count for r in cat.summary().collect()}
    assert summary["region"] == 5


def test_register_catalog_table(spark):
    from objectlake import Catalog, ObjectQuery
    spark.range(0, 5).selectExpr("id AS Id", "concat('n', id) AS Name").write.mode("overwrite") \
        .saveAsTable("objectlake_test_people")
    cat = Catalog(spark)
    cat.register("Person", "objectlake_test_people")
    assert ObjectQuery(cat, "Person").select("Id", "Name").to_df().count() == 5
    assert cat.get("Person").path is None
