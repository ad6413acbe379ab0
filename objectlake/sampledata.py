"""The driver's TPC-H-style tables registered as CRM-style objects.

| Object      | Table    | Id          | References                                   |
|-------------|----------|-------------|----------------------------------------------|
| Account     | customer | c_custkey   | Territory → Territory                        |
| Opportunity | orders   | o_orderkey  | Account → Account                            |
| LineItem    | lineitem | (none)      | Opportunity, Product, Vendor                 |
| Product     | part     | p_partkey   |                                              |
| Vendor      | supplier | s_suppkey   | Territory                                    |
| Territory   | nation   | n_nationkey | Region → Region                              |
| Region      | region   | r_regionkey |                                              |
| Activity    | events   | event_id    |                                              |

Soft delete: an Opportunity with status ``F`` is deleted (``IsDeleted``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_FRAMES: dict = {}


def table_frame(spark: SparkSession, sf_dir: str, name: str):
    """The driver table as a DataFrame, read once per session: the tables are
    read-only, so the file listing and footer reads are shared by queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FRAMES:
        _FRAMES[key] = spark.read.parquet(table_path(sf_dir, name))
    return _FRAMES[key]


def sample_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    cat = Catalog(spark)

    def p(t):
        return lambda: table_frame(spark, sf_dir, t)

    cat.register("Region", p("region"), {"Id": "r_regionkey", "Name": "r_name"})
    cat.register("Territory", p("nation"),
                 {"Id": "n_nationkey", "Name": "n_name", "RegionId": "n_regionkey"},
                 field_types={"RegionId": "reference"})
    cat.register("Account", p("customer"),
                 {"Id": "c_custkey", "Name": "c_name", "TerritoryId": "c_nationkey",
                  "Balance": "c_acctbal", "Segment": "c_mktsegment"},
                 field_types={"Id": "id", "TerritoryId": "reference", "Balance": "currency",
                              "Segment": "picklist"})
    cat.register("Opportunity", p("orders"),
                 {"Id": "o_orderkey", "AccountId": "o_custkey", "StageName": "o_orderstatus",
                  "Amount": "o_totalprice", "CloseDate": F.to_date("o_orderdate"),
                  "Priority": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")), "LastModifiedDate": "o_orderdate",
                  "IsDeleted": F.col("o_orderstatus") == "F"},
                 field_types={"Id": "id", "AccountId": "reference", "StageName": "picklist",
                              "Amount": "currency", "Priority": "picklist"},
                 deleted_field="IsDeleted", modified_field="LastModifiedDate",
                 read_only=("IsDeleted", "LastModifiedDate"))
    cat.register("LineItem", p("lineitem"),
                 {"OpportunityId": "l_orderkey", "ProductId": "l_partkey", "VendorId": "l_suppkey",
                  "LineNumber": "l_linenumber", "Quantity": "l_quantity", "Price": "l_extendedprice",
                  "Discount": "l_discount", "Tax": "l_tax", "Flag": "l_returnflag",
                  "Status": "l_linestatus", "LastModifiedDate": "l_shipdate"},
                 id_field=None, modified_field="LastModifiedDate",
                 field_types={"OpportunityId": "reference", "ProductId": "reference",
                              "VendorId": "reference", "Price": "currency", "Discount": "percent",
                              "Tax": "percent"})
    cat.register("Product", p("part"),
                 {"Id": "p_partkey", "Name": "p_name", "Brand": "p_brand", "Type": "p_type",
                  "Size": "p_size", "Price": "p_retailprice",
                  "Tags": F.replace(F.col("p_name"), F.lit(" "), F.lit(";"))},
                 field_types={"Tags": "multipicklist", "Price": "currency"})
    cat.register("Vendor", p("supplier"),
                 {"Id": "s_suppkey", "Name": "s_name", "TerritoryId": "s_nationkey", "Balance": "s_acctbal"},
                 field_types={"TerritoryId": "reference", "Balance": "currency"})
    cat.register("Activity", p("events"),
                 {"Id": "event_id", "CreatedDate": "ts", "UserId": "user_id", "Type": "event_type",
                  "Value": "value", "Props": "props"},
                 field_types={"Props": "textarea"}, modified_field="CreatedDate")

    cat.add_reference("Territory", "Region", "RegionId", "Region", child_name="Territories")
    cat.add_reference("Account", "Territory", "TerritoryId", "Territory", child_name="Accounts")
    cat.add_reference("Vendor", "Territory", "TerritoryId", "Territory", child_name="Vendors")
    cat.add_reference("Opportunity", "Account", "AccountId", "Account", child_name="Opportunities")
    cat.add_reference("LineItem", "Opportunity", "OpportunityId", "Opportunity", child_name="LineItems")
    cat.add_reference("LineItem", "Product", "ProductId", "Product", child_name="LineItems")
    cat.add_reference("LineItem", "Vendor", "VendorId", "Vendor", child_name="LineItems")
    return cat
