import pytest
from pyspark.sql import types as T

from objectlake import CatalogError, ObjectQuery, QueryError, fld
from objectlake.functions import (avg_, calendar_year, count_, count_distinct_, func, grouping_, hour_in_day,
                                  max_, param, sum_)


def test_alias_rules(cat):
    with pytest.raises(QueryError):   # alias on a plain field without GROUP BY
        ObjectQuery(cat, "Account").select(fld("Name").alias("n")).to_df()
    with pytest.raises(QueryError):   # function without alias
        ObjectQuery(cat, "Account").select(count_()).to_df()
    with pytest.raises(QueryError):   # grouped reference field without alias
        ObjectQuery(cat, "Account").select("Territory.Name", count_().alias("n")).group_by("Territory.Name").to_df()
    df = ObjectQuery(cat, "Account", strict_aliases=False).select(count_()).to_df()
    assert df.columns == ["expr0"]


def test_star_rejected(cat):
    with pytest.raises(ValueError):
        ObjectQuery(cat, "Account").select("*")


def test_unknown_names(cat):
    with pytest.raises(CatalogError, match="Field 'Nope'"):
        ObjectQuery(cat, "Account").select("Nope").to_df()
    with pytest.raises(CatalogError, match="Reference 'Owner'"):
        ObjectQuery(cat, "Account").select("Owner.Name").to_df()
    with pytest.raises(CatalogError, match="Child relationship 'Cases'"):
        ObjectQuery(cat, "Account").select("Id").children("Cases", select=["Id"]).to_df()
    with pytest.raises(CatalogError):
        ObjectQuery(cat, "NoSuchObject")


def test_object_prefix_and_case(cat):
    df = ObjectQuery(cat, "Opportunity", alias="o").select("o.Id", "Opportunity.Amount", "ACCOUNT.name").to_df()
    assert df.columns == ["Id", "Amount", "ACCOUNT_name"]


def test_clause_rules(cat):
    with pytest.raises(QueryError):
        ObjectQuery(cat, "Account").select("Id").having(count_() > 1)
    with pytest.raises(QueryError):
        ObjectQuery(cat, "Account").select("Id").children("Opportunities", select=[max_("Amount").alias("m")])
    with pytest.raises(QueryError):
        ObjectQuery(cat, "Account").select("Segment", grouping_("Segment").alias("g")).group_by("Segment").to_df()
    with pytest.raises(TypeError):
        ObjectQuery(cat, "Account").select(sum_("Name").alias("s")).to_df()
    with pytest.raises(QueryError):
        ObjectQuery(cat, "Account").select("Id").limit(-1)


def test_result_types(cat):
    q = (ObjectQuery(cat, "LineItem")
         .select("Flag", count_().alias("n"), sum_("LineNumber").alias("s_int"), sum_("Quantity").alias("s_dbl"),
                 avg_("LineNumber").alias("a"), count_distinct_("ProductId").alias("d"),
                 grouping_("Flag").alias("g"), max_("LastModifiedDate").alias("m"),
                 calendar_year(max_("LastModifiedDate")).alias("y"))
         .rollup("Flag"))
    st = q.schema()
    types = {f.name: f.dataType for f in st.fields}
    assert types["n"] == T.LongType() and types["s_int"] == T.LongType()
    assert types["s_dbl"] == T.DoubleType() and types["a"] == T.DoubleType()
    assert types["d"] == T.LongType() and types["g"] == T.IntegerType()
    assert types["m"] == T.TimestampNTZType() and types["y"] == T.IntegerType()


def test_parameter_binding(cat):
    q = ObjectQuery(cat, "Account").select("Id").where(fld("Segment") == param("seg"))
    with pytest.raises(KeyError):
        q.to_df()
    n = q.bind(seg="BUILDING").to_df().count()
    m = ObjectQuery(cat, "Account").select("Id").where(fld("Segment") == "BUILDING").to_df().count()
    assert n == m > 0


def test_registered_function(cat):
    from pyspark.sql import functions as F
    cat.register_function("FORMAT", lambda c: F.upper(c))
    row = (ObjectQuery(cat, "Account").select("Id", func("FORMAT", "Name").alias("n"), func("OTHER", "Name").alias("o"))
           .where(fld("Id") == 1).to_df().first())
    assert row["n"] == row["o"].upper()


def test_group_by_function_and_plan(cat):
    q = (ObjectQuery(cat, "Activity").select(hour_in_day("CreatedDate").alias("h"), count_().alias("n"))
         .group_by(hour_in_day("CreatedDate")))
    rows = q.to_df().collect()
    assert sum(r["n"] for r in rows) == cat.table("Activity").count()


def test_parent_filter_pushdown_and_broadcast(cat):
    df = (ObjectQuery(cat, "Opportunity").modified(since="1996-01-01", until="1997-01-01")
          .select("Id", "Account.Segment").where(fld("Amount") > 1000).to_df())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "BroadcastHashJoin" in plan


def test_null_parent_keeps_child(spark):
    from objectlake import Catalog
    cat = Catalog(spark)
    cat.register("Campaign", spark.createDataFrame([(1, "Spring")], "Id long, Name string"))
    cat.register("Opportunity", spark.createDataFrame([(10, "A", 1), (11, "B", None), (12, "C", 99)],
                                                      "Id long, Name string, CampaignId long"))
    cat.add_reference("Opportunity", "Campaign", "CampaignId", "Campaign")
    rows = {r["Id"]: r["Campaign_Name"] for r in
            ObjectQuery(cat, "Opportunity").select("Id", "Campaign.Name").to_df().collect()}
    assert rows == {10: "Spring", 11: None, 12: None}


def test_children_nested_empty_array(cat):
    df = (ObjectQuery(cat, "Account").select("Id")
          .children("Opportunities", select=["Id"], where=fld("Amount") > 10**9).to_df())
    assert df.schema["Opportunities"].nullable is False
    assert df.filter("size(Opportunities) > 0").count() == 0
    assert df.count() == cat.table("Account").count()


def test_not_in_plan_is_equi_join(cat):
    sub = ObjectQuery(cat, "Opportunity").select("AccountId").where(fld("Amount") > 400000)
    df = ObjectQuery(cat, "Account").select("Id").where(fld("Id").notin(sub)).to_df()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_child_limit_uses_group_limit(cat):
    df = (ObjectQuery(cat, "Account").select("Id")
          .children("Opportunities", select=["Id"], order_by=[fld("Amount").desc()], limit=2).to_df())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_self_reference_hierarchy(spark):
    from objectlake import Catalog
    cat = Catalog(spark)
    cat.register("Account", spark.createDataFrame([(1, "root", None), (2, "child", 1), (3, "leaf", 2)],
                                                  "Id long, Name string, ParentId long"))
    cat.add_reference("Account", "Parent", "ParentId", "Account", child_name="ChildAccounts")
    rows = {r.Id: (r.Parent_Name, r.Parent_Parent_Name) for r in
            ObjectQuery(cat, "Account").select("Id", "Parent.Name", "Parent.Parent.Name").to_df().collect()}
    assert rows == {1: (None, None), 2: ("root", None), 3: ("child", "root")}
    kids = {r.Id: [c.Name for c in r.ChildAccounts] for r in
            ObjectQuery(cat, "Account").select("Id").children("ChildAccounts", select=["Name"]).to_df().collect()}
    assert kids == {1: ["child"], 2: ["leaf"], 3: []}


def test_hot_parent_children(spark):
    """One parent owns a third of all children: flat rows use an inner join
    (splittable on both sides) plus an anti join; limited arrays stay small."""
    from objectlake import Catalog
    cat = Catalog(spark)
    parents = spark.range(0, 300).selectExpr("id AS Id", "concat('p', id) AS Name")
    kids = spark.range(0, 3000).selectExpr("id AS Id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 200 END AS ParentId",
                                           "CAST(id AS DOUBLE) AS Amount")
    cat.register("Parent", parents)
    cat.register("Kid", kids)
    cat.add_reference("Kid", "Parent", "ParentId", "Parent", child_name="Kids")
    flat = ObjectQuery(cat, "Parent").select("Id").children("Kids", select=["Id"], flat=True).to_df()
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan
    assert flat.count() == 3000 + 100          # parents 200..299 have no child
    assert flat.filter("Id = 7").count() == 1000 + 10   # every third kid, plus ids 7 mod 200
    top = (ObjectQuery(cat, "Parent").select("Id")
           .children("Kids", select=["Amount"], order_by=[fld("Amount").desc()], limit=3).to_df())
    hot = top.filter("Id = 7").first()
    assert [k.Amount for k in hot.Kids] == [2997.0, 2994.0, 2991.0]


@pytest.mark.parametrize("mode", ["rollup", "cube"])
def test_count_distinct_subtotals(spark, mode):
    """Null keys, null values and a counted key, against Spark's own aggregate;
    no Expand has a branch a counted column."""
    from objectlake import Catalog
    from pyspark.sql import functions as F
    cat = Catalog(spark)
    rows = spark.range(0, 2000).selectExpr("id AS Id", "nullif(id % 4, 3) AS A", "nullif(id % 5, 2) AS B",
                                           "nullif(id % 37, 5) AS V", "nullif(id % 11, 1) AS W", "CAST(id AS DOUBLE) AS X")
    cat.register("Thing", rows)
    q = ObjectQuery(cat, "Thing").select("A", "B", count_().alias("n"), count_distinct_("V").alias("v"), sum_("X").alias("x"),
                                         count_distinct_("W").alias("w"), count_distinct_("A").alias("na"),
                                         grouping_("A").alias("ga"))
    got = getattr(q, mode)("A", "B").having(count_distinct_("V") > 0).order_by(count_distinct_("W")).to_df()
    spare = rows.withColumn("A1", F.col("A"))
    want = getattr(spare, mode)("A", "B").agg(
        F.count("*").alias("n"), F.count_distinct("V").alias("v"), F.sum("X").alias("x"), F.count_distinct("W").alias("w"),
        F.count_distinct("A1").alias("na"), F.grouping("A").cast("int").alias("ga")).where("v > 0")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    only = getattr(ObjectQuery(cat, "Thing").select("A", "B", count_distinct_("V").alias("v")), mode)("A", "B").to_df()
    assert only.count() == getattr(rows, mode)("A", "B").count().count()
    empty = getattr(ObjectQuery(cat, "Thing").select("A", count_distinct_("V").alias("v")).where(fld("Id") < 0), mode)("A").to_df()
    assert empty.collect() == getattr(rows.where("Id < 0"), mode)("A").agg(F.count_distinct("V").alias("v")).collect()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand [") == 4 and "gid" not in plan      # rows once, and the distinct values of each counted column


def test_children_in_pieces(spark):
    """Pieces hold at most the given rows, all but a parent's last are full,
    and together they are the children; nothing sorts or collects a whole parent."""
    from objectlake import Catalog
    cat = Catalog(spark)
    cat.register("Parent", spark.range(0, 300).selectExpr("id AS Id", "id % 2 AS Side"))
    cat.register("Kid", spark.range(0, 30000).selectExpr(
        "id AS Id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 1000 = 1 THEN NULL ELSE id % 200 END AS ParentId",
        "CAST(id AS DOUBLE) AS Amount"))
    cat.add_reference("Kid", "Parent", "ParentId", "Parent", child_name="Kids")
    base = ObjectQuery(cat, "Parent").select("Id")
    whole = {r.Id: sorted(k.Id for k in r.Kids) for r in base.children("Kids", select=["Id"]).to_df().collect()}
    rows = base.children("Kids", select=["Id"], piece_rows=64).to_df().collect()
    assert max(len(r.Kids) for r in rows) == 64
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r.Id, r.Kids_piece)):
        got.setdefault(r.Id, []).append((r.Kids_piece, [k.Id for k in r.Kids]))
    assert {i: sorted(x for _, ids in p for x in ids) for i, p in got.items()} == whole
    for pieces in got.values():
        assert [n for n, _ in pieces] == list(range(len(pieces)))
        assert all(len(ids) == 64 for _, ids in pieces[:-1])
    assert got[299] == [(0, [])]
    # in order, after an offset, for filtered parents
    part = (base.where(fld("Side") == 1).children("Kids", select=["Id"], where=fld("Id") < 900, piece_rows=50,
                                                  order_by=[fld("Amount").desc()], offset=1).to_df())
    hot = [[k.Id for k in r.Kids] for r in sorted(part.where("Id = 7").collect(), key=lambda r: r.Kids_piece)]
    want = sorted((i for i in range(900) if i % 3 == 0 or (i % 1000 != 1 and i % 200 == 7)), reverse=True)[1:]
    assert hot == [want[i:i + 50] for i in range(0, len(want), 50)]
    for bad in ({"piece_rows": 0}, {"piece_rows": 5, "flat": True}):
        with pytest.raises(QueryError):
            base.children("Kids", select=["Id"], **bad)
    with pytest.raises(QueryError):
        base.children("Kids", select=["Id"], piece_rows=5).children("Kids", select=["Id"], flat=True)


def test_not_in_null_safe_and_read_source(cat):
    from objectlake.sources.batch import read_source
    sub = ObjectQuery(cat, "Opportunity").select("Priority").where(fld("Amount") > 400000)
    strict = ObjectQuery(cat, "Opportunity").select("Id").where(fld("Priority").notin(sub)).to_df().count()
    loose = (ObjectQuery(cat, "Opportunity").select("Id").where(fld("Priority").notin(sub, null_safe=True))
             .to_df().count())
    assert strict == 0 and loose > 0          # the sub-query holds a null priority
    q = ObjectQuery(cat, "Account").select("Id")
    assert read_source(cat, "Opportunity", q, since="2100-01-01").columns == ["Id"]   # query wins, read as written
    assert read_source(cat, "Opportunity", since="2100-01-01").count() == 0
    with pytest.raises(CatalogError):
        read_source(cat)


def test_subquery_under_or(cat):
    sub = ObjectQuery(cat, "Opportunity").select("AccountId").where(fld("Amount") > 450000)
    got = {r.Id for r in ObjectQuery(cat, "Account").select("Id")
           .where(fld("Id").isin(sub) | (fld("Segment") == "BUILDING")).to_df().collect()}
    ids = {r.AccountId for r in sub.to_df().collect()}
    seg = {r.Id for r in ObjectQuery(cat, "Account").select("Id").where(fld("Segment") == "BUILDING").to_df().collect()}
    assert got == ids | seg
    both = {r.Id for r in ObjectQuery(cat, "Account").select("Id")
            .where(fld("Id").isin(sub) & (fld("Segment") == "BUILDING")).to_df().collect()}
    assert both == ids & seg


def test_materialized_bucketed_join(spark):
    """Opportunity and LineItem bucketed on the join key: the child join
    reads both sides without a shuffle."""
    from objectlake.sampledata import sample_catalog
    cat = sample_catalog(spark, "/root/testdata/sf0.001")
    cat.materialize("Opportunity", "ol_opportunity", buckets=4)
    cat.materialize("LineItem", "ol_lineitem", bucket_by="OpportunityId", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = (ObjectQuery(cat, "LineItem").select("Quantity", "Opportunity.Amount")
              .where(fld("Quantity") > 10).to_df())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert df.count() == (ObjectQuery(sample_catalog(spark, "/root/testdata/sf0.001"), "LineItem")
                              .select("Quantity", "Opportunity.Amount").where(fld("Quantity") > 10).to_df().count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_offset_without_limit(cat):
    q = ObjectQuery(cat, "Account").select("Id", "Balance").order_by(fld("Balance").desc(), "Id")
    all_rows = [(r.Id, r.Balance) for r in q.to_df().collect()]
    rest = q.offset(100).to_df()
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "CollectLimit" not in plan
    assert sorted((r.Id, r.Balance) for r in rest.collect()) == sorted(all_rows[100:])
    grouped = (ObjectQuery(cat, "Account").select("TerritoryId", count_().alias("n"))
               .group_by("TerritoryId").order_by("TerritoryId").offset(20).to_df())
    assert [r.TerritoryId for r in grouped.collect()] == [20, 21, 22, 23, 24]


def test_monotonic_date_functions_push_down(cat):
    from objectlake.functions import day_only, fiscal_year
    base = ObjectQuery(cat, "Opportunity").include_deleted(True).select("Id")
    df = base.where(calendar_year("LastModifiedDate") == 1997).to_df()
    plan = df._jdf.queryExecution().executedPlan().toString()
    import re
    flat = re.sub(r"#\d+", "", plan)
    assert "o_orderdate >= 1997-01-01 00:00:00" in flat and "o_orderdate < 1998-01-01 00:00:00" in flat
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in flat
    rows = cat.table("Opportunity").select("Id", "CloseDate").collect()
    for op, test in [("=", lambda y: y == 1997), ("!=", lambda y: y != 1997), ("<", lambda y: y < 1997),
                     ("<=", lambda y: y <= 1997), (">", lambda y: y > 1997), (">=", lambda y: y >= 1997)]:
        cond = {"=": calendar_year("CloseDate") == 1997, "!=": calendar_year("CloseDate") != 1997,
                "<": calendar_year("CloseDate") < 1997, "<=": calendar_year("CloseDate") <= 1997,
                ">": calendar_year("CloseDate") > 1997, ">=": calendar_year("CloseDate") >= 1997}[op]
        got = {r.Id for r in base.where(cond).to_df().collect()}
        assert got == {r.Id for r in rows if test(r.CloseDate.year)}, op
    fy = {r.Id for r in base.where(fiscal_year("CloseDate", 4) == 1997).to_df().collect()}
    assert fy == {r.Id for r in rows if (r.CloseDate.year if r.CloseDate.month >= 4 else r.CloseDate.year - 1) == 1997}
    fy_end = {r.Id for r in base.where(fiscal_year("CloseDate", 4, label="end") == 1998).to_df().collect()}
    assert fy_end == fy
    import datetime as dt
    one = {r.Id for r in base.where(day_only("LastModifiedDate") == dt.date(1997, 3, 4)).to_df().collect()}
    assert one == {r.Id for r in rows if r.CloseDate == dt.date(1997, 3, 4)}


def test_relative_dates_in_a_time_zone(cat):
    import datetime as dt
    q = ObjectQuery(cat, "Activity").select("Id", "CreatedDate")
    rows = q.to_df().collect()
    as_of = max(r.CreatedDate for r in rows).date()
    got = {r.Id for r in q.where(fld("CreatedDate").within("TODAY", as_of=as_of, tz="Asia/Tokyo")).to_df().collect()}
    tokyo = dt.timezone(dt.timedelta(hours=9))
    want = {r.Id for r in rows
            if r.CreatedDate.replace(tzinfo=dt.timezone.utc).astimezone(tokyo).date() == as_of}
    assert got == want and len(got) > 0
    plan = q.where(fld("CreatedDate").within("TODAY", as_of=as_of, tz="Asia/Tokyo")).to_df()._jdf \
        .queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_flat_and_nested_children_agree(cat):
    from pyspark.sql import functions as F
    spec = dict(select=["Id", "Amount"], where=fld("Amount") > 100000, order_by=[fld("Amount").desc(), "Id"],
                limit=2, offset=1)
    nested = (ObjectQuery(cat, "Account").select("Id").children("Opportunities", **spec).to_df()
              .select("Id", F.explode_outer("Opportunities").alias("c"))
              .select("Id", F.col("c.Id").alias("cid"), F.col("c.Amount").alias("amt")))
    flat = (ObjectQuery(cat, "Account").select("Id").children("Opportunities", flat=True, **spec).to_df()
            .select("Id", F.col("Opportunities_Id").alias("cid"), F.col("Opportunities_Amount").alias("amt")))
    assert sorted(map(tuple, nested.collect()), key=str) == sorted(map(tuple, flat.collect()), key=str)


def test_scope_with_parameter(cat):
    from objectlake.functions import param
    cat.register_scope("Opportunity", "mine", fld("AccountId") == param("me"))
    mine = ObjectQuery(cat, "Opportunity").select("Id", "AccountId").scope("mine").bind(me=7).to_df().collect()
    assert mine and all(r.AccountId == 7 for r in mine)


def test_expressions_have_no_truth_value():
    import pytest as _pytest
    with _pytest.raises(TypeError, match="no truth value"):
        bool(fld("a") > 1 and fld("b") < 2)
