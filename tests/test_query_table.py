"""Table-driven query specs: valid ones compile and run, invalid ones are
refused with a clear error (the shape of the reference's parser tests)."""

import datetime as dt

import pytest

from objectlake import CatalogError, ObjectQuery, fld
from objectlake.functions import (avg_, calendar_year, convert_timezone, count_, count_distinct_, day_only,
                                  grouping_, hour_in_day, max_, min_, sum_)

VALID = {
    "plain fields": lambda c: ObjectQuery(c, "Opportunity").select("Id", "Amount"),
    "like filter": lambda c: ObjectQuery(c, "Account").select("Id").where(fld("Name").like("Customer#%1")),
    "ordered limit offset": lambda c: ObjectQuery(c, "Account").select("Id", "Name")
    .order_by(("Name", "desc", "last"), "Id").limit(10).offset(5),
    "parent fields": lambda c: ObjectQuery(c, "Opportunity").select("Id", "Account.Name", "Account.Territory.Name"),
    "filter on parent": lambda c: ObjectQuery(c, "Opportunity").select("Id")
    .where(fld("Account.Segment") == "BUILDING"),
    "date literals": lambda c: ObjectQuery(c, "Opportunity").select("Id")
    .where((fld("CloseDate") > dt.date(1996, 1, 1)) & (fld("LastModifiedDate") <= "1997-01-01T00:00:00")),
    "relative date": lambda c: ObjectQuery(c, "Opportunity").select("Id")
    .where(fld("CloseDate").within("LAST_N_MONTHS:6", as_of="1998-01-01")),
    "aggregate without group": lambda c: ObjectQuery(c, "Opportunity")
    .select(count_().alias("n"), max_("Amount").alias("m"), min_("CloseDate").alias("d")),
    "group by with alias": lambda c: ObjectQuery(c, "Opportunity")
    .select(fld("Account.Name").alias("acct"), sum_("Amount").alias("s")).group_by("Account.Name"),
    "group by function": lambda c: ObjectQuery(c, "Activity")
    .select(hour_in_day(convert_timezone("CreatedDate", "Asia/Tokyo")).alias("h"), count_().alias("n"))
    .group_by(hour_in_day(convert_timezone("CreatedDate", "Asia/Tokyo"))),
    "group without aggregates": lambda c: ObjectQuery(c, "Account").select("Segment").group_by("Segment"),
    "rollup with grouping": lambda c: ObjectQuery(c, "Account")
    .select("Segment", grouping_("Segment").alias("g"), count_().alias("n")).rollup("Segment"),
    "cube having order": lambda c: ObjectQuery(c, "Account")
    .select("Segment", "TerritoryId", count_().alias("n")).cube("Segment", "TerritoryId")
    .having(count_() > 1).order_by(count_().desc()),
    "count distinct and avg": lambda c: ObjectQuery(c, "LineItem")
    .select(count_distinct_("ProductId").alias("p"), avg_("Quantity").alias("q")),
    "aggregate of parent field": lambda c: ObjectQuery(c, "Opportunity")
    .select(count_("Account.Name").alias("n"), max_("Account.Name").alias("m")),
    "child sub-query": lambda c: ObjectQuery(c, "Account").select("Id")
    .children("Opportunities", select=["Id", "Account.Name"], where=fld("Amount") > 1000,
              order_by=["CloseDate"], limit=5, offset=1),
    "two child sub-queries": lambda c: ObjectQuery(c, "Product").select("Id")
    .children("LineItems", select=["Quantity"], limit=1)
    .children("LineItems", select=["Price"], alias="Priced", flat=False),
    "semi join": lambda c: ObjectQuery(c, "Account").select("Id")
    .where(fld("Id").isin(ObjectQuery(c, "Opportunity").select("AccountId"))),
    "filter on function": lambda c: ObjectQuery(c, "Opportunity").select("Id", day_only("LastModifiedDate").alias("d"))
    .where(calendar_year("CloseDate") == 1997),
    "keyword case": lambda c: ObjectQuery(c, "OPPORTUNITY").select("ID", "amount").where(fld("stagename") == "O"),
    "null comparisons": lambda c: ObjectQuery(c, "Opportunity").select("Id")
    .where((fld("Priority") == None) | (fld("Priority") != None)),  # noqa: E711
    "includes excludes": lambda c: ObjectQuery(c, "Product").select("Id")
    .where(fld("Tags").includes(["red;bolt"]) | fld("Tags").excludes(["small"])),
}

INVALID = {
    "no fields": (lambda c: ObjectQuery(c, "Account").to_df(), "at least one field"),
    "unknown object": (lambda c: ObjectQuery(c, "Nope"), "Unknown object"),
    "unknown field": (lambda c: ObjectQuery(c, "Account").select("Nope").to_df(), "does not exist"),
    "unknown reference": (lambda c: ObjectQuery(c, "Account").select("Owner.Name").to_df(), "does not exist"),
    "unknown child": (lambda c: ObjectQuery(c, "Account").select("Id").children("Cases", select=["Id"]).to_df(),
                      "does not exist"),
    "function without alias": (lambda c: ObjectQuery(c, "Account").select(count_()).to_df(), "alias"),
    "alias without group": (lambda c: ObjectQuery(c, "Account").select(fld("Name").alias("x")).to_df(), "alias"),
    "field not grouped": (lambda c: ObjectQuery(c, "Account").select("Name", count_().alias("n"))
                          .group_by("Segment").to_df(), "neither grouped"),
    "having without group": (lambda c: ObjectQuery(c, "Account").select("Id").having(count_() > 1), "GROUP BY"),
    "grouping without rollup": (lambda c: ObjectQuery(c, "Account").select("Segment", grouping_("Segment").alias("g"))
                                .group_by("Segment").to_df(), "ROLLUP"),
    "function in child": (lambda c: ObjectQuery(c, "Account").select("Id")
                          .children("Opportunities", select=[max_("Amount").alias("m")]), "not allowed"),
    "children with aggregation": (lambda c: ObjectQuery(c, "Account").select(count_().alias("n"))
                                  .children("Opportunities", select=["Id"]).to_df(), "cannot be combined"),
    "negative offset": (lambda c: ObjectQuery(c, "Account").select("Id").offset(-1), "0 or greater"),
    "bad category selector": (lambda c: ObjectQuery(c, "Account").select("Id").with_category("G", "NEAR", "x"),
                              "selector"),
    "unknown scope": (lambda c: ObjectQuery(c, "Account").select("Id").scope("mine").to_df(), "Unknown scope"),
    "duplicate field": (lambda c: ObjectQuery(c, "Account").select("Id", "ID").to_df(), "Duplicate"),
    "stream query with order": (lambda c: ObjectQuery(c, "Account").select("Id").order_by("Id")
                                .over(c.table("Account")), "fields and filters"),
}


@pytest.mark.parametrize("name", sorted(VALID))
def test_valid_specs(cat, name):
    df = VALID[name](cat).to_df()
    df.limit(5).collect()


@pytest.mark.parametrize("name", sorted(INVALID))
def test_invalid_specs(cat, name):
    build, msg = INVALID[name]
    with pytest.raises((CatalogError, ValueError, TypeError, KeyError)) as e:
        build(cat)
    assert msg.lower() in str(e.value).lower()
