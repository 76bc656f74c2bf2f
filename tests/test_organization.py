from pyspark.sql import functions as F

from changeledger.functions.organization import organization_of
from changeledger.operators.contributors import with_organization

CASES = {
    # No part after an at sign that could be a domain.
    "nobody here": "",
    "x@": "",
    "": "",
    "root@10.20.30.40": "",
    # A host of one label is the organisation.
    "ci@buildbox": "buildbox",
    # Extensions of two to four letters go, and `co` before one.
    "li@orchard.de": "orchard",
    "li@orchard.co.nz": "orchard",
    "li@orchard.coop": "orchard",
    # What precedes stays, in lower case.
    "li@north.orchard.co.za": "north.orchard",
    "LI@North.Orchard.NET": "north.orchard",
    # The character before the extension need not be a dot.
    "a@pear.museum": "pear.m",
    "a@pear.company": "pear",
    "a@b@c": "b@c",
}


def test_organization_of_each_shape_of_address(spark):
    df = spark.createDataFrame([(email,) for email in CASES], "email string")
    got = {row.email: row.organization for row in with_organization(df).collect()}
    assert got == CASES


def test_missing_email_has_no_organization(spark):
    df = spark.createDataFrame([(None,)], "email string")
    assert df.select(organization_of(F.col("email"))).collect()[0][0] == ""
