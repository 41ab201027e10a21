from qaflow.llm import warc
from tests.llm.oracle import same


def test_warc_equals_sql(spark):
    assert same(spark, warc.query, warc.SQL, "/root/testdata/sf0.001", ["pages"]) == 50
