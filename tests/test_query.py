import pytest
from pyspark.sql import functions as F

from siltstone.plans import conditions as c
from siltstone.plans.query import And, Leaf, Not, Or, QueryError, explain, leaves, parse, with_negation_at_leaves

INDEX = '<index value="%s" operation="EQUALS"/>'


def test_white_space_and_case_do_not_matter():
    assert parse(f"<and>\n  {INDEX % 'a'}\n  <Or>{INDEX % 'b'}{INDEX % 'c'}</Or>\n</and>") == And(Leaf("index", "a"), Or(Leaf("index", "b"), Leaf("index", "c")))


@pytest.mark.parametrize("xml", ["<AND/>", f"<OR>{INDEX % 1 * 3}</OR>", "<index value='a'/>", "<index operation='EQUALS'/>", "<NOT/>", "no xml", f"<index value='a' operation='EQUALS'>{INDEX % 1}</index>"])
def test_unreadable_queries(xml):
    with pytest.raises(QueryError):
        parse(xml)


def test_negation_moves_to_the_leaves():
    a, b = Leaf("index", "a"), Leaf("host", "b")
    assert with_negation_at_leaves(Not(Or(a, Not(b)))) == And(Not(a), b)
    assert with_negation_at_leaves(Not(Not(a))) == a
    assert list(leaves(Not(And(a, b)))) == [a, b]
    assert explain(Not(And(a, b))).splitlines()[1] == "  AND"


@pytest.mark.parametrize(
    ("xml", "start"),
    [
        ('<OR><earliest value="2" operation="GE"/><earliest value="1" operation="GE"/></OR>', 1),
        ('<AND><OR><earliest value="2611657302" operation="GE"/><earliest value="1000" operation="GE"/></OR><NOT><earliest value="1" operation="GE"/></NOT></AND>', 1000),
        ('<earliest value="2611657302" operation="GE"/>', 1_700_000_000 - 86400),
        (INDEX % "a", 1_700_000_000 - 86400),
        ('<latest value="5" operation="LE"/>', 1_700_000_000 - 86400),
    ],
)
def test_start_of_a_search(xml, start):
    assert c.earliest_epoch(parse(xml), 1_700_000_000) == start


@pytest.mark.parametrize(
    ("xml", "regex"),
    [
        (INDEX % "zongprox*", r"^\Qzongprox\E[^/]*$"),
        (INDEX % "cpu", r"^\Qcpu\E$"),
        (f"<OR>{INDEX % 'nanprox*'}{INDEX % 'zongprox*'}</OR>", r"(^\Qnanprox\E[^/]*$|^\Qzongprox\E[^/]*$)"),
        (f"<AND>{INDEX % 'a'}{INDEX % 'b'}</AND>", "^.*$"),
        (f"<NOT>{INDEX % 'a'}</NOT>", "^.*$"),
        (f"<AND>{INDEX % 'a'}<host value='h' operation='EQUALS'/></AND>", r"^\Qa\E$"),
        (f"<OR>{INDEX % 'a'}<host value='h' operation='EQUALS'/></OR>", "^.*$"),
    ],
)
def test_topics(xml, regex):
    assert c.topic_regex(parse(xml)) == regex


def test_hours_round_towards_zero():
    assert [c.hour_floor(x) for x in (1000, 3600, 7201, -1, -3601)] == [0, 3600, 7200, 0, -3600]


def test_objects_are_an_upper_bound_of_rows(spark):
    """Whatever rows a query has, their objects are among those it keeps."""
    rows = spark.createDataFrame([(i, f"i{i % 3}", f"h{i % 4}", 7200 + i * 400, f"term{i % 5}") for i in range(60)], "id int, index string, host string, epoch long, raw string")
    rows = rows.withColumn("sourcetype", F.col("index")).withColumn("logtime", F.expr("epoch - epoch % 3600")).withColumn("logdate", F.to_date(F.timestamp_seconds("logtime")))
    names = {n: F.col(n) for n in c.NAMES}
    term, early, late = "<indexstatement value='TERM3' operation='EQUALS'/>", "<earliest value='12345' operation='GE'/>", "<latest value='20001' operation='LE'/>"
    for xml in (f"<NOT>{early}</NOT>", f"<NOT><AND>{early}{late}</AND></NOT>", f"<OR>{term}{INDEX % 'i1'}</OR>", f"<NOT>{term}</NOT>", f"<AND>{early}<NOT>{late}</NOT></AND>", f"<NOT><OR>{INDEX % 'i*'}{term}</OR></NOT>"):
        node = parse(xml)
        exact = rows.where(c.on_rows(node, names, F.col("epoch"), F.col("raw")))
        coarse = rows.where(c.on_objects(node, names, F.col("logtime"), F.col("logdate")))
        assert exact.join(coarse, "id", "left_anti").count() == 0, xml


def test_strict_and_compat(spark):
    node = parse(f"<OR>{INDEX % 'a'}<unknown value='1' operation='EQUALS'/></OR>")
    columns = [F.col(n) for n in c.NAMES]
    with pytest.raises(QueryError):
        c.on_streams(node, *columns, strict=True)
    df = spark.createDataFrame([("a", "s", "h"), ("b", "s", "h")], "index string, sourcetype string, host string")
    assert df.where(c.on_streams(node, *columns)).count() == 2
    assert df.where(c.on_streams(node, *columns, compat=True)).count() == 1
