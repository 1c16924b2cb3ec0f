"""Register files in XML, written by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import fixtures as fx
from registry.scratch import scratch_path

#: How the files are packed: with little work a record.
PACKED = {"compression": "gzip", "zlib.compress.level": "TWO"}


def _escape(c: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def _element(tag: str, content: Column) -> Column:
    """Element, or nothing where the content is null."""
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), content, F.lit(f"</{tag}>")), F.lit(""))


def _disguised(tag: str, prefix: str) -> Column:
    """By row, something that looks like tags of records and is none."""
    name = f"{prefix}{tag}"
    kinds = [
        f"<!-- <{name}><{prefix}LEI>NONE</{prefix}LEI></{name}> -->", f"<?skip </{name}> ?>", "<!-- ]]> <![CDATA[ -->", "",
    ]
    place = F.pmod(F.monotonically_increasing_id(), F.lit(len(kinds))).cast("int")
    return F.get(F.array(*map(F.lit, kinds)), place)


def _write(rows: DataFrame, order: list[str], record: Column, header: str, date: str, name: str) -> str:
    """Sorted files, each opening with its own header in front of the first record.

    Packed, since tags take some twenty times the room of what they hold; a packed file is one split."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    head = (
        f'<?xml version="1.0"?>\n<x:Data xmlns:x="urn:x"><{header}><x:ContentDate>{date}'
        f"</x:ContentDate><x:FileContent>FULL</x:FileContent></{header}>\n"
    )
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    ordered.select(
        F.concat(F.when(first, F.lit(head)).otherwise(F.lit("")), record).alias("value")
    ).write.options(**PACKED).text(path)
    return path


def latest_order(spark: SparkSession, sf_dir: str) -> str:
    orders = fx.table(spark, sf_dir, "orders")
    return str(orders.agg(F.max("o_orderdate").cast("date")).first()[0])


def entities(spark: SparkSession, sf_dir: str) -> str:
    """Entities of all parts; every second one has no headquarters address."""
    rows = fx.entity(spark, sf_dir)
    half = F.col("row_id") % 2 == 0
    country = F.coalesce(_escape(F.col("country")), F.lit(" "))
    record = F.concat(
        _disguised("LEIRecord", "x:"),
        F.when(half, "<x:LEIRecord>\n ").otherwise("<x:LEIRecord kind='a>b' >\n "),
        _element("x:LEI", F.nullif("lei", F.lit(""))),
        F.lit('<x:Entity><x:LegalName xml:lang="en">\n '),
        F.when(half, F.concat(F.lit("<![CDATA["), F.col("legal_name"), F.lit("]]>"))).otherwise(_escape(F.col("legal_name"))),
        F.lit("\n</x:LegalName>"),
        _element("x:LegalAddress", _element("x:Country", F.concat(F.lit("L"), country))),
        F.when(half, _element("x:HeadquartersAddress", _element("x:Country", country))).otherwise(""),
        _element("x:RegistrationAuthority", _element("x:RegistrationAuthorityID", F.lpad((F.col("row_id") % 7).cast("string"), 3, "0"))),
        _element("x:EntityStatus", F.when(half, F.lit("ACTIVE")).otherwise("INACTIVE")),
        F.lit("</x:Entity>\n</x:LEIRecord"), F.when(F.col("row_id") % 5 == 0, " >").otherwise(">"),
    )
    return _write(rows, ["row_id"], record, "x:LEIHeader", latest_order(spark, sf_dir), "entities")


def relations(spark: SparkSession, sf_dir: str) -> str:
    """Relationships of all line items, with none, one or two periods, and some bad records."""
    rows = fx.table(spark, sf_dir, "lineitem")
    # order numbers repeat, so everything a record shows takes part in the order
    order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
        "l_linestatus", "l_quantity",
    ]
    ship = F.col("l_shipdate").cast("date")

    def period(start: Column, kind: str) -> Column:
        return _element(
            "y:RelationshipPeriod",
            F.concat(
                _element("y:StartDate", start.cast("string")),
                _element("y:EndDate", F.when(F.col("l_linenumber") % 3 == 0, F.date_add(start, 10).cast("string"))),
                _element("y:PeriodType", F.lit(kind)),
            ),
        )

    number = F.col("l_linenumber")
    record = F.concat(
        _disguised("RelationshipRecord", "y:"),
        F.lit("<y:RelationshipRecord><y:Relationship>"),
        _element("y:StartNode", _element("y:NodeID", fx.code("E", "l_partkey"))),
        _element("y:EndNode", _element("y:NodeID", fx.code("E", "l_suppkey"))),
        _element("y:RelationshipType", F.concat(F.lit("REL_"), "l_returnflag")),
        _element("y:RelationshipStatus", F.col("l_linestatus")),
        F.when(number == 1, "")
        .when(number % 2 == 0, _element("y:RelationshipPeriods", period(ship, "FIRST")))
        .otherwise(
            _element(
                "y:RelationshipPeriods",
                F.concat(period(ship, "FIRST"), period(F.date_add(ship, 30), "SECOND")),
            )
        ),
        # some records are not well formed
        F.when((number == 7) & (F.col("l_quantity") == 50), "<y:Open>").otherwise(""),
        F.lit("</y:Relationship></y:RelationshipRecord>"),
    )
    return _write(rows, order, record, "y:Header", latest_order(spark, sf_dir), "relations")


def exceptions(spark: SparkSession, sf_dir: str) -> str:
    """Reporting exceptions of all events."""
    rows = fx.table(spark, sf_dir, "events")
    record = F.concat(
        _disguised("Exception", ""),
        F.lit("<Exception>"),
        _element("LEI", fx.code("E", "user_id")),
        _element("ExceptionCategory", _escape(F.upper("event_type"))),
        _element("ExceptionReason", _escape(F.col("props"))),
        _element("NextVersion", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("v"), F.col("event_id") % 9))),
        F.lit("</Exception>"),
    )
    return _write(rows, ["event_id"], record, "Header", latest_order(spark, sf_dir), "exceptions")
