"""Entity, relationship and exception records from XML files of any size.

One file is read by many tasks (`splits`): text is cut at the record tag, and each split knows whether
it starts inside a record, a comment, a CDATA section or a processing instruction, so that tags in
those are no tags. Every record is parsed on its own and a bad one costs one record. Tag prefixes
are ignored. Where an element repeats, its first occurrence counts.

A file in which no tag ends in the record's name and `>` (all have white space or attributes there)
is read as one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firmloom.functions.names import clean_name, entity_country
from firmloom.functions.text import text_or_null
from firmloom.sources.xml_cutter import cut_records, split_table

_BROKEN = "_broken"
_OPTIONS = {
    "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN,
}

# Record and header tags of the three register files.
ENTITY_TAG, ENTITY_HEADER = "LEIRecord", "LEIHeader"
RELATION_TAG, RELATION_HEADER = "RelationshipRecord", "Header"
EXCEPTION_TAG, EXCEPTION_HEADER = "Exception", "Header"

_TEXT = "array<string>"
_ADDRESS = f"array<struct<Country:{_TEXT}>>"
_NODE = f"array<struct<NodeID:{_TEXT}>>"
_PERIOD = f"struct<StartDate:{_TEXT},EndDate:{_TEXT},PeriodType:{_TEXT}>"
_ENTITY = (
    f"LEI {_TEXT}, Entity array<struct<LegalName:{_TEXT},LegalAddress:{_ADDRESS},"
    f"HeadquartersAddress:{_ADDRESS},EntityStatus:{_TEXT},"
    f"RegistrationAuthority:array<struct<RegistrationAuthorityID:{_TEXT}>>>>"
)
_RELATION = (
    f"Relationship array<struct<StartNode:{_NODE},EndNode:{_NODE},"
    f"RelationshipPeriods:array<struct<RelationshipPeriod:array<{_PERIOD}>>>,"
    f"RelationshipType:{_TEXT},RelationshipStatus:{_TEXT}>>"
)
_EXCEPTION = (
    f"LEI {_TEXT}, ExceptionCategory {_TEXT}, ExceptionReason {_TEXT}, NextVersion {_TEXT}"
)


def _first(path: str) -> Column:
    """Text at a dotted path, taking the first element at every step."""
    column = F.col("_record")
    for step in path.split("."):
        column = F.get(column[step], F.lit(0))
    return text_or_null(column)


def _header_leaf(header: Column, fields: list[str]) -> Column:
    """Leaf texts of a header element, `<r>…</r>`."""
    return F.from_xml(header, ", ".join(f"{f} {_TEXT}" for f in fields), _OPTIONS)


def read_header(
    spark: SparkSession,
    path: str,
    header: str = ENTITY_HEADER,
    fields: tuple[str, ...] = ("ContentDate", "FileContent", "RecordCount"),
    tag: str = ENTITY_TAG,
) -> DataFrame:
    """One row per file: leaf texts of its first header element."""
    found = split_table(spark, path, tag, header).where(F.col("_note").isNotNull())
    found = found.withColumn("_leaf", _header_leaf(F.col("_note"), list(fields)))
    columns = [text_or_null(F.try_element_at(F.col("_leaf")[f], F.lit(-1))).alias(f) for f in fields]
    return found.select(F.col("_name").alias("source_file"), *columns)


def snapshot_date(
    spark: SparkSession, path: str, header: str = ENTITY_HEADER, tag: str = ENTITY_TAG
) -> DataFrame:
    """Content date of every file."""
    return read_header(spark, path, header, ("ContentDate",), tag).withColumnRenamed(
        "ContentDate", "source_snapshot_date"
    )


def _dated(table: DataFrame) -> DataFrame:
    """Splits with the content date of their header."""
    date = F.try_element_at(_header_leaf(F.col("_note"), ["ContentDate"])["ContentDate"], F.lit(-1))
    return table.withColumn("_date", text_or_null(date))


def _records(
    spark: SparkSession, path: str, tag: str, header: str, schema: str, counters: Observation | None = None
) -> DataFrame:
    """Parsed records with ordinal, snapshot date and file; bad ones and, without an ordinal, those
    that are never closed included. `counters` sees them as they pass."""
    cut = cut_records(spark, path, tag, _dated(split_table(spark, path, tag, header)))
    record = F.from_xml(
        F.concat(F.lit("<r>"), "body", F.lit("</r>")), f"{schema}, {_BROKEN} string", _OPTIONS
    )
    # explode keeps the parser from being planned again in filters above
    parsed = cut.select(
        "row_id", F.col("_date").alias("source_snapshot_date"), "source_file", "body", F.explode(F.array(record)).alias("_record")
    )
    if counters is None:
        return parsed
    sound = F.col("row_id").isNotNull() & F.col(f"_record.{_BROKEN}").isNull()
    return parsed.observe(
        counters, F.count("*").alias("rows_seen"), F.count_if(sound).alias("rows_written"),
        F.count_if(~sound).alias("skipped_rows"),
    )


def count_unclosed(spark: SparkSession, path: str, tag: str = ENTITY_TAG) -> int:
    """Records that are opened and never closed, as at the end of a truncated file; each file counts
    for itself."""
    table = split_table(spark, path, tag, _HEADERS.get(tag, ""))
    return cut_records(spark, path, tag, _dated(table)).where("row_id is null").count()


def _sound(records: DataFrame, on_bad: str, path: str, tag: str) -> DataFrame:
    """Readable records. With `on_bad` "fail", a bad one stops the job and an unclosed one the call."""
    broken = F.col(f"_record.{_BROKEN}")
    if on_bad == "skip":
        return records.where(F.col("row_id").isNotNull() & broken.isNull())
    if on_bad != "fail":
        raise ValueError(f"on_bad must be skip or fail, not {on_bad}")
    if unclosed := count_unclosed(records.sparkSession, path, tag):
        raise ValueError(f"{unclosed} {tag} records in {path} are not closed")
    stop = F.raise_error(F.concat(F.lit("unreadable record: "), F.substring(broken, 1, 200)))
    return records.where(F.when(broken.isNull(), True).otherwise(stop.cast("boolean")))


def read_entities_xml(
    spark: SparkSession, path: str, tag: str = ENTITY_TAG, header: str = ENTITY_HEADER,
    on_bad: str = "skip", counters: Observation | None = None,
) -> DataFrame:
    """Legal entities with cleaned names, one row per record.

    Bad records are left out, or stop the job with `on_bad` "fail". `counters`, an Observation, holds
    rows_seen, rows_written and skipped_rows after the first action on the result.
    """
    rows = _sound(_records(spark, path, tag, header, _ENTITY, counters), on_bad, path, tag).select(
        "row_id",
        _first("LEI").alias("lei"),
        _first("Entity.LegalName").alias("legal_name"),
        _first("Entity.EntityStatus").alias("entity_status"),
        _first("Entity.RegistrationAuthority.RegistrationAuthorityID").alias(
            "registration_authority"
        ),
        _first("Entity.LegalAddress.Country").alias("legal_address_country"),
        _first("Entity.HeadquartersAddress.Country").alias("headquarters_country"),
        "source_snapshot_date",
        "source_file",
    )
    return rows.select(
        "row_id",
        "lei",
        "legal_name",
        clean_name("legal_name").alias("legal_name_clean"),
        entity_country("headquarters_country", "legal_address_country").alias("country"),
        "entity_status",
        "registration_authority",
        "legal_address_country",
        "headquarters_country",
        "source_snapshot_date",
        "source_file",
    )


def first_period(field: str) -> Column:
    """Text of a field of the first relationship period."""
    return _first(f"Relationship.RelationshipPeriods.RelationshipPeriod.{field}")


def read_relationships_xml(
    spark: SparkSession, path: str, tag: str = RELATION_TAG, header: str = RELATION_HEADER,
    on_bad: str = "skip", counters: Observation | None = None,
) -> DataFrame:
    """Parent and child per relationship; the start node is the child."""
    return _sound(_records(spark, path, tag, header, _RELATION, counters), on_bad, path, tag).select(
        "row_id",
        _first("Relationship.EndNode.NodeID").alias("parent_lei"),
        _first("Relationship.StartNode.NodeID").alias("child_lei"),
        _first("Relationship.RelationshipType").alias("relationship_type"),
        _first("Relationship.RelationshipStatus").alias("relationship_status"),
        first_period("StartDate").alias("start_date"),
        first_period("EndDate").alias("end_date"),
        first_period("PeriodType").alias("period_type"),
        "source_snapshot_date",
        "source_file",
    )


def read_exceptions_xml(
    spark: SparkSession,
    path: str | None,
    tag: str = EXCEPTION_TAG,
    header: str = EXCEPTION_HEADER,
    on_bad: str = "skip", counters: Observation | None = None,
) -> DataFrame | None:
    """Reporting exceptions; without a path there is nothing to read."""
    if path is None:
        return None
    return _sound(_records(spark, path, tag, header, _EXCEPTION, counters), on_bad, path, tag).select(
        "row_id",
        _first("LEI").alias("lei"),
        _first("ExceptionCategory").alias("exception_category"),
        _first("ExceptionReason").alias("exception_reason"),
        _first("NextVersion").alias("next_version"),
        "source_snapshot_date",
        "source_file",
    )


_SCHEMAS = {ENTITY_TAG: _ENTITY, RELATION_TAG: _RELATION, EXCEPTION_TAG: _EXCEPTION}
_HEADERS = {
    ENTITY_TAG: ENTITY_HEADER, RELATION_TAG: RELATION_HEADER, EXCEPTION_TAG: EXCEPTION_HEADER,
}


def parse_counters(spark: SparkSession, path: str, tag: str = ENTITY_TAG) -> DataFrame:
    """One row: records seen, written, and skipped as unreadable or not closed.

    The counters of one reading pass: the records go to a sink that discards them. To have them from
    a pass that writes, give `counters` to the reader.
    """
    counters = Observation()
    _records(spark, path, tag, _HEADERS[tag], _SCHEMAS[tag], counters).write.format("noop").mode("overwrite").save()
    seen = counters.get
    return spark.range(1).select(*[F.lit(seen[c]).cast("long").alias(c) for c in ("rows_seen", "rows_written", "skipped_rows")])


def bad_records(spark: SparkSession, path: str, tag: str = ENTITY_TAG, n: int = 20) -> DataFrame:
    """The first n unreadable records with number, file and text; then those that are never closed,
    which have no number."""
    records = _records(spark, path, tag, _HEADERS[tag], _SCHEMAS[tag])
    broken = F.col(f"_record.{_BROKEN}")
    return (
        records.where(broken.isNotNull() | F.col("row_id").isNull())
        .select("row_id", "source_file", F.when(F.col("row_id").isNull(), F.col("body")).otherwise(broken).alias("record"))
        .orderBy(F.col("row_id").asc_nulls_last(), "source_file").limit(n)
    )
