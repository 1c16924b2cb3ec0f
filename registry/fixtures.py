"""Company lists, registers and relationships derived from the given tables.

Every fixture covers all rows of its tables and whole texts; `oracles.py` states
the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.functions.names import clean_name

SENTENCE_BREAK = r"[.\n|]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A text has fewer pieces than this, whatever its length.
PIECES = 1 << 31


def place(number: str) -> Column:
    """Ordinal of a piece of a row: rows in order of `number`, pieces by position."""
    return F.col(number) * PIECES + F.col("pos")


def talk_place() -> Column:
    """Ordinal of a piece of a turn; what the packing cannot hold is an error."""
    fits = (F.col("turn") >= 0) & (F.col("turn") < 1 << 12) & (F.col("pos") < 1 << 24)
    packed = (F.col("conv_id") * (1 << 12) + F.col("turn")) * (1 << 24) + F.col("pos")
    wrong = F.raise_error(F.lit("more turns or sentences than an ordinal holds")).cast("long")
    return F.when(fits, packed).otherwise(wrong)


def code(prefix: str, number: Column | str) -> Column:
    """Prefix and number, shorter numbers filled up to nine digits."""
    number = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(number) < 9, F.lpad(number, 9, "0")).otherwise(number))


def entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register from all parts: legal forms at both ends, accents, near-equal names."""
    size = F.col("p_size")
    words = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    words = F.when(size % 3 == 0, F.replace(words, F.lit("e"), F.lit("é"))).otherwise(words)
    form = (
        F.when(size % 8 == 0, ", Inc.").when(size % 8 == 1, " S.p.A.").when(size % 8 == 2, " GmbH")
        .when(size % 8 == 3, " & Co. Ltd").when(size % 8 == 5, " Tbk").when(size % 8 == 6, "")
        .otherwise(" Holdings")
    )
    name = F.concat(F.when(size % 8 == 4, "PT ").otherwise(""), words, form)
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("row_id"),
        F.when(size == 50, "").otherwise(code("E", "p_partkey")).alias("lei"),
        name.alias("legal_name"),
        clean_name(name).alias("legal_name_clean"),
        F.when(size == 19, F.lit(None))
        .otherwise(F.concat(F.lit("Nation_"), (F.col("p_partkey") % 25).cast("string")))
        .alias("country"),
    )


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company list from all parts: reordered, shortened and extended names."""
    key, size = F.col("p_partkey"), F.col("p_size")
    kind = F.col("p_type")
    name = (
        F.when(size == 7, "***")
        .when(size == 13, "0zq nobody")
        .when(key % 3 == 0, F.concat_ws(" ", "p_brand", "p_name", kind))
        .when(
            key % 3 == 1,
            F.concat_ws(" ", "p_name", "p_brand", F.expr("substr(p_type, 1, length(p_type) - 1)"), F.lit("Inc")),
        )
        .when(size % 2 == 0, F.concat_ws(" ", "p_name", "p_brand", kind, F.lit("group")))
        .otherwise(F.concat_ws(" ", "p_name", "p_brand", kind, F.lit("Ltd")))
    )
    country = (
        F.when(size == 20, "")
        .when(key % 2 == 0, F.concat(F.lit(" nation_"), (key % 25).cast("string")))
        .otherwise(F.concat(F.lit("Land "), (key % 5).cast("string")))
    )
    return table(spark, sf_dir, "part").select(
        key.alias("ord"),
        code("S", "p_partkey").alias("source_id"),
        name.alias("source_name"),
        country.alias("source_country"),
        F.lit("").alias("source_sector"),
        F.lit("").alias("source_notes"),
    )


def sentences(df: DataFrame, text: str, *columns: Column | str) -> DataFrame:
    """All sentences of a text column, empty ones too, with their position."""
    return df.select(*columns, F.posexplode(F.split(text, SENTENCE_BREAK)).alias("pos", "sentence"))


def text_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register whose names are all sentences of all documents."""
    rows = sentences(table(spark, sf_dir, "documents"), "text", "doc_id", "lang")
    return rows.select(
        (place("doc_id") + 1).alias("row_id"),
        F.concat_ws("-", F.lit("D"), "doc_id", "pos").alias("lei"),
        F.col("sentence").alias("legal_name"),
        clean_name("sentence").alias("legal_name_clean"),
        F.upper("lang").alias("country"),
    )


def title_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company list of all page titles, with the language of the address as country."""
    return table(spark, sf_dir, "pages").select(
        code("P", "page_id").alias("source_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("source_name"),
        F.split_part("url", F.lit("/"), F.lit(4)).alias("source_country"),
        F.lit("").alias("source_sector"),
        F.lit("").alias("source_notes"),
    )


def base_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base company list: all sentences of all documents."""
    rows = sentences(table(spark, sf_dir, "documents"), "text", "doc_id", "lang", "source")
    return rows.select(
        place("doc_id").alias("ordinal"),
        F.col("sentence").alias("Company Name"),
        F.col("lang").alias("Country"),
        F.col("source").alias("Industry (main)"),
    )


def member_lists(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three member lists: conversation sentences, benchmark sentences, page titles."""
    talk = sentences(table(spark, sf_dir, "conversations"), "text", "conv_id", "turn", "role")
    facts = sentences(table(spark, sf_dir, "benchmark"), "text", "item_id")
    pages = table(spark, sf_dir, "pages")
    return [
        talk.select(
            talk_place().alias("ordinal"),
            F.col("sentence").alias("Member name"),
            F.col("role").alias("Sector"),
        ),
        facts.select(
            place("item_id").alias("ordinal"),
            F.col("sentence").alias("Organization"),
        ),
        pages.select(
            F.col("page_id").alias("ordinal"),
            F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"),
            F.split_part("url", F.lit("/"), F.lit(4)).alias("HQ location"),
            F.col("url").alias("Web-Link"),
        ),
    ]


def relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships from all line items: duplicates, self-loops, blank ends, odd dates."""
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.when((quantity == 50) & (number == 1), "")
        .when((quantity == 49) & (number == 1), F.lit(None))
        .otherwise(code("E", "l_suppkey"))
        .alias("parent_lei"),
        code("E", "l_partkey").alias("child_lei"),
        F.concat(F.lit("REL_"), "l_returnflag").alias("relationship_type"),
        F.when(number == 7, "").when(number == 6, "unknown")
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("start_date"),
    )


def node_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register for the network: all customers, so some edge ends have no node."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("row_id"),
        code("E", "c_custkey").alias("lei"),
        F.col("c_name").alias("legal_name"),
        clean_name("c_name").alias("legal_name_clean"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("country"),
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match results to sample from: all documents, groups of very different size."""
    rest = F.col("doc_id") % 10
    return table(spark, sf_dir, "documents").select(
        code("S", "doc_id").alias("source_id"),
        F.col("source").alias("source_name_raw"),
        F.col("source").alias("source_name_clean"),
        F.when(rest < 7, code("E", "doc_id")).otherwise("").alias("matched_lei"),
        F.col("lang").alias("matched_legal_name"),
        F.when(rest == 9, F.lit(None)).otherwise((F.col("n_chars") % 101).cast("double")).alias("match_score"),
        F.lit("exact").alias("score_type"),
        F.when(rest < 6, "auto").when(rest == 6, "Review").otherwise("unmatched").alias("match_status"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed samples: all documents with their labels; mixed case, padding, blanks."""
    doc, mark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = doc.select("doc_id", "source", "lang", "n_chars").join(mark, "doc_id", "left")
    third = F.col("doc_id") % 3
    return rows.select(
        F.when(third == 0, "auto").when(third == 1, "Review").otherwise("unmatched ").alias("sample_group"),
        code("S", "doc_id").alias("source_id"),
        F.col("source").alias("source_name_raw"),
        code("E", "doc_id").alias("matched_lei"),
        F.col("lang").alias("matched_legal_name"),
        F.col("n_chars").cast("double").alias("match_score"),
        F.when(F.col("quality").isNull(), "").when(F.col("toxic") == 1, "uncertain")
        .when(F.col("quality") == 1, " Correct ").otherwise("INCORRECT").alias("label"),
        F.when(F.col("quality").isNull() | (F.col("doc_id") % 6 == 0), "")
        .otherwise(F.concat(F.lit("reason "), (F.col("doc_id") % 5).cast("string")))
        .alias("notes"),
    )


def ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of owners from all orders: up to 63 steps, some companies with two owners, some circles."""
    key, place = F.col("o_orderkey"), F.col("o_orderkey") % 64
    block = F.floor(key / 64) % 10
    owners = F.array(
        F.when(place > 0, key - 1).when(block == 3, key + 5),
        F.when((place > 1) & (F.col("o_orderstatus") == "F"), key - 2),
        F.when((block == 7) & (place == 5), key + 3),
    )
    rows = table(spark, sf_dir, "orders").select(key.alias("key"), F.explode(owners).alias("owner"))
    return rows.where("owner is not null").select(code("E", "key").alias("firm_i"), code("E", "owner").alias("firm_j"))
