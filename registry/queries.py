"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.functions import names, similarity
from firmloom.functions.text import blank_na
from firmloom.operators import blocking, checks, dedupe, evaluation, existence, graph, membership, ownership, quality
from firmloom.operators.ordinals import dense_ordinal, file_ordinal, surrogate_id
from firmloom.operators.scoring import score_candidates, top_candidates
from firmloom.operators.skew import Volume, measure
from firmloom.operators.whole_blocks import whole_block_matches
from firmloom.plans import match, source_list
from firmloom.plans.evaluate import evaluate_matches, review_samples
from firmloom.plans.network import build_network, network_report
from firmloom.plans.rematch import rematch, rematch_crosswalk
from firmloom.plans.run_metrics import run_metrics
from firmloom.sources import lists, tables, xml_records
from registry import fixtures as fx
from registry import xml_files
from registry.scratch import scratch_path

ACCESSED = "2026-01-31"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- sources and sinks


def _file_checked(rows):
    """Names of written files differ from run to run; what they have in common is checked."""
    return rows.withColumn("source_file", F.regexp_replace("source_file", r"^part-\d{5}-[0-9a-f-]{36}-c000\.txt(\.gz)?$", "part"))


@query
def read_entities_xml(spark, sf_dir):
    return _file_checked(xml_records.read_entities_xml(spark, xml_files.entities(spark, sf_dir)))


@query
def read_relationships_xml(spark, sf_dir):
    path = xml_files.relations(spark, sf_dir)
    return _file_checked(xml_records.read_relationships_xml(spark, path))


@query
def first_period(spark, sf_dir):
    path = xml_files.relations(spark, sf_dir)
    rows = xml_records.read_relationships_xml(spark, path)
    return rows.select("row_id", "start_date", "end_date", "period_type")


@query
def read_exceptions_xml(spark, sf_dir):
    path = xml_files.exceptions(spark, sf_dir)
    return _file_checked(xml_records.read_exceptions_xml(spark, path))


@query
def snapshot_date(spark, sf_dir):
    path = xml_files.entities(spark, sf_dir)
    header = xml_records.read_header(spark, path, fields=("ContentDate", "FileContent"))
    return header.select("ContentDate", "FileContent").distinct()


@query
def parse_counters(spark, sf_dir):
    path = xml_files.relations(spark, sf_dir)
    return xml_records.parse_counters(spark, path, xml_records.RELATION_TAG)


@query
def read_register(spark, sf_dir):
    path = scratch_path(spark, "register")
    tables.write_table(fx.entity(spark, sf_dir), path)
    return tables.read_register(spark, path, ["row_id", "lei", "legal_name_clean", "country"])


@query
def read_register_csv(spark, sf_dir):
    path = scratch_path(spark, "register")
    tables.write_table(fx.entity(spark, sf_dir), path, "csv")
    return tables.read_register(spark, path, ["lei", "legal_name", "country"], "csv")


@query
def csv_round_trip(spark, sf_dir):
    """Texts with spaces, tabs, quotes, commas, backslashes and line breaks, written and read as CSV."""
    path = scratch_path(spark, "texts")
    odd = F.concat(F.lit("\t  "), F.coalesce("text", F.lit("")), F.lit(' "q", \\\n '))
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), odd.alias("text"))
    tables.write_table(docs, path, "csv")
    return tables.read_register(spark, path, ["doc_id", "text"], "csv", multi_line=True)


@query
def csv_split_list(spark, sf_dir):
    """All document texts as one member list with line breaks, read by many tasks, in file order."""
    path = scratch_path(spark, "texts")
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("Company Name"), F.concat(F.lit("<"), F.coalesce("text", F.lit("")), F.lit(">")).alias("Notes"))
    number = F.col("Company Name").cast("long")
    tables.write_table(docs.repartitionByRange(number).sortWithinPartitions(number), path, "csv")
    read = tables.read_member_list(spark, path, multi_line=True)
    return read.select("ordinal", F.col("Company Name").alias("name"), F.md5("Notes").alias("notes_md5"))


@query
def read_member_list(spark, sf_dir):
    path = scratch_path(spark, "list")
    rows = fx.member_lists(spark, sf_dir)[2].repartitionByRange("ordinal").sortWithinPartitions("ordinal")
    tables.write_table(rows.drop("ordinal"), path, "csv")
    read = tables.read_member_list(spark, path)
    return lists.standard_headers(read)


@query
def write_table(spark, sf_dir):
    path = scratch_path(spark, "edges")
    tables.write_table(graph.to_edges(fx.relation(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def write_metrics(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    edges = graph.to_edges(fx.relation(spark, sf_dir))
    tables.write_metrics(graph.network_stats(fx.node_entity(spark, sf_dir), edges), path)
    return spark.read.json(path)


# ---- names and columns


@query
def normalize_name(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", names.normalize_name("text").alias("name"))


@query
def strip_legal_forms(spark, sf_dir):
    rows = fx.entity(spark, sf_dir)
    return rows.select(
        "row_id", names.strip_legal_forms(names.normalize_name("legal_name")).alias("name")
    )


@query
def clean_name(spark, sf_dir):
    return fx.text_entity(spark, sf_dir).select("row_id", "legal_name_clean")


@query
def parse_year(spark, sf_dir):
    rows = fx.relation(spark, sf_dir).select("start_date", names.parse_year("start_date").alias("year"))
    return rows.groupBy("start_date", "year").agg(F.count("*").alias("n"))


@query
def standard_header(spark, sf_dir):
    return lists.standard_headers(fx.base_list(spark, sf_dir))


@query
def pick_columns(spark, sf_dir):
    return lists.pick_columns(fx.member_lists(spark, sf_dir)[2])


@query
def member_frame(spark, sf_dir):
    return lists.member_frame(fx.base_list(spark, sf_dir), lists.BASE_SPEC, ACCESSED)


@query
def member_frames(spark, sf_dir):
    """The frames of all three member lists, each with its own headers, flag and note."""
    frames = [
        lists.member_frame(df, spec, ACCESSED).withColumn("list_no", F.lit(number))
        for number, (spec, df) in enumerate(zip(lists.MEMBER_SPECS, fx.member_lists(spark, sf_dir)), 1)
    ]
    return quality.stack(frames)


@query
def read_member_lists(spark, sf_dir):
    """All three member lists written as CSV and read in file order, whole texts with line breaks."""
    found = []
    for number, rows in enumerate(fx.member_lists(spark, sf_dir), 1):
        path = scratch_path(spark, "list")
        ordered = rows.repartitionByRange("ordinal").sortWithinPartitions("ordinal")
        tables.write_table(ordered.drop("ordinal"), path, "csv")
        read = lists.pick_columns(tables.read_member_list(spark, path, multi_line=True))
        found.append(read.withColumn("list_no", F.lit(number)))
    return quality.stack(found)


@query
def entity_country(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders")
    return rows.select(
        "o_orderkey",
        names.entity_country(
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")), F.col("o_orderstatus")
        ).alias("country"),
    )


@query
def blank_na_cells(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events")
    token = F.element_at(
        F.array(*[F.lit(x) for x in ("NA", "null", " x ", "", "N/A", "na", " NA")]),
        (F.col("event_id") % 7 + 1).cast("int"),
    )
    cell = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(token)
    return rows.select("event_id", blank_na(cell).alias("cell"))


@query
def block_columns(spark, sf_dir):
    return match.prepare_entities(fx.entity(spark, sf_dir)).select(
        "row_id",
        "country_norm",
        blocking.first_char("legal_name_clean").alias("first_char"),
        blocking.first_token("legal_name_clean").alias("first_token"),
    )


@query
def blocking_label(spark, sf_dir):
    rows = match.prepare_sources(fx.source(spark, sf_dir))
    return rows.select(
        "source_id", blocking.blocking_label("country_norm", "name_clean").alias("blocking_keys")
    )


@query
def row_id(spark, sf_dir):
    path = scratch_path(spark, "documents")
    rows = fx.table(spark, sf_dir, "documents")
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return file_ordinal(spark.read.parquet(path)).select("row_id", "doc_id")


@query
def surrogate_ids(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("list_no"), (F.col("l_orderkey") * 3).alias("ordinal")
    ).groupBy("list_no", "ordinal").agg(F.count("*").alias("n"))
    numbered = dense_ordinal(rows, "list_no", "ordinal", "place", ways=64)
    return numbered.select("list_no", "ordinal", surrogate_id("place").alias("source_id"))


@query
def to_edges(spark, sf_dir):
    return graph.to_edges(fx.relation(spark, sf_dir))


# ---- filters


@query
def nonblank_key(spark, sf_dir):
    return match.prepare_entities(fx.entity(spark, sf_dir)).select("row_id", "lei")


@query
def nonblank_name(spark, sf_dir):
    rows = fx.base_list(spark, sf_dir).withColumnRenamed("Company Name", "name")
    return checks.nonblank(rows, "name").select("ordinal", "name")


@query
def nonblank_endpoints(spark, sf_dir):
    edges = graph.to_edges(fx.relation(spark, sf_dir))
    return checks.nonblank_endpoints(edges)


@query
def without_self_edges(spark, sf_dir):
    return checks.without_self_edges(graph.to_edges(fx.relation(spark, sf_dir)))


# ---- matching


def _matches(spark, sf_dir):
    return match.match_table(fx.source(spark, sf_dir), fx.entity(spark, sf_dir), scratch=scratch_path(spark, "match"))


def _walk(spark, sf_dir):
    return rounded(match.crosswalk(_matches(spark, sf_dir)), "match_score")


def _sets(spark, sf_dir):
    return blocking.candidate_sets(
        match.prepare_sources(fx.source(spark, sf_dir)),
        match.prepare_entities(fx.entity(spark, sf_dir)),
    )


@query
def match_crosswalk(spark, sf_dir):
    return _walk(spark, sf_dir)


@query
def match_crosswalk_capped(spark, sf_dir):
    """Exact test, too, only among the scored rows of a block."""
    rules = blocking.BlockingRules(exact_in_cap=True)
    found = match.match_table(fx.source(spark, sf_dir), fx.entity(spark, sf_dir), rules)
    return rounded(match.crosswalk(found), "match_score")


@query
def fuzzy_match_whole(spark, sf_dir):
    """As match_crosswalk, with the best candidates of the whole block instead of its first 50 rows."""
    rules = blocking.BlockingRules(max_candidates=None)
    found = match.match_table(
        fx.source(spark, sf_dir), fx.entity(spark, sf_dir), rules, scratch=scratch_path(spark, "whole")
    )
    return rounded(match.crosswalk(found), "match_score")


@query
def rematch_changed(spark, sf_dir):
    """As match_crosswalk: a run on another register, then this one, in which only touched blocks are matched."""
    source, entity = fx.source(spark, sf_dir), fx.entity(spark, sf_dir)
    # before, some rows were not there, some had other names, and some sources were not asked for
    before = entity.where(F.col("row_id") % 97 != 5).withColumn(
        "legal_name_clean",
        F.when(F.col("row_id") % 89 == 7, F.concat(F.lit("old "), "legal_name_clean")).otherwise(F.col("legal_name_clean")),
    )
    earlier, now = scratch_path(spark, "earlier"), scratch_path(spark, "now")
    rematch(source.where("ord % 50 <> 3"), before, earlier)
    return rounded(rematch_crosswalk(source, entity, now, earlier), "match_score")


@query
def top_scores_whole(spark, sf_dir):
    """The three best candidates of every source's whole block."""
    found = whole_block_matches(
        match.prepare_sources(fx.source(spark, sf_dir)), match.prepare_entities(fx.entity(spark, sf_dir)),
        blocking.BlockingRules(max_candidates=None), scratch=scratch_path(spark, "whole"),
    )
    return rounded(top_candidates(found), "token_sort_ratio", "token_set_ratio", "combined_score")


def _large(frame):
    """The measured volume, handled like one that is too large to broadcast."""
    return replace(measure(frame), row_limit=-1)


@query
def match_crosswalk_large(spark, sf_dir):
    """As match_crosswalk, by the joins for long company lists."""
    source = fx.source(spark, sf_dir)
    volume = _large(match.prepare_sources(source).select(*blocking.SOURCE))
    found = match.match_table(source, fx.entity(spark, sf_dir), volume=volume)
    return rounded(match.crosswalk(found), "match_score")


@query
def match_page_titles(spark, sf_dir):
    found = match.match_table(
        fx.title_source(spark, sf_dir), fx.text_entity(spark, sf_dir), scratch=scratch_path(spark, "titles")
    )
    return rounded(match.crosswalk(found), "match_score")


@query
def block_candidates(spark, sf_dir):
    return blocking.block_candidates(
        match.prepare_sources(fx.source(spark, sf_dir)),
        match.prepare_entities(fx.entity(spark, sf_dir)),
    )


@query
def block_candidates_large(spark, sf_dir):
    """As block_candidates, by the joins for long company lists."""
    sources = match.prepare_sources(fx.source(spark, sf_dir))
    volume = _large(sources.select(*blocking.SOURCE))
    return blocking.block_candidates(sources, match.prepare_entities(fx.entity(spark, sf_dir)), volume=volume)


@query
def cap_block(spark, sf_dir):
    entities = match.prepare_entities(fx.entity(spark, sf_dir))
    keyed = blocking.with_keys(
        entities, [*blocking.BlockingRules().levels(), blocking.ALL_ROWS], "country_norm", "legal_name_clean"
    )
    return blocking.cap_block(keyed.select(*blocking.BLOCK, "row_id"), 50)


@query
def exact_match(spark, sf_dir):
    return _walk(spark, sf_dir).where("match_method = 'exact'").select(
        "source_id", "matched_lei", "matched_legal_name_clean", "match_score", "score_type",
        "match_status",
    )


@query
def exact_title_match(spark, sf_dir):
    found = match_page_titles(spark, sf_dir)
    return found.where("match_method = 'exact'").select("source_id", "matched_lei", "match_score")


@query
def fuzzy_match(spark, sf_dir):
    return _walk(spark, sf_dir).where("match_method = 'fuzzy'").select(
        "source_id", "matched_lei", "match_score", "score_type", "match_status", "notes"
    )


@query
def no_candidates(spark, sf_dir):
    """All sources against a register without names, so no candidate can be scored."""
    bare = fx.entity(spark, sf_dir).withColumn("legal_name_clean", F.lit(""))
    walk = match.crosswalk(match.match_table(fx.source(spark, sf_dir), bare))
    return walk.select("source_id", "match_method", "match_status", "match_score", "notes")


@query
def empty_name_source(spark, sf_dir):
    return _walk(spark, sf_dir).where("source_name_clean = ''")


def _pairs(spark, sf_dir):
    source = match.prepare_sources(fx.source(spark, sf_dir))
    entity = fx.entity(spark, sf_dir).select(
        fx.code("S", F.col("row_id") - 1).alias("source_id"),
        "legal_name_clean",
    )
    return source.join(entity, "source_id")


@query
def token_sort_ratio(spark, sf_dir):
    score = similarity.token_sort_ratio("name_clean", "legal_name_clean")
    return _pairs(spark, sf_dir).select("source_id", F.round(score, 6).alias("score"))


@query
def token_set_ratio(spark, sf_dir):
    score = similarity.token_set_ratio("name_clean", "legal_name_clean")
    return _pairs(spark, sf_dir).select("source_id", F.round(score, 6).alias("score"))


@query
def combined_score(spark, sf_dir):
    score = similarity.combined_score("name_clean", "legal_name_clean")
    return _pairs(spark, sf_dir).select("source_id", F.round(score, 6).alias("score"))


@query
def match_status(spark, sf_dir):
    rows = fx.crosswalk(spark, sf_dir)
    return rows.select("source_id", similarity.match_status("match_score").alias("status"))


@query
def top_scores(spark, sf_dir):
    top = top_candidates(score_candidates(_sets(spark, sf_dir)))
    return rounded(top, "token_sort_ratio", "token_set_ratio", "combined_score")


@query
def review_candidates(spark, sf_dir):
    rows = match.review_candidates(_matches(spark, sf_dir))
    return rounded(rows, "token_sort_ratio", "token_set_ratio", "combined_score")


@query
def match_summary(spark, sf_dir):
    return rounded(match.match_summary(_walk(spark, sf_dir)), "overall_auto_rate")


@query
def score_distribution(spark, sf_dir):
    return rounded(
        match.score_distribution(match.crosswalk(_matches(spark, sf_dir))),
        "min", "p25", "median", "p75", "max",
    )


# ---- company list


def _list_inputs(spark, sf_dir):
    return fx.base_list(spark, sf_dir), fx.member_lists(spark, sf_dir)


def _merge(spark, sf_dir, count):
    base, members = _list_inputs(spark, sf_dir)
    unique = membership.dedupe_members(lists.member_frame(base, lists.BASE_SPEC, ACCESSED))
    specs = lists.MEMBER_SPECS[:count]
    frames = [(s, lists.member_frame(df, s, ACCESSED)) for s, df in zip(specs, members)]
    return membership.merge_membership(unique, frames, scratch=scratch_path(spark, "merge"))


@query
def dedupe_keep_first(spark, sf_dir):
    base, _ = _list_inputs(spark, sf_dir)
    frame = lists.member_frame(base, lists.BASE_SPEC, ACCESSED)
    return membership.dedupe_members(frame).select(
        "ordinal", "source_name", "source_name_clean", "source_country_norm"
    )


@query
def merge_membership(spark, sf_dir):
    return _merge(spark, sf_dir, 3).rows


@query
def merge_counts(spark, sf_dir):
    return _merge(spark, sf_dir, 3).counts


@query
def build_source_list(spark, sf_dir):
    return source_list.build_source_list(*_list_inputs(spark, sf_dir), ACCESSED, scratch=scratch_path(spark, "build"))


@query
def build_source_list_large(spark, sf_dir):
    """As build_source_list, by the joins for long membership lists."""
    base, members = _list_inputs(spark, sf_dir)
    return source_list.build_source_list(
        base, members, ACCESSED, volume=Volume(1, 1, row_limit=-1), scratch=scratch_path(spark, "build")
    )


@query
def build_counts(spark, sf_dir):
    return source_list.build_counts(*_list_inputs(spark, sf_dir), ACCESSED, scratch=scratch_path(spark, "build"))


# ---- network


def _edges(spark, sf_dir):
    return graph.to_edges(fx.relation(spark, sf_dir))


def _nodes(spark, sf_dir):
    return build_network(fx.node_entity(spark, sf_dir), fx.relation(spark, sf_dir))[0]


def _report(spark, sf_dir):
    return network_report(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query
def in_relationships(spark, sf_dir):
    return _nodes(spark, sf_dir)


@query
def nodes_in_network(spark, sf_dir):
    return graph.nodes_in_network(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query
def missing_nodes(spark, sf_dir):
    return graph.missing_nodes(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query
def missing_examples(spark, sf_dir):
    return _report(spark, sf_dir)["missing_examples"]


@query
def endpoint_difference(spark, sf_dir):
    nodes, edges = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    return graph.missing_nodes(nodes, edges).agg(F.count("*").alias("missing_node_info_count"))


@query
def distinct_edges(spark, sf_dir):
    return graph.distinct_edges(_edges(spark, sf_dir))


@query
def distinct_pairs(spark, sf_dir):
    return graph.distinct_pairs(_edges(spark, sf_dir))


@query
def endpoints(spark, sf_dir):
    return graph.endpoints(_edges(spark, sf_dir))


@query
def undirected_pairs(spark, sf_dir):
    return graph.undirected_pairs(_edges(spark, sf_dir))


@query
def neighbours(spark, sf_dir):
    return graph.neighbours(_edges(spark, sf_dir))


@query
def out_degree(spark, sf_dir):
    return graph.out_degree(_edges(spark, sf_dir))


@query
def in_degree(spark, sf_dir):
    return graph.in_degree(_edges(spark, sf_dir))


@query
def undirected_degree(spark, sf_dir):
    return graph.undirected_degree(_edges(spark, sf_dir))


@query
def degree_summary(spark, sf_dir):
    return _report(spark, sf_dir)["degree_summary"]


@query
def top_out_degree(spark, sf_dir):
    return _report(spark, sf_dir)["top_out_degree"]


@query
def top_in_degree(spark, sf_dir):
    return _report(spark, sf_dir)["top_in_degree"]


@query
def network_stats(spark, sf_dir):
    return _report(spark, sf_dir)["stats"]


@query
def head_sample_edges(spark, sf_dir):
    return dedupe.head_sample(_edges(spark, sf_dir), ["firm_i", "firm_j", "relation_type", "year"])


@query
def head_sample_network_nodes(spark, sf_dir):
    nodes = graph.nodes_in_network(_nodes(spark, sf_dir), _edges(spark, sf_dir))
    return dedupe.head_sample(nodes, ["lei"], 200)


@query
def head_sample_crosswalk(spark, sf_dir):
    return dedupe.head_sample(_walk(spark, sf_dir), ["source_id"])


@query
def head_sample(spark, sf_dir):
    return dedupe.head_sample(fx.entity(spark, sf_dir), ["row_id"])


@query
def nodes_in_network_bitmap(spark, sf_dir):
    """As nodes_in_network, with a bitmap of the ends at the scan of the nodes."""
    ends = checks.nonblank_endpoints(_edges(spark, sf_dir))
    return existence.semi_join(_nodes(spark, sf_dir), [(ends, "firm_i"), (ends, "firm_j")], "lei", ["legal_name"])


@query
def endpoint_names_bucketed(spark, sf_dir):
    """Register rows by LEI for both ends of every relationship, from a register bucketed by LEI."""
    path = scratch_path(spark, "bucketed")
    register = match.prepare_entities(fx.entity(spark, sf_dir)).select("lei", "legal_name_clean")
    name = f"firmloom_{uuid.uuid4().hex}"
    bucketed = tables.write_bucketed(register, name, path, ["lei"], 64)
    ends = graph.endpoints(_edges(spark, sf_dir))
    return bucketed.hint("merge").join(ends, "lei").select("lei", "legal_name_clean")


@query
def ultimate_owners(spark, sf_dir):
    """Companies on top of the ownership chains."""
    return ownership.ultimate_owners(fx.ownership(spark, sf_dir), scratch_path(spark, "owners"))


# ---- evaluation and metrics


@query
def sample_per_group(spark, sf_dir):
    return review_samples(_walk(spark, sf_dir))[0]


@query
def label_template(spark, sf_dir):
    return review_samples(_walk(spark, sf_dir))[1]


@query
def label_counts(spark, sf_dir):
    return evaluate_matches(fx.labels(spark, sf_dir))["counts"]


@query
def auto_precision(spark, sf_dir):
    return rounded(evaluate_matches(fx.labels(spark, sf_dir))["precision"], "auto_precision")


@query
def top_failure_notes(spark, sf_dir):
    return evaluation.top_failure_notes(fx.labels(spark, sf_dir))


@query
def quality_checks(spark, sf_dir):
    return quality.quality_checks(fx.entity(spark, sf_dir), _edges(spark, sf_dir))


@query
def row_counts(spark, sf_dir):
    return quality.row_counts(
        {"entities": fx.entity(spark, sf_dir), "edges": _edges(spark, sf_dir)}
    )


@query
def all_run_metrics(spark, sf_dir):
    relation = fx.relation(spark, sf_dir)
    entity = fx.node_entity(spark, sf_dir)
    nodes, edges = build_network(entity, relation)
    scratch = scratch_path(spark, "run")
    walk, _ = match.match_sources(fx.source(spark, sf_dir), fx.entity(spark, sf_dir), scratch=f"{scratch}/match")
    build = source_list.build_counts(*_list_inputs(spark, sf_dir), ACCESSED, scratch=f"{scratch}/build")
    parsed = xml_records.parse_counters(spark, xml_files.relations(spark, sf_dir), xml_records.RELATION_TAG)
    metrics = run_metrics(entity, relation, nodes, edges, walk, build, {"level2": parsed})
    return rounded(metrics, "value")
