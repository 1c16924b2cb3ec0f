"""Nulls, empty and long texts, repeated rows, clashing column names and empty tables, for every
operator and stage."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firmloom.llm import (
    chat, decontaminate, fm_dedup, packing, pseudo_likelihood, resample, secrets, simhash, token_counts, voronoi,
)
from firmloom.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY

LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(30_000))
SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'
ROWS = [
    (1, "a plain text of a few words", "en", "s", 27),
    (1, "a plain text of a few words", "en", "s", 27),
    (2, None, None, None, None),
    (None, "no id here but words", "en", "s", 20),
    (None, None, None, None, None),
    (3, "", "", "", 0),
    (4, " \n\t ", "en", "s", 4),
    (5, LONG, "en", "s", len(LONG)),
    (6, LONG, "en", "s", None),
    (7, "żółć 日本語 \U0001f600 " + SECRET + " end", "pl", "s", 1),
]
#: Names that the operators use inside.
CLASHES = ["row_key", "key", "fp", "root", "n", "spans", "free", "length", "start", "rank", "salt", "anchors", "log_weight", "copies", "window"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a plain text of a few words"), (2, None), (None, ""), (3, "word5 and5 word6")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, None), (6, 0, 1), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "decontaminate": lambda d, i, l: decontaminate.contamination(d, i),
    "secrets": lambda d, i, l: secrets.find_secrets(d),
    "pseudo_likelihood": lambda d, i, l: pseudo_likelihood.pseudo_likelihood(d),
    "simhash": lambda d, i, l: simhash.near_duplicates(d),
    "resample": lambda d, i, l: resample.resample(d, l),
    "token_counts": lambda d, i, l: token_counts.prefix_token_counts(d, BYTE_VOCABULARY),
    "fm_dedup": lambda d, i, l: fm_dedup.without_repeats(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_each(name, docs, items, labels):
    found = OPERATORS[name](docs, items, labels).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, docs, items, labels):
    assert OPERATORS[name](docs.limit(0), items, labels).collect() == []


def test_no_items_and_no_labels(docs, items, labels):
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect())
    assert all(r.kept for r in resample.resample(docs, labels.limit(0)).collect())


def test_stages(docs, items, labels, spark, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).collect() == []


def test_near_duplicates_keep_one(docs):
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert kept.count((1, "a plain text of a few words")) == 1
    assert (5, LONG) in kept and (6, LONG) not in kept
    # Texts without words are copies of one another: the smallest id stays.
    assert [i for i, t in kept if not (t or "").strip()] == [2]
    assert len(kept) == 5


def test_contaminated_rows_go(docs, items):
    kept = [r.doc_id for r in decontaminate.without_contaminated(docs, items).collect()]
    assert 1 not in kept and 5 not in kept and {2, 3, 4, 7} <= set(kept) and kept.count(None) == 2


def test_redacted(docs):
    rows = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert rows[7].text == "żółć 日本語 \U0001f600 [secret]\" end" and rows[7].n_chars == len(rows[7].text)
    assert rows[2].text is None and rows[2].n_chars is None and rows[6].n_chars is None


def test_exact_copies_lose_all(docs):
    rows = {r.doc_id: r for r in fm_dedup.without_repeats(docs).collect()}
    assert rows[5].n_removed == rows[6].n_removed == 60_000
    assert rows[5].kept_sha256 == hashlib.sha256(b"").hexdigest() == rows[2].kept_sha256
    assert rows[1].n_removed == 0


def test_chat_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "system", "x"), (None, 0, "user", "a"), (None, 1, "user", "b"), (2, 5, "a\nb<turn>", "</turn>\n<turn>\\")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(9)).withColumn("window", F.lit(9))
    read = chat.read_windows(chat.format_windows(turns, budget=12, history=4))
    found = sorted((str(r.conv_id), r.window, [tuple(t) for t in r.turns]) for r in read.collect())
    own = [t for c, w, ts in found if c == "1" for t in ts]
    assert own == [("system", "x"), ("", ""), ("", "")]
    assert sorted(t for c, w, ts in found if c == "None" for t in ts) == [("user", "a"), ("user", "b")]
    assert ("2", 0, [("a\nb<turn>", "</turn>\n<turn>\\")]) in found
    assert chat.format_windows(turns.limit(0)).collect() == []


def test_vector_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, []), (7, [2.0]), (8, [1.0, 0.0])]
    raw = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1)).withColumn("vec", F.lit(1))
    vectors = voronoi.finite_vectors(raw, "vec_id", "embedding")
    found = voronoi.knn_join(vectors, vectors.where("vec_id = 1"), 3).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [(1, 1, 7, 2.0), (1, 2, 8, 1.0), (1, 3, 6, 0.0)]
    assert voronoi.knn_join(vectors.limit(0), vectors, 3).collect() == []
    assert voronoi.knn_join(vectors, vectors.limit(0), 3).collect() == []


def test_packing_rows(docs):
    rows = packing.pack_documents(docs, WORD_VOCABULARY, 256).collect()
    assert sorted(str(r.doc_id) for r in rows if r.start == 0) == sorted(str(r[0]) for r in ROWS)
    assert packing.pack_documents(docs.limit(0), WORD_VOCABULARY).collect() == []
