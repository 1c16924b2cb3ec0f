"""What matching leaves on disk."""

from pyspark.sql import functions as F

from firmloom.operators import existence
from firmloom.operators.blocking import candidate_sets


def test_register_names_nobody_has_stay_in_place(spark, tmp_path):
    entities = spark.createDataFrame(
        [(i, f"L{i}", f"Name {i}", f"name {i}" if i % 9 else "", "us") for i in range(1, 3000)] + [(3000, "L", "N", "name 5", "us")],
        "row_id long, lei string, legal_name string, legal_name_clean string, country_norm string",
    )
    sources = spark.createDataFrame([("name 5", "us"), ("name 17", ""), ("nobody", "us"), ("", "us")], "name_clean string, country_norm string")
    found = {(r.name_clean, r.exact.lei if r.exact else None) for r in candidate_sets(sources, entities).collect()}
    assert found == {("name 5", "L5"), ("name 17", "L17"), ("nobody", None)}
    plan = candidate_sets(sources, entities)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    asked = sources.select(F.col("name_clean").alias("legal_name_clean"))
    assert existence.likely(entities, [asked], "legal_name_clean", 4).count() < 500
    assert existence.likely(entities, [asked], "legal_name_clean", 1 << 40).count() == 3000
