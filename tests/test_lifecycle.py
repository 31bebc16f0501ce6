from leadmill.plans import lifecycle
from leadmill.plans.bindings import A, B, REVIEWS, bound
from pyspark.sql import functions as F


def test_from_listings_to_manifest(spark, data):
    a, b = bound(spark, data, A), bound(spark, data, B)
    registry = a.select("list_id", "idx", "name", "phone", "postal", "city", "state", "lat", "lon", F.col("grade").alias("rating"))
    angi = b.select("list_id", (F.col("idx") + 500).alias("idx"), "name", "phone", "city", F.col("postal").alias("zip_code"), F.col("rating").alias("overall_rating"), "review_count")
    master = lifecycle.linked(registry, b)
    wide = lifecycle.with_angi(master, angi)
    assert wide.where("match_status = 'angi_only'").count() + wide.where("angi_name is not null and a_idx is not null").select("angi_name").count() >= angi.count() - 1
    assert wide.where("a_idx is not null").count() == master.count()
    said = bound(spark, data, REVIEWS).withColumn("list_id", F.col("business") % 5).withColumn("a_idx", F.col("business"))
    reviewed = lifecycle.with_reviews(wide, said)
    assert reviewed.count() == wide.count()
    lists = a.select("list_id", F.lit("Roofing").alias("industry"), "metro").distinct()
    out = lifecycle.published(reviewed, lists, "2024-06-01")
    rows = out.rows.collect()
    assert rows and all(r.lead_priority_score >= 50 for r in rows)
    assert sum(r.record_count for r in out.manifest.collect()) == len(rows) == sum(r.kept for r in out.counts.collect())
