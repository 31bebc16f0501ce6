from leadmill.operators import curation, publish, reviews, scoring
from pyspark.sql import functions as F

AS_OF = "2024-06-01"
BASE = {"match_status": "matched", "registry_phone": "305", "yelp_rating": 3.0, "yelp_review_count": 40.0}


def score(spark, **over):
    row = {k: v for k, v in (BASE | over).items() if v is not None}
    df = spark.createDataFrame([row], ", ".join(f"{k} {scoring.INPUTS.get(k, 'string') if k != 'most_recent_review_date' else 'string'}" for k in row))
    return scoring.with_scores(df, AS_OF).first()


def test_relations(spark):
    s = lambda **o: score(spark, **o).lead_priority_score
    assert s(yelp_rating=3.0) > s(yelp_rating=1.0) > s(yelp_rating=4.5)
    assert s(yelp_review_count=40.0) > s(yelp_review_count=100.0) > s(yelp_review_count=400.0)
    assert s(registry_phone=None) == s() / 2
    assert s(registry_principal_contact="Pat") == s() + 5
    assert s(registry_years_in_business=10.0) == s() + 6
    assert score(spark, yelp_rating=None, yelp_review_count=None).lead_priority_score is None
    assert s(registry_rating="A+") == s(registry_rating="A+", yelp_rating=3.0) and score(spark, registry_rating="A+", yelp_rating=2.0).reputation_divergence_flag == 1


def test_gates(spark):
    assert score(spark, yelp_review_count=4.0).review_need_score == 70
    assert score(spark, match_status="a_only").review_need_score is None
    assert score(spark, review_sentiment_analyzed_count=4.0, review_sentiment_negative_count=0.0).review_sentiment_signal == 15.3
    assert score(spark, review_sentiment_analyzed_count=4.0, review_sentiment_negative_count=2.0, most_recent_review_date="2024-05-01").review_sentiment_signal == 89.7
    assert score(spark, avg_review_gap_days=10.0, most_recent_review_date="2024-05-01").review_gap_flag == 1
    assert score(spark, registry_phone=" ", angi_phone="3").has_phone == 0  # a blank is a value
    assert score(spark, registry_phone="", angi_phone="3").contact_readiness == "phone"


def test_scores_again_change_nothing(spark):
    df = spark.createDataFrame([("matched", "305", 3.0, 40.0)], "match_status string, registry_phone string, yelp_rating double, yelp_review_count double")
    once = scoring.with_scores(df, AS_OF)
    assert sorted(once.columns) == sorted(scoring.with_scores(once, AS_OF).columns) and once.select(*sorted(once.columns)).collect() == scoring.with_scores(once, AS_OF).select(*sorted(once.columns)).collect()


def test_curation(spark):
    rows = spark.createDataFrame([(0, "A", None, None, 60.0), (0, " a ", None, None, 60.0), (0, "", "A", None, 10.0), (0, "B", None, "Y", 10.0), (0, "C", None, None, 49.9), (0, "D", None, None, 50.0), (0, "E", None, None, None), (1, "A", None, None, 60.0)], "list_id long, registry_name string, angi_name string, corp string, score double")
    marked = curation.reasons(rows, curation.name_key(), F.col("corp"), F.col("score"), ["list_id"])
    assert sorted(r.drop_reason or "" for r in marked.collect()) == sorted(["chain_name"] * 3 + ["corporate_account", "low_score", "low_score", "", ""])
    assert curation.counts(marked, ["list_id"]).where("list_id = 1").first().asDict() == {"list_id": 1, "chain_name": 0, "corporate_account": 0, "low_score": 0, "kept": 1}


def test_reviews(spark):
    rows = spark.createDataFrame([(1, '[{"text": " a ", "date": "2024-01-03"}, {"text": ""}]', "broken"), (2, None, '[{"text": "b", "date_label": "March 2023"}]')], "k long, one string, two string")
    got = reviews.opened(rows, "k", {"registry": "one", "angi": "two"}).select("k", "source", "text", F.col("date").cast("string")).collect()
    assert sorted(map(tuple, got)) == [(1, "registry", "a", "2024-01-03"), (2, "angi", "b", "2023-03-01")]
    made = reviews.validated(spark.createDataFrame([("NEGATIVE ", "9", "yes"), ("odd", None, None)], "sentiment string, severity string, actionable string")).collect()
    assert [tuple(r) for r in made] == [("negative", 5, True), ("neutral", 1, False)]


def test_publish(spark):
    m = spark.createDataFrame([("i", "m", "matched", "Name", "", 3.0, 40.0, "3051112222"), ("i", "m", "b_only", None, None, 3.0, 40.0, None)], "industry string, metro string, match_status string, registry_name string, registry_phone string, yelp_rating double, yelp_review_count double, angi_phone string")
    m = m.withColumn("angi_name", F.lit(None).cast("string")).withColumn("angi_is_corporate_account", F.lit(None).cast("string"))
    rows, counts = publish.published(m, AS_OF, ["industry", "metro"])
    assert [(r.name, r.phone) for r in rows.collect()] == [("Name", "3051112222")]
    entry = publish.manifest(rows, AS_OF)
    again = publish.manifest_upsert(entry, entry)
    assert again.count() == 1 and again.first().id == "i--m" and counts.first().kept == 1
