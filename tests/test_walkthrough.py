"""The whole chain over a made-up web."""

from pyspark.sql import functions as F


def test_ends_in_an_evaluated_review(spark, tmp_path):
    """And an answer that cites what it wasn't given is refused, and nothing of it is scored."""
    from sparkloom import walkthrough
    from sparkloom.operators import claims, review

    folder = f"file://{tmp_path}/one"
    row = walkthrough.run(spark, folder).collect()[0]
    assert row["error"] is None and row["documents"] == row["candidate_count"] == 3 and row["status"] == "UNREVIEWED_CANDIDATES"
    assert row["supported_claim_precision"] == row["finding_coverage"] == 1.0
    assert row["bundle_id"].startswith("eb-") and row["request_id"].startswith("er-")

    forged = spark.read.parquet(f"{folder}/answers").withColumn("response", F.regexp_replace("response", "ev-[0-9a-f]{20}", "ev-00000000000000000000"))
    refused = review.evaluate_cases(walkthrough.illustrative_review(claims.compile_responses(forged))).first()
    assert refused["error"] == "structural validation failed: a claim proposal cites unknown evidence" and refused["candidate_count"] is None
