"""What the provenance operators parse and check once a row, by their plans."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"


def test_artifacts_citations_and_bundles_are_checked_once(spark):
    from sparkloom.operators import citations, store
    from sparkloom.plans import evidence_queries as q

    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    try:
        plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
        bodies = q._bodies(spark, SF)
        normal, ingested, artifacts = q._ledgers(spark, SF, bodies)
        assert plan(store.verified_artifacts(normal, artifacts)).count("from_json(") == 1

        made = q._bundles(spark, SF, bodies)
        assert "unknown block ref" not in plan(made)  # citations are read, not made again

        bundles = made.where("bundle is not null").select("conv_id", "bundle")
        assert "bundle SHA-256 does not match its content" not in plan(citations.verify_bundles(bundles, normal, ingested, artifacts, key=["conv_id"]))
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
