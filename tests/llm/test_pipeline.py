import corpus_pipeline
from pyspark.sql import functions as F

from tallow.llm import compression_bands, near_dedup, packing, toxicity
from tallow.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_agree_with_their_operators(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality rules", "near-dedup", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())

    clean = stage["toxicity"](spark, docs, SF).cache()
    assert clean.count() > 0.7 * docs.count()
    assert ids(clean) == ids(toxicity.toxicity_report(docs, labels).where("predicted = 0"))
    good = stage["quality rules"](spark, clean, SF).cache()
    assert ids(good) == ids(compression_bands.quality_report(clean).where("kept"))
    once = stage["near-dedup"](spark, good, SF).cache()
    assert ids(once) == ids(near_dedup.near_duplicates(good).where("kept"))
    assert once.count() > 0.3 * docs.count()
    mixed = stage["mixing"](spark, once, SF).cache()
    assert [f.simpleString() for f in mixed.schema] == [f.simpleString() for f in docs.schema]
    packed = stage["packing"](spark, mixed, SF)
    assert set(ids(packed)) == set(ids(mixed))
    assert packed.agg(F.sum("length")).first()[0] == packing.pack_documents(mixed).agg(F.sum("length")).first()[0]


def test_run_is_repeatable(spark):
    one, two = (sorted(map(str, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert one == two and one
