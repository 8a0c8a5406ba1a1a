from martkit.llm.jaccard_join import jaccard_components


def test_links_beyond_the_joining_distance(spark):
    """Sets with a similarity between 0.1 and 0.2 link at a threshold of 0.1."""
    rows = [(i, " ".join([*(f"s{k}" for k in range(8)), *(f"d{i}x{k}" for k in range(22))])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard_components(docs, 1, 10, 100).collect()} == {0}
