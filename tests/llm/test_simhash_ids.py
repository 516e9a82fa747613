"""SimHash groups where an id comes with several texts."""

from tidegrid.llm.simhash import near_groups


def test_a_repeated_id_is_no_link(spark):
    a, b, c = 0, (1 << 40) - 1, ~0
    rows = [(5, a), (3, a + 1), (5, b), (7, b ^ 2), (8, b), (5, c), (None, c - 1), (None, b << 20)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in near_groups(df).collect()}
    assert got == {(5, a): 3, (3, a + 1): 3, (5, b): 5, (7, b ^ 2): 5, (8, b): 5, (5, c): 5,
                   (None, c - 1): 5, (None, b << 20): None}
