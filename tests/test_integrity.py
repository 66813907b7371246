from quayside.operators.integrity import ri_filter, ri_split


def test_filter_and_split_agree(spark):
    child = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "z"), (4, None, "x"), (5, "q", "z")],
                                  "id int, c string, r string")
    pc = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")          # duplicate parent key
    pr = spark.createDataFrame([("x",)], "r string")
    parents = [(pc, "c"), (pr, "r")]
    valid = sorted(r["id"] for r in ri_filter(child, parents).collect())
    assert valid == [1, 2]                                                     # no duplication by parent keys
    split = {r["id"]: r["_reject_reason"] for r in ri_split(child, parents).collect()}
    assert split == {1: None, 2: None, 3: "unknown_r", 4: "unknown_c", 5: "unknown_c"}
