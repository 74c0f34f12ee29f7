from cratedig.llm.minhash import drop_near_duplicates

SCHEMA = "doc_id long, text string"


def near(name, n):
    return [" ".join([f"{name}{k}" for k in range(60)] + [f"x{i}"]) for i in range(n)]


def test_one_row_of_each_class(spark):
    rows = [(None, t) for t in near("a", 5)]
    rows += [(7, t) for t in near("b", 5)]
    rows += [(None, t) for t in near("c", 3)] + [(3, near("c", 4)[3]), (9, near("c", 5)[4])]
    rows += [(None, ""), (None, None), (8, " ")]
    got = drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.doc_id) + (r.text or " ")[0] for r in got if (r.text or "").strip()) == ["3c", "7b", "Nonea"]
    assert len(got) == 6
