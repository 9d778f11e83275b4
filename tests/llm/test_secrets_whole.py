from medistar.llm import queries

from .helpers import frame


def test_far_parts_of_one_scope(spark, scratch):
    far = "pwd: hunter22 " + "x " * 200 + "joe@example.com"
    rows = [(1, far, None, None, 0), (2, far.replace("x x", "x\n\nx", 1), None, None, 0)]
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r.spans for r in queries.op10_secrets(spark, scratch).collect()}
    assert [x.split(":")[0] for x in got[1].split(",")] == ["weak_secret", "identifier"] and got[2] == ""
