from medistar.llm import queries

# tokenisers, learned models, tree votes, drawn copies and 200-byte windows: held against brute force,
# round trips or held-out accuracy in the tests of their operators instead
NO_SQL = {"op1_packing", "op2_ann", "op4_mixing", "op5_html", "op7_line_dedup", "op9_toxicity", "op10_secrets",
          "op12_suffix_dedup"}


def test_every_query_has_sql_or_is_listed():
    assert set(queries.oracle_sql()) == set(queries.queries()) - NO_SQL
