"""Which queries of this folder are registered, and which of them SQL can express."""

from tickloom.llm import queries


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_queries_with_sql():
    """The others are held against brute force, round trips or held-out rows in their own tests."""
    assert set(queries.ORACLES) == {"op10_warc", "op11_collocations"}
