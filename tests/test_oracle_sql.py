"""What is handed out as SQL is SQL."""

import __spark_entry__ as entry


def test_oracle_is_text():
    assert entry.oracle_sql() and all(isinstance(sql, str) for sql in entry.oracle_sql().values())
