import importlib.util

import __spark_entry__


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["pic", "ror_id", "confidence", "source", "reason"] and df.count() > 0


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= names
    found = importlib.util.find_spec("tessera.llm")
    if found and found.origin:
        assert "pipeline" in names
        assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
