"""The entry guards the import of the subpackage, so a broken import would drop its queries without a word: they are all there."""

import __spark_entry__
import corpus_pipeline
from voxloom.llm import queries


def test_every_operator_is_registered():
    found = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(__spark_entry__.oracle_sql()) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "secrets", "packing"]
