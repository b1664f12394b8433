import pytest

from compare import differences, oracle_connection
from millrace.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, small, name):
    rows, problem = differences(
        spark, oracle_connection(small), small, queries.QUERIES[name], queries.ORACLES[name]
    )
    assert rows and not problem


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, len(queries.QUERIES) + 1))


def test_columns_of_the_queries(spark, small):
    start = {
        1: "page_id payload_bytes payload_digest record_type refers_to",
        2: "doc_id size text_crc32 law shard slot grown_shard",
        3: "doc_id contaminated",
        4: "page_id url text n_chars",
        5: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        6: "doc_id held_out score predicted",
        7: "doc_id held_out n_tokens n_known train_tokens base_score score",
        8: "doc_id fingerprint component_id",
        9: "doc_id size source_size target taken",
        10: "doc_id start n_tokens ids_crc32",
        11: "doc_id n_assign n_access n_hex base_sha256 spans",
        12: "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
        13: "item_id rank doc_id score",
    }
    for n, (_, query) in enumerate(queries.QUERIES.items(), 1):
        found = query(spark, small)
        assert found.columns[: len(start[n].split())] == start[n].split()
        if n > 11:
            continue
        table = "pages" if n in (1, 4) else "documents"
        assert found.count() == spark.read.parquet(f"{small}/{table}.parquet").count()
