"""The registered queries and the pipeline on the smallest tables."""

import pytest

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


@pytest.mark.parametrize("name, columns", [
    ("op1", ["doc_id", "held_out", "score", "predicted"]),
    ("op2", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
    ("op3", ["doc_id", "n_shingles", "component_id"]),
    ("op6", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]),
    ("op8", ["doc_id", "n_words", "n_removed", "kept_sha256"]),
    ("op9", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    ("op10", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    ("op11", ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]),
    ("op12", ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]),
    ("op13", ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]),
])
def test_contract_columns(spark, name, columns):
    from scribeflow.llm.queries import QUERIES

    df = next(f for k, f in QUERIES.items() if k.startswith(name + "_"))(spark, SF)
    least = 1 if name in ("op11", "op12", "op13") else spark.read.parquet(f"{SF}/documents.parquet").count()
    assert set(columns) <= set(df.columns) and df.count() >= least
