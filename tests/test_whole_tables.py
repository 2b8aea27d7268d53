"""Queries that leave no part of their tables out."""

from __future__ import annotations

from lakeloom.plans import registry


def test_ancestors_of_keys_of_any_length(spark, tmp_path):
    keys = [3, 23, 123, 4123, 54123, 1_000_054_123, 77]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    found = {tuple(r) for r in registry.QUERIES["path_ancestors_all"](spark, str(tmp_path)).collect()}
    line = keys[:5]
    expected = {(c, a) for i, c in enumerate(line) for a in line[:i]} | {(1_000_054_123, a) for a in line}
    assert found == expected


def test_messages_are_compared_as_a_whole(spark, tmp_path):
    rows = [(1, 1, "user", "the same start, one"), (1, 2, "user", "the same start, two"), (1, 3, "user", "the same start, one"), (1, 4, "assistant", "the same start, one")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    flat = registry.QUERIES["flattened_transcripts_whole"](spark, str(tmp_path)).select("message_number", "role", "content")
    assert sorted(map(tuple, flat.collect())) == [(1, *rows[0][2:]), (2, *rows[1][2:]), (3, *rows[3][2:])]
    kept = registry.QUERIES["transcript_dedup_whole"](spark, str(tmp_path)).select("message_number", "turn", "role", "text")
    assert sorted(map(tuple, kept.collect())) == [(1, *rows[0][1:]), (2, *rows[1][1:]), (3, *rows[3][1:])]
