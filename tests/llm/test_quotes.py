"""Quotation linking beyond whole passages at level one, and long conversations."""

from __future__ import annotations

from tidefold.llm.queries import op3_quotation_linking
from tidefold.llm.quotes import link_quotes


def test_deeper_and_trimmed_quotes(spark):
    rows = [
        (1, "First paragraph.\n\nSecond paragraph.", "a"), (2, "> Second paragraph.\nI agree.", "a"),
        (3, "> > Second paragraph.\nOnly deeper.", "a"), (4, "> edited away\n> > I agree.\nDeeper stands in.", "a"),
        (5, "> I agree.\n> > First paragraph.\nLevel one wins.", "a"), (6, "> I agree.\n>\n> and some more\nEdited.", "a"),
        (7, "> > First paragraph.\n> \nBlank.", "a"),
    ]
    messages = spark.createDataFrame(rows, "id long, text string, thread string")
    got = {r.id: r.parent for r in link_quotes(messages).collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 1}
    assert {r.id: r.parent for r in link_quotes(messages, blank_answers=True).collect()} == {**got, 7: None}


def test_long_conversation_keeps_all_messages(spark, tmp_path):
    rows = [(1, t, f"text {t}") for t in (999_999, 1_000_000, 1_000_001)] + [(2, t, f"other {t}") for t in (0, 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.body: r for r in op3_quotation_linking(spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(text for _, _, text in rows)
    assert got["text 1000001"].depth == 2 and got["text 1000001"].conversation == 1_999_999
    assert got["other 0"].parent is None and got["other 1"].parent == 2_000_000
