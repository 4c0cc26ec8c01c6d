"""Token ids that a flat file cannot hold are refused, not cut."""

import pytest

from evenkeel.llm.separators import token_file_blocks


def test_an_end_id_that_a_text_holds_is_refused(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    blocks, _ = token_file_blocks(docs)
    ids = memoryview(bytes(blocks.first().data)).cast("H").tolist()
    with pytest.raises(Exception, match="holds the end id"):
        token_file_blocks(docs, end=ids[0])
    with pytest.raises(Exception, match="do not fit into 1 bytes"):
        from evenkeel.llm import separators

        separators.WIDTHS[1] = "<u1"
        token_file_blocks(docs, end=250, width=1)
