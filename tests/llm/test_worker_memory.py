"""What stays in Python workers between the stages of a chain."""

from gaugeline.llm.packing import Packing, tokenised_pieces
from gaugeline.llm.queries import WORD_BPE
from gaugeline.llm.texts import SMALL_SLICE, batch_of, map_texts


def test_encoders_are_let_go_before_other_work_on_texts(spark):
    docs = spark.createDataFrame([(1, "one text of words"), (2, None)], "doc_id long, text string").coalesce(1)

    def work(batch):
        from gaugeline.llm.encoding import encoder_of
        from gaugeline.llm.texts import shared

        before = len(shared)
        encoder_of(WORD_BPE)
        return batch_of(n=[before])

    assert tokenised_pieces(docs, WORD_BPE, 1, Packing(), "doc_id", "text").count() == 2
    for _ in range(2):  # a worker that has just made an encoder comes without it
        assert {r["n"] for r in map_texts(docs, work, "n bigint").collect()} == {0}


def test_slices_keep_to_the_limit_asked_for(spark):
    docs = spark.range(40, numPartitions=1).selectExpr("id doc_id", "repeat('word ', 20000) text")
    sizes = [r["n"] for r in map_texts(docs, lambda b: batch_of(n=[sum(len(t) for t in b["text"].to_pylist())]), "n bigint", "text", SMALL_SLICE).collect()]
    assert sum(sizes) == 40 * 100_000 and max(sizes) <= SMALL_SLICE
