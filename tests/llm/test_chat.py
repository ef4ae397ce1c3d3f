from pyspark.sql import functions as F

from varloom.llm.chat import conversation_digests, prefix_target_examples, read_loss, read_turns

from . import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def read(examples):
    turns = read_turns(F.col("formatted")).alias("turns")
    return examples.select("conv_id", "example", "trainable", turns, read_loss(examples).alias("loss")).collect()


def test_each_assistant_turn_is_an_example_with_its_context(spark):
    turns = [("system", "s"), ("user", "a<|im_end|>\n"), ("assistant", "<|im_start|>x\n<\\|"), ("user", ""), ("assistant", "é\\n<\\\\|")]
    turns.append(("us\ner\\n<|", "tail"))
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], SCHEMA).repartition(3)
    got = sorted(read(prefix_target_examples(df)), key=lambda r: r.example)
    for row, (end, loss) in zip(got, [(3, turns[2][1]), (5, turns[4][1]), (6, "")], strict=True):
        assert [tuple(t) for t in row.turns] == turns[:end]
        assert row.loss == loss and row.trainable == bool(loss)


def test_no_control_string_is_left_in_a_text(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "<|im_start|><|im_end|><|im_end|>\n")], SCHEMA)
    text = prefix_target_examples(df).first().formatted
    assert text.count("<|im_start|>") == 1 and text.count("<|im_end|>") == 1


def test_odd_rows_have_defined_results(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "first"), (None, 1, "user", "u"), (3, 1, "assistant", "x" * 10**5)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA + ", formatted int, pieces int")
    got = {r.conv_id: r for r in conversation_digests(prefix_target_examples(df)).collect()}
    assert set(got) == {1, None, 3}
    assert (got[1].n_turns, got[1].loss_chars, got[1].n_examples) == (3, 5, 1)
    assert got[1].turns_sha256 == brute.sha("assistant\nfirst\n" + "\n\n" * 2)
    assert (got[None].n_turns, got[None].loss_chars, got[None].loss_sha256) == (1, 0, brute.sha(""))
    assert got[3].loss_sha256 == brute.sha("x" * 10**5)
    assert not conversation_digests(prefix_target_examples(df.limit(0))).count()


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    plan = conversation_digests(prefix_target_examples(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
