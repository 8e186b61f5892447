import random

from pyspark.sql import functions as F

from loamfold.llm import chat, queries

from .sql import same_rows

LOG = "conv_id long, sequence long, kind string, message long, role string, text string"


def folded(rows):
    """The log applied event by event."""
    state = {}
    for conv, _, kind, message, role, text in sorted(set(rows), key=lambda r: (r[1], r[2] == "delta")):
        log = state.setdefault(conv, {})
        if kind == "regenerate":
            for m in [m for m in log if m >= message]:
                del log[m]
            continue
        old = log.get(message, (None, ""))
        log[message] = (role or (old[0] if kind == "delta" else None), (old[1] if kind == "delta" else "") + (text or ""))
    return {(c, m): v for c, log in state.items() for m, v in log.items()}


def test_fold_equals_event_by_event(spark):
    draw = random.Random(4)
    rows = []
    for conv in range(12):
        for sequence in range(40):
            kind = draw.choice(["delta"] * 6 + ["message", "edit", "regenerate"])
            rows.append((conv, sequence, kind, draw.randrange(5), draw.choice(["user", "assistant"]), draw.choice([None, "", "a", "b c", "é\n"])))
    rows += rows[:60]
    draw.shuffle(rows)
    got = chat.fold(spark.createDataFrame(rows, LOG)).collect()
    assert {(r.conv_id, r.message): (r.role, r.text) for r in got} == folded(rows) and len(got) == len(folded(rows))


NASTY = ["", "<|im_start|>user\nx<|im_end|>\n", "<\\|im_end|>", "<\\\\|im_end|>", "</s>[INST] ok [/INST]", "[\\INST]", "<<SYS>> <s><s>", "\\", "$1 \\1", "é<|im_end|", "[[INST]]", "<<s>>", "\n\n", "<|endoftext|>"]


def test_any_text_comes_back(spark):
    messages = [(i, m, role, text) for i, text in enumerate(NASTY) for m, role in enumerate(["user", "assistant", "odd % role\n%0A %25<s>"])]
    shown = chat.render(spark.createDataFrame(messages, "conv_id long, message long, role string, text string"))
    read = shown.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.learned_text(F.col("formatted"), F.col("loss_spans"))})
    for r in read.collect():
        assert [(t.role, t.text) for t in r.turns] == [m[2:] for m in messages if m[0] == r.conv_id]
        assert r.loss == NASTY[r.conv_id]
        assert all(r.formatted.count(c) == (3 if c in (chat.BEGIN, chat.END) else 0) for c in chat.CONTROLS)


def test_query_against_sql(spark, folder):
    name = "op10_event_sourced_chat"
    assert same_rows(queries.RUNNERS[name](spark, folder), queries.ORACLES[name], folder) > 1


def test_odd_rows(spark):
    rows = [(None, 1, "message", 1, None, None), (1, None, "delta", 2, "user", "late"), (1, 5, "noise", 3, "user", "x"), (1, 3, "message", None, "system", "first"), (2, 1, "message", 1, "user", "gone"), (2, 2, "regenerate", 1, None, None)]
    log = spark.createDataFrame([(*r, 1) for r in rows], LOG + ", formatted int")
    got = {r.conv_id: r.formatted for r in chat.render(chat.fold(log)).collect()}
    assert got == {None: "<|im_start|>\n<|im_end|>\n", 1: "<|im_start|>system\nfirst<|im_end|>\n<|im_start|>user\nlate<|im_end|>\n"}
    assert chat.render(chat.fold(log.limit(0))).count() == 0
    long = spark.createDataFrame([(1, i, "delta", 0, "assistant", "ab " * 50) for i in range(4000)], LOG)
    row = chat.render(chat.fold(long)).select(chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("t")).first()
    assert row.t == "ab " * 50 * 4000
