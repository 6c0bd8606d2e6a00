import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from imagelab.llm import chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
HOSTILE = ["</s>", "<s>", "[INST]", "[/INST]", r"<\/s>", r"[\\INST]", "<", "[", "\\", "<</s>", "</s", "[/INST", "</INST]", "\n", "é", ""]


def check(spark, rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    examples = chat_format.expand_prefixes(spark.createDataFrame(rows, SCHEMA)).cache()
    got = {r["conversation"]: r for r in chat_format.read_back(examples).collect()}
    assert set(got) == set(talks)
    formatted = defaultdict(list)
    for r in examples.collect():
        formatted[r["conversation"]].append(r)
    examples.unpersist()
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0))
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        replies = [text for *_, role, text in turns if role == "assistant"]
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len("".join(replies))
        assert r["loss_sha256"] == hashlib.sha256("".join(replies).encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(e["formatted"]) for e in formatted[conv])
        assert len(formatted[conv]) == len(replies) + (turns[-1][2] != "assistant")
        for e in formatted[conv]:
            assert e["formatted"].count("</s>") == e["formatted"].count("<s>[INST]") == e["formatted"].count("[/INST]")


def test_turns_come_back(spark):
    rows = [(1, 2, "user", "b"), (1, 0, "system", "s"), (1, 1, "user", "a"), (1, 3, "assistant", "c"), (1, 4, "assistant", "d")]
    rows += [(2, 0, "user", "only a question"), (3, 0, "assistant", None), (4, 0, None, "no role"), (5, None, "user", "no turn")]
    rows += [(5, 1, "assistant", "x"), (None, 0, "user", "null id"), (None, 1, "assistant", "y"), (6, 0, "user", "same"), (6, 1, "user", "same")]
    rows += [(7, i, "assistant" if i % 2 else "user", h) for i, h in enumerate(HOSTILE)]
    rows += [(8, i, h, h) for i, h in enumerate(HOSTILE)] + [(9, 0, "user", "w " * 200_000), (9, 1, "assistant", "r" * 300_000)]
    check(spark, rows)


def test_repeated_rows_are_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")] * 3, SCHEMA)
    assert chat_format.read_back(chat_format.expand_prefixes(df)).first()["n_turns"] == 3


def test_contexts_and_masks(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1 </s>"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "bye")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", conversation string")
    got = chat_format.expand_prefixes(df).orderBy("example").collect()
    first = r"<s>[INST]user[/INST]q1</s><s>[INST]assistant[/INST]a1 <\/s></s>"
    assert got[0]["formatted"] == first
    assert got[1]["formatted"] == first + "<s>[INST]user[/INST]q2</s><s>[INST]assistant[/INST]a2</s>"
    masked = [r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_chars"]] for r in got]
    assert masked == [r"a1 <\/s>", "a2", ""]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(HOSTILE), max_size=6).map("".join), min_size=1, max_size=8))
def test_escaping_is_reversible(spark, texts):
    check(spark, [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)])


def test_empty_table(spark):
    assert chat_format.read_back(chat_format.expand_prefixes(spark.createDataFrame([], SCHEMA))).count() == 0
