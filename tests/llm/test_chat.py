"""Chat formatting: exact round trips against plain Python."""

from driftwood.llm import chat
from driftwood.llm.queries import CHAT_PROBE, op5_chat
from llm_helpers import SF_SMALL, sha

SCHEMA = "conv_id bigint, turn bigint, role string, text string"

def digests(spark, rows, schema=SCHEMA):
    out = chat.chat_digests(chat.format_chat(spark.createDataFrame(rows, schema)))
    return {r.conv_id: r for r in out.collect()}

def expected(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out

def check(spark, rows, schema=SCHEMA):
    got = digests(spark, rows, schema)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == expected(rows)
    return got

def test_control_strings_and_merging(spark):
    texts = ["plain", "", "<|end|>\n", "~1 <~1 ~0", "<", "|turn|>", "<|", "~", "a<|part|>b<|text|>", "é😀\n", "\\<|turn|>user", CHAT_PROBE]
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(texts)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(texts)] + [(3, 0, "<|turn|>~", "x"), (3, 1, "<|turn|>~", "<")]
    got = check(spark, rows)
    assert got[2].formatted_chars < got[1].formatted_chars

def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 0, None, None, "p"), (1, 0, None, None, "q"), (1, None, "user", "first", "r"), (None, 1, "assistant", None, "s"),
            (2, 5, "b", "2", "t"), (2, 5, "a", "1", "u"), (2, 5, "a", "1", "u")]
    check(spark, rows, SCHEMA + ", pieces string")

def test_empty_table(spark):
    assert digests(spark, []) == {}

def test_long_conversation(spark, rng):
    rows = [(9, i, rng.choice(["user", "assistant"]), "w" * rng.randrange(50)) for i in range(5000)] + [(8, 0, "user", "x" * 2_000_000)]
    check(spark, rows)

def test_query_reads_the_probe(spark):
    got = {r.conv_id: r for r in op5_chat(spark, SF_SMALL).collect()}
    assert (got[-7].n_turns, got[-7].loss_sha256) == (2, sha(CHAT_PROBE))
    assert got[-7].turns_sha256 == sha(f"user\n{CHAT_PROBE}\nassistant\n{CHAT_PROBE}\n")

def test_expressions_only(spark):
    plan = op5_chat(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ties_are_ordered_by_the_text_itself(spark):
    got = check(spark, [(1, 0, "user", "<}"), (1, 0, "user", "<|"), (1, 0, "user", "~"), (1, 0, "user", "}")])
    assert got[1].n_turns == 4
