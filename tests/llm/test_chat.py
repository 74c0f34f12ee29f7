import hashlib
import random
import time
from collections import defaultdict

from pyspark.sql import functions as F

from cratedig.llm.chat import chat_digest, escape, format_blocks, format_chats, unescape

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
BITS = ["[INST]", "[/INST]", "</s>", "[\\INST]", "<\\\\/s>", "[", "<", "\\", " ", "\n", "INST]", "/s>", "a", "é", "😀", "[INST] user [/INST]"]


def conversations():
    rnd = random.Random(2)
    text = lambda: "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 8)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", text(), None]), rnd.choice([text(), text(), None]), "x") for c in range(80) for t in range(rnd.randint(1, 7))]
    rows += [(-7, t, r, "</s>[INST] ok [/INST]", "x") for t, r in enumerate(["user", "assistant"])]
    rows += [(500, 1, "user", "b", None), (500, 0, "user", "a", None), (500, 1, "user", "b", None), (None, None, "assistant", "plain", None)]
    return rows


def test_reads_back_what_it_wrote(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in chat_digest(format_blocks(frame)).collect()}
    formatted = {r.conv_id: r for r in format_chats(frame).collect()}
    source = defaultdict(list)
    for c, t, role, text, _ in rows:
        source[c].append((t, role or "", text or ""))
    assert set(got) == set(source)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in source.items():
        turns.sort(key=lambda x: (x[0] is not None, x))
        assert [(x.role, x.text) for x in formatted[c].turns] == [x[1:] for x in turns]
        loss = "".join(x[2] for x in turns if x[1] == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)))
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), sha(loss), len(formatted[c].formatted))
    assert formatted[-7].escaped
    assert not formatted[500].escaped
    assert format_chats(frame.limit(0)).count() == 0


def test_escape_is_reversible(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(BITS) for _ in range(12)) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(x in r.e for x in ("[INST]", "[/INST]", "</s>"))


def test_no_python_in_the_plan(spark):
    plan = chat_digest(format_blocks(spark.createDataFrame(conversations(), SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_time_grows_with_the_turns(spark):
    """Four times the turns of one conversation take at most four times as long, and a constant."""

    def seconds(n):
        frame = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.concat(F.lit("</s> text "), "id").alias("text"))
        began = time.perf_counter()
        (r,) = chat_digest(format_blocks(frame)).collect()
        took = time.perf_counter() - began
        loss = "".join(f"</s> text {i}" for i in range(n))
        assert (r.n_turns, r.loss_sha256) == (n, hashlib.sha256(loss.encode()).hexdigest())
        return took

    seconds(1000)
    assert seconds(40_000) < 4 * seconds(10_000) + 5


def test_places_of_several_blocks(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"é{t}" + "[INST]" * (t == 70), None) for t in range(100)]
    (r,) = format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [unescaped(r.formatted[x.start : x.end]) for x in r.turns] == [x[3] for x in rows]
    assert [(x.start, x.end) for x in r.loss_mask] == [(x.start, x.end) for x in r.turns if x.role == "assistant"]


def unescaped(text):
    return text.replace("[\\INST]", "[INST]")
