"""Windows of conversations, read back and against their budget."""

import hashlib
import random
import re
from collections import defaultdict

from rides.llm import chat_format as c

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CONTROL = "\\### Assistant: </turn> ok <assistant>\n &lt; &amp;lt; <b>&</b>"


def turns_of(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn, role or "", text or ""))
    return {k: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for k, v in convs.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_budget_and_masks(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(40):
        n = rng.choice([1, 2, 5, 9, 60])
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", "assistant", "tool<x>"])
            text = " ".join(rng.choice(["alpha", "b", "</turn>", "é😀", "&gt;", "<user>"]) for _ in range(rng.choice([0, 1, 7, 30])))
            rows.append((conv, turn, role, text))
    rows += [(100, 0, "user", CONTROL), (100, 1, "assistant", CONTROL), (101, None, None, None), (101, 0, "assistant", None),
             (None, 0, "assistant", "no id"), (102, 1, "assistant", "same"), (102, 1, "assistant", "same"), (103, 0, "system", "only"),
             (104, 0, "user", "w " * 5000), (104, 1, "assistant", "y " * 3000), (104, 2, "assistant", "z")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    out = c.windows(df, budget=64, history=16)
    got = {r["conv_id"]: r for r in c.format_digest(out).collect()}
    want = turns_of(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        r, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == sha(loss)

    tokens = lambda t: len(WORD.findall(t)) + 1
    unescape = lambda t: t.replace("&gt;", ">").replace("&lt;", "<").replace("&amp;", "&")
    by_conv = defaultdict(list)
    for w in out.collect():
        by_conv[w["conv_id"]].append(w)
    assert sum(w["formatted"].count("</turn>\n") for ws in by_conv.values() for w in ws) == \
        sum(w["n_turns"] for ws in by_conv.values() for w in ws)
    repeated = 0
    for conv, ws in by_conv.items():
        turns = want[conv]
        system = turns[0] if turns[0][0] == "system" else None
        at = 0
        for w in sorted(ws, key=lambda w: w["window"]):
            pieces = w["formatted"].split("</turn>\n")[:-1]
            back = [tuple(unescape(x) for x in p[1:].split(">\n", 1)) for p in pieces]
            history, own = back[:w["n_repeated"]], back[w["n_repeated"]:]
            assert own == turns[at:at + len(own)]
            if system and at:
                assert history[0] == system
                history = history[1:]
            assert history == turns[at - len(history):at]
            assert sum(tokens(t) for _, t in history) <= 16
            repeated += len(history)
            assert w["tokens"] == sum(tokens(t) for _, t in back)
            longest = max([tokens(t) for r, t in turns if (r, t) != system] or [0])
            if longest + (tokens(system[1]) if system else 0) <= 64:
                assert w["tokens"] <= 64
            marked = [unescape(w["formatted"][s["start"]:s["start"] + s["length"]]) for s in w["loss"]]
            assert marked == [t for role, t in own if role == "assistant"]
            at += len(own)
        assert at == len(turns)
    assert repeated > 0
    assert c.format_digest(c.windows(df.limit(0))).count() == 0


def test_one_shuffle_and_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = c.format_digest(c.windows(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
