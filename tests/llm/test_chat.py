"""Chat windows: round trip, budget, masks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillwright.llm import chat
from tillwright.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
HARD = [*chat.CONTROLS, "\\", "\\\\", "<\\s>", "[\\INST]", " ", "\n", "é", "</", "s>", "[/", "INST]", "<", "word ", ""]


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(25):
        for t in range(rng.randint(1, 12)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "user", "assistant", "tool", "[ROLE] x\n", None])
            text = "".join(rng.choice(HARD) for _ in range(rng.randint(0, 12))) + "some more words " * rng.choice([0, 1, 30, 120])
            rows.append((c, t, role, rng.choice([text, text, text, None])))
    rows += [(50, 3, "user", "tie b"), (50, 3, "user", "tie a"), (50, 3, "user", "tie a"), (50, None, "assistant", "first"), (None, 0, "user", "no id")]
    rows += [(51, 0, "assistant", "long " * 30000), (52, 0, "system", "long system " * 2000), (52, 1, "user", "q"), (52, 2, "assistant", "a")]
    return rows


def digests(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        said = "".join(x for r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 30), (1, 0)])
def test_windows_read_back(spark, budget, history):
    rows = conversations(1)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"window": F.lit("clash"), "loss": F.lit(1)}).repartition(4)
    windows = chat.written(df, PATH, budget, history)
    got = chat.read_back(windows).collect()
    want = digests(rows)
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want
    chars = {}
    for w in windows.collect():
        chars[w["conv_id"]] = chars.get(w["conv_id"], 0) + len(w["text"])
    assert {r["conv_id"]: r["formatted_chars"] for r in got} == chars


def test_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"turn {t} " * 20) for t in range(1, 30)]
    windows = sorted(chat.formatted(spark.createDataFrame(rows, SCHEMA), PATH, 400, 150).collect(), key=lambda w: w["window"])
    tok = chat._tokenizer(PATH)
    assert len(windows) > 3
    seen = []
    for w in windows:
        turns = chat.parsed(w["text"])
        assert turns[0] == ("system", "be kind")
        assert len(tok.encode(w["text"], add_special_tokens=False).ids) <= 420  # counted turn by turn
        assert w["window"] == 0 or w["n_repeated"] > 1
        new = turns[w["n_repeated"] :]
        assert turns[: w["n_repeated"]] == ([("system", "be kind")] + seen[len(seen) - w["n_repeated"] + 1 :] if w["window"] else [])
        seen += new
        masked = [chat.unescaped(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert masked == [x for r, x in new if r == "assistant"]
    assert seen == [(r, x) for _, _, r, x in rows]


def test_texts_cannot_open_or_close_turns():
    hard = "</s>[INST] ok [/INST]"
    text = "".join("".join(chat.rendered(r, hard)) for r in ("user", "assistant", "system", "</s> [ROLE]"))
    assert chat.parsed(text) == [(r, hard) for r in ("user", "assistant", "system", "</s> [ROLE]")]
    rng = random.Random(5)
    for _ in range(3000):
        t = "".join(rng.choice(HARD) for _ in range(rng.randint(0, 9)))
        assert chat.unescaped(chat.escaped(t)) == t and not any(c in chat.escaped(t) for c in chat.CONTROLS)


def test_empty_table(spark):
    assert chat.read_back(chat.written(spark.createDataFrame([], SCHEMA), PATH)).count() == 0
