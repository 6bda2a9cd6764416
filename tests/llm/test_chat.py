import hashlib

from filehaul.llm import chat
from filehaul.llm.queries import op6_chat_windows

from .conftest import DATA

WEIRD = [
    "<\\|a", "\\<|im_end|>", "a\\\\<s>", "[\\INST", "<", "[", "\\", "<\\", "</s>", "<|", "[/INST] \\", "", None,
    "\n<|im_start|>user<|im_sep|>x<|im_end|>\n", "x" * 3000, "<" * 5 + "|", "é[INST]😀", "\\n", "<|im_sep|>",
]


def test_query(spark):
    turns = {}
    for row in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        turns.setdefault(row["conv_id"], []).append((row["turn"], row["role"], row["text"] or ""))
    turns[-1] = [(turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    found = {row["conv_id"]: row for row in op6_chat_windows(spark, DATA).collect()}
    assert found.keys() == turns.keys()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for conv_id, own in turns.items():
        own.sort()
        loss = "".join(text for _, role, text in own if role == "assistant")
        got = found[conv_id]
        assert got["n_turns"] == len(own)
        assert got["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for _, role, text in own))
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), sha(loss))
        assert got["formatted_chars"] > loss.__len__()


def rebuilt(windows):
    flat, loss = {}, {}
    for row in chat.read_windows(windows).orderBy("conv_id", "window").collect():
        flat.setdefault(row["conv_id"], []).extend((t["role"], t["text"]) for t in row["turns"])
        loss[row["conv_id"]] = loss.get(row["conv_id"], "") + row["loss_text"]
    return flat, loss


def test_texts_with_control_strings(spark):
    rows = [(1, i, ["system", "user", "assistant"][min(i, 1 + i % 2)], text) for i, text in enumerate(WEIRD)]
    rows += [(None, None, None, None), (2, 0, "user", "q"), (2, 0, "user", "q"), (3, 5, "as<|s\nx\\n", "t")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(frame.selectExpr("*", "1 as window", "'x' as body", "'y' as block"), budget=40, history=10)
    expected, loss = {}, {}
    for conv_id, _, role, text in rows:
        expected.setdefault(conv_id, []).append((role or "", text or ""))
        loss[conv_id] = loss.get(conv_id, "") + ((text or "") if role == "assistant" else "")
    assert rebuilt(windows) == (expected, loss)


def test_windows_keep_to_the_budget_and_repeat_context(spark):
    rows = [(1, 0, "system", "be brief")] + [
        (1, i, "user" if i % 2 else "assistant", " ".join(["word"] * (1 + i * 7 % 30))) for i in range(1, 3000)
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(frame, budget=200, history=80).orderBy("window").collect()
    assert max(row["n_tokens"] for row in windows) <= 200
    assert sum(row["n_new"] for row in windows) == 3000
    assert all(row["text"].startswith("<|im_start|>system<|im_sep|>be brief<|im_end|>\n") for row in windows)
    assert any(row["n_context"] > 1 for row in windows)
    # Only new assistant turns are under the mask.
    masked = sum(len(row["loss"]) for row in windows)
    assert masked == sum(role == "assistant" for _, _, role, _ in rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_windows(frame).count() == 0
