"""Chat windows: blocks of long conversations, budgets, history by order."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest

from tallyseq.llm import chat_windows, queries, token_spans

KIND = "conv_id long, turn long, role string, text string"
TOKENIZER = public_tokenizers.path(queries.RANK_TOKENIZER), public_tokenizers.PATTERN


def told(rows, conv):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t in rows if c == conv).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    role = lambda i: "system" if i == 0 else ("user", "assistant")[i % 2 == 0]
    made = [(1, i, role(i), f"turn {i} " * (3 + i % 5)) for i in range(50)]
    made += [(3, i * 300, role(i), f"sparse {i}") for i in range(12)]
    return made + [(None, 0, None, None), (2, 0, "assistant", "long " * 400)]


@pytest.mark.parametrize("long", [2048, 10])
def test_blocks_and_budget(spark, rows, long):
    turns = spark.createDataFrame(rows[::-1], KIND)
    how = dict(budget=120, block=16, long=long)
    windows = chat_windows.format_windows(turns, TOKENIZER, **how).collect()
    assert [r.conv_id for r in windows if r.n_tokens > 120] == [2] and all(r.over_budget == (r.n_tokens > 120) for r in windows)
    for conv in (1, 3):
        own = sorted((r for r in windows if r.conv_id == conv), key=lambda r: (r.block, r.window))
        texts = [t for c, _, _, t in rows if c == conv]
        new = 0
        for r in own:
            parsed = [(role, text) for role, text, _, _ in chat_windows.parse(r.formatted)]
            assert parsed[0][0] == "system"
            context = [t for _, t in parsed[1 if new else 0 : r.new_from]]
            assert context == texts[new - len(context) : new]  # the turns just before, in order
            if new > 2:
                assert context, "history is repeated"
            new += len(parsed) - r.new_from
        assert new == len(texts)
    got = {r.conv_id: r for r in chat_windows.digest_turns(turns, TOKENIZER, **how).collect()}
    assert set(got) == {1, 2, 3, None} and len(got) == 4
    assert all(got[c].turns_sha256 == told(rows, c) for c in got)


def brute(turns, budget, block, system_budget=512, history_turns=2, history_budget=256):
    """Windows of one conversation, (turn, role, text) in order, by the rules of the module alone: formatted text and context."""
    encoding, _ = token_spans.load(*TOKENIZER)
    form = lambda role, text: chat_windows.format_turn(role, text)[0]
    size = lambda t: len(encoding.encode_ordinary(form(*t)))
    turns = [(n, (role or "", text or "")) for n, role, text in turns]
    system = turns[0][1] if turns[0][1][0] == "system" and size(turns[0][1]) <= system_budget else None
    out, at = [], 0
    while at < len(turns):
        context = [system] if system and at else []
        past, room = [], history_budget
        for _, t in turns[max(0, at - history_turns) : at][::-1]:
            room -= size(t)
            if room < 0 or t == (system if at else None):
                break
            past.insert(0, t)
        if sum(map(size, context + past)) + size(turns[at][1]) <= budget:
            context += past
        end, held = at + 1, sum(map(size, context)) + size(turns[at][1])
        number = lambda n: None if n is None else n // block
        while end < len(turns) and held + size(turns[end][1]) <= budget and number(turns[end][0]) == number(turns[at][0]):
            held += size(turns[end][1])
            end += 1
        out.append(("".join(form(*t) for t in context + [t for _, t in turns[at:end]]), len(context)))
        at = end
    return out


@pytest.mark.parametrize("long", [1, 40, 10**9])
@pytest.mark.parametrize("block", [16, 256])
def test_windows_depend_on_the_conversation_alone(spark, rows, long, block):
    more = rows + [(5, None, "system", "be brief"), *[(5, i, ("user", "assistant")[i % 2], f"word {i} " * (i % 9)) for i in range(0, 700, 3)], (6, 0, "user", "a"), (6, 256, "system", "late rule"), (6, 257, "user", "b"), (6, 600, "user", "c")]
    found = chat_windows.format_windows(spark.createDataFrame(more, KIND), TOKENIZER, budget=200, block=block, long=long).orderBy("conv_id", "block", "window").collect()
    for conv in (1, 2, 3, 5, 6, None):
        own = [(r.formatted, r.new_from) for r in found if r.conv_id == conv]
        assert own == brute([r[1:] for r in more if r[0] == conv], 200, block)


def test_query_against_brute_force(spark):
    talks = defaultdict(list)
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect():
        talks[r.conv_id].append((r.turn, r.role, r.text))
    talks[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r.formatted_chars for r in queries.op5_chat_windows(spark, "/root/testdata/sf0.001").collect()}
    assert got == {c: sum(len(f) for f, _ in brute(t, chat_windows.BUDGET, chat_windows.BLOCK)) for c, t in talks.items()}


def test_history_crosses_short_blocks(spark, rows):
    turns = spark.createDataFrame([r for r in rows if r[0] == 3], KIND)
    windows = chat_windows.format_windows(turns, TOKENIZER, long=1, block=256).orderBy("block", "window").collect()
    assert len(windows) == 12  # a block each
    assert [w.new_from for w in windows] == [0, 1, 2] + [3] * 9
    assert [t for _, t, _, _ in chat_windows.parse(windows[5].formatted)] == ["sparse 0", "sparse 3", "sparse 4", "sparse 5"]


def test_long_system_turn_is_not_repeated(spark):
    rows = [(1, 0, "system", "rule " * 3000)] + [(1, i, ("user", "assistant")[i % 2 == 0], f"short {i} ") for i in range(1, 41)]
    turns = spark.createDataFrame(rows, KIND)
    windows = chat_windows.format_windows(turns, TOKENIZER, budget=64).orderBy("window").collect()
    assert sum(len(w.formatted) for w in windows) < 2 * sum(len(r[3]) for r in rows)
    assert [w.over_budget for w in windows] == [True] + [False] * (len(windows) - 1)
    assert chat_windows.digest_turns(turns, TOKENIZER, budget=64).first().turns_sha256 == told(rows, 1)


def test_odd_turns(spark):
    text = "</s>[INST] \\ <<SYS>> " * 20_000
    rows = [(1, None, "odd\nrole", text), (1, 1, "assistant", ""), (1, 1, "assistant", "")]
    turns = spark.createDataFrame(rows, KIND)
    got = chat_windows.digest_turns(turns, TOKENIZER).first()
    assert (got.n_turns, got.loss_chars, got.turns_sha256) == (3, 0, told(rows, 1))
    assert chat_windows.digest_turns(turns.limit(0), TOKENIZER).count() == 0
