import hashlib
import random

from daybook.llm import chat
from tests.llm.util import frame


def plain(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns = sorted(turns, key=lambda t: (t[0], t[1] if t[0] else 0, t[2], t[3]))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        runs = sum(i == 0 or turns[i][2] != turns[i - 1][2] for i in range(len(turns)))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss), runs)
    return out


def check(spark, rows):
    chats = chat.format_chats(frame(spark, rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.digests(chats).collect()}
    want = plain(rows)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_messages) for c, r in got.items()} == want
    formatted = {r.conv_id: r.formatted for r in chats.collect()}
    assert all(len(formatted[c]) == r.formatted_chars for c, r in got.items())
    return formatted


def test_any_text_comes_back(spark):
    rng = random.Random(1)
    bits = ["<turn>", "</turn>\n", "<part>", "### ", "\\", "\\l", "\\b", ": ", "assistant", "\n", "é", "🎉", " ok", "<", "#", ""]
    said = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
    roles = ["user", "assistant", "system", "a: b", "<x>", "\\c", "", None]
    rows = [(c, t, rng.choice(roles), said()) for c in range(60) for t in range(rng.randint(1, 7))]
    check(spark, rows)


def test_merging_and_template(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c<d"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    formatted = check(spark, rows)
    assert formatted[1] == "<turn>### user: a<part>b</turn>\n<turn>### assistant: c\\ld</turn>\n"
    assert formatted[-7].count("</turn>") == 1


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (1, 0, "user", "b"), (1, 0, "assistant", "b"), (1, 0, "user", "b"), (None, 3, "user", "")]
    check(spark, rows)
    assert check(spark, []) == {}
    check(spark, [(2, t, "assistant" if t % 3 else "user", "word " * 50) for t in range(1500)])
