from __future__ import annotations

from relievo.llm import chat


def brute(rows):
    convs: dict = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, role, text))
    first = lambda v: (v is not None, v if v is not None else 0)
    order = lambda x: (first(x[0]), (x[1] is not None, x[1] or ""), (x[2] is not None, x[2] or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v, key=order)] for c, v in convs.items()}
    out = []
    for c, v in turns.items():
        same = sorted((k for k in turns if turns[k] == v and k is not None), key=repr)
        lead = min(same) if same else None
        if c == lead and not any(len(w) > len(v) and w[: len(v)] == v for w in turns.values()):
            n = sum(turns[k] == v for k in turns)
            out.append((c, len(v), n, "".join(f"<|{r or ''}|>\n{x or ''}<|end|>\n" for r, x in v)))
    return sorted(out, key=repr)


def test_snapshots_collapse(spark):
    talk = [("system", "be brief"), ("user", "hi"), ("assistant", "hello"), ("user", None), (None, "x")]
    rows = [(c, k, *talk[k]) for c, n in ((1, 2), (2, 3), (3, 5), (4, 5), (5, 1)) for k in range(n)]
    rows += [(6, 0, "user", "hi"), (7, 0, "user", "other"), (7, 1, "assistant", ""), (8, 0, "user", "other"), (8, 1, "assistant", None)]
    rows += [(9, None, "user", "a"), (9, 0, "user", "b"), (9, 0, "user", "b"), (None, 0, "user", "q")]
    turns = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, n int, h1 string")
    assert sorted((tuple(r) for r in chat.format_chats(turns).collect()), key=repr) == brute(rows)
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_conversations_without_an_id_and_long_ones(spark):
    rows = [(None, k, "user", f"q{k}") for k in range(4)] + [(1, k, "user", f"q{k}") for k in range(3)] + [(2, k, "user", "y" * 100_000 if k == 500 else f"t{k}") for k in range(900)]
    rows += [(3, k, "user", f"t{k}") for k in range(400)] + [(c, 0, "user", "same start") for c in range(10, 60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in chat.format_chats(turns).collect()), key=repr) == brute(rows)
