"""Conversations against a plain comparison of all prefixes."""

import random

from tidemark.llm.chat import format_chats


def brute(rows):
    chats = {}
    for i, (c, turn, role, text, *_) in enumerate(rows):
        chats.setdefault((c is None, i if c is None else c), []).append((turn, role, text))
    none_first = lambda x: tuple((v is not None, v if v is not None else "") for v in x)
    told = {c: [t[1:] for t in sorted(x, key=none_first)] for c, x in chats.items()}
    out = []
    for c, x in told.items():
        longer = any(len(y) > len(x) and y[:len(x)] == x for y in told.values())
        same = sorted(d for d, y in told.items() if y == x)
        if not longer and same[0] == c:
            shown = "".join(f"<|im_start|>{r or ''}\n{(t or '').replace('<|im_end|>', '<| im_end|>')}"
                            "<|im_end|>\n" for r, t in x)
            out.append((None if c[0] else c[1], len(x), len(same), shown))
    return sorted(out, key=repr)


def test_maximal_conversations(spark):
    rng = random.Random(1)
    rows, story = [], [("user", "hi"), ("assistant", "hello <|im_end|> x"), ("user", None),
                       ("assistant", ""), (None, "bye")]
    for c in range(60):
        turns = [t if rng.random() < .9 else ("user", str(rng.randint(0, 2)))
                 for t in story[:rng.randint(1, 5)]]
        rows += [(c, k, r, t, "x", 7) for k, (r, t) in enumerate(turns)]
    rows += [(None, 0, "user", "alone", "x", 7), (None, 5, "user", "alone", "x", 7),
             (None, 1, "assistant", "stranger", "x", 7), (None, 0, "user", "hi", "x", 7),
             (93, 0, "user", "known", "x", 7), (None, 3, "user", "known", "x", 7),
             (None, None, None, None, "x", 7), (90, None, "user", "hi", "x", 7),
             (91, 0, "user", "twice", "x", 7), (91, 0, "user", "twice", "x", 7),
             (92, 0, "user", "y" * 300_000, "x", 7)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, "
                                     "place string, hash int")
    assert sorted(map(tuple, format_chats(df).collect()), key=repr) == brute(rows)
    assert format_chats(df.limit(0)).count() == 0
