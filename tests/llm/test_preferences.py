from logtide.llm.preferences import broken_off, preference_segments

SCHEMA = "pair_id long, turn long, role string, text string"


def brute(chosen, rejected):
    out = set()
    shape = lambda rows: {(p, t): min((r or "", x or "") for q, u, r, x in rows if (q, u) == (p, t)) for p, t, _, _ in rows if p is not None and t is not None}
    c, x = shape(chosen), shape(rejected)
    for pair in {p for p, _ in [*c, *x]}:
        turns = sorted(t for p, t in {*c, *x} if p == pair)
        stop = next((t for t in turns if c.get((pair, t)) != x.get((pair, t))), float("inf"))
        for part, side in (("prompt", c), ("chosen", c), ("rejected", x)):
            for t in turns:
                if (pair, t) in side and (part == "prompt") == (t < stop):
                    role, text = side[pair, t]
                    head = f"<|im_start|>{role}\n"
                    body = f"{head}{text}<|im_end|>\n"
                    out.add((pair, part, t, role, body, len(head) if part != "prompt" and role == "assistant" else len(body)))
    return out


def test_equal_to_brute_force(spark):
    talk = [(0, "system", "be kind"), (1, "user", "hé?"), (2, "assistant", "yes"), (3, "user", "go on"), (4, "assistant", "sure")]
    chosen = [(1, *t) for t in talk] + [(2, *t) for t in talk] + [(3, 0, "user", None), (4, 0, None, "x"), (5, 0, "user", "only here")]
    rejected = [(1, *t) for t in talk[:2]] + [(1, 2, "assistant", "no")] + [(2, *t) for t in talk] + [(3, 0, "user", ""), (4, 0, "", "x"), (6, 1, "assistant", "")]
    chosen += [(1, 1, "user", "hé?"), (None, 0, "user", "lost"), (7, None, "user", "lost"), (1, 1, "user", "zzz")]
    c, x = (spark.createDataFrame(rows, SCHEMA) for rows in (chosen, rejected))
    got = preference_segments(c, x).collect()
    assert set(map(tuple, got)) == brute(chosen, rejected) and len(got) == len(set(got))


def test_masks_cover_answers_only(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a long answer" * 10_000), (2, 0, "user", "q")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA.replace("pair_id", "conv_id") + ", segment string")
    got = preference_segments(df, broken_off(df), "conv_id").collect()
    trained = {(r.conv_id, r.part): r.segment[r.train_from :] for r in got}
    assert trained[1, "chosen"] == rows[1][3] + "<|im_end|>\n"
    assert trained[1, "rejected"] == rows[1][3][: len(rows[1][3]) // 2] + "<|im_end|>\n"
    assert trained[1, "prompt"] == trained[2, "prompt"] == "" and len(got) == 4


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert preference_segments(df, df).count() == 0
