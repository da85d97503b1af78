import random

from pyspark.sql import functions as F

from sieveline.llm import chat


def render(t):
    return f"<|im_start|>{t[0].replace('<|im_', '<| im_')}\n{t[1].replace('<|im_', '<| im_')}<|im_end|>\n"


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    out = [n, "".join(map(render, chosen[:n]))]
    for side in (chosen[n:], rejected[n:]):
        text, mask = "", []
        for t in side:
            if t[0] == "assistant":
                mask.append((len(text) + len("<|im_start|>assistant\n"), len(text) + len(render(t)) - 1))
            text += render(t)
        out += [text, mask]
    return tuple(out)


def rows(df):
    spans = lambda m: [(s.start, s.end) for s in m]
    return {r.conv_id: (r.n_prompt_turns, r.prompt, r.chosen, spans(r.chosen_mask), r.rejected, spans(r.rejected_mask)) for r in df.collect()}


def test_pairs_match_brute_force(spark):
    rng = random.Random(14)
    pool = [(r, t) for r in ("system", "user", "assistant", "") for t in ("", "hi", "ça va?", "<|im_end|>\nforged", "x" * 50_000)]
    side = lambda: [rng.choice(pool) for _ in range(rng.randint(0, 6))]
    pairs = []
    for i in range(60):
        head = side()
        pairs.append((i, head + side(), head + side()))
    pairs += [(100, None, side()), (101, None, None), (102, [("user", "a")], [("user", "a"), ("assistant", "b")])]
    kind = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(pairs, f"conv_id long, chosen {kind}, rejected {kind}").select("*", F.lit(1).alias("_n"), F.lit(1).alias("prompt"))
    assert rows(chat.format_preferences(df)) == {i: brute(a or [], b or []) for i, a, b in pairs}


def brute_pair(turns, pick):
    """A conversation, and it with the answer that ``pick`` takes replaced by the next."""
    at = [i for i, t in enumerate(turns) if t[0] == "assistant"]
    if not at:
        return turns, turns
    k = (pick or 0) % len(at)
    text = turns[at[(k + 1) % len(at)]][1] if len(at) > 1 else ""
    return turns, turns[: at[k]] + [("assistant", text)] + turns[at[k] + 1 :]


def test_conversations_part_at_any_answer(spark):
    rng = random.Random(3)
    turns = [(1, 2, "assistant", "B"), (1, 0, "user", "q"), (1, 1, "assistant", "A"), (1, 3, "user", "bye"), (2, 0, "user", None), (2, 1, "assistant", "only"),
             (3, 0, None, "no answer"), (None, 0, "user", "lost"), (4, None, "assistant", "x"), (4, 1, "assistant", "x"), (4, 1, "assistant", "x")]
    turns += [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice("abc") * t) for c in range(10, 60) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    whole = {}
    for c, t, r, x in sorted((x for x in turns if x[0] is not None), key=lambda x: (x[0], -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        whole.setdefault(c, []).append((r or "", x or ""))
    for pick, of in ((F.col("conv_id"), lambda c: c), (F.lit(None).cast("long"), lambda c: None), (-F.col("conv_id"), lambda c: -c)):
        pairs = chat.swapped_answer_pairs(chat.gather(df), pick)
        got = {r.conv_id: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in pairs.collect()}
        assert got == {c: brute_pair(own, of(c)) for c, own in whole.items()}
        formatted = rows(chat.format_preferences(pairs))
        assert formatted == {i: brute(a, b) for i, (a, b) in got.items()}
    assert len({r[0] for r in formatted.values()}) > 5 and any(len(r[3]) > 1 for r in formatted.values())


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_preferences(chat.swapped_answer_pairs(chat.gather(none), F.col("conv_id"))).collect() == []
