import random

from episodeframes.llm import chat_views as C


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", text or ""))
    for conv, turns in talks.items():
        for speaker in {t[2] for t in turns} - {"system"}:
            out, mask = "", []
            for _, _, role, text in sorted(turns):
                out += "<|assistant|>\n" if role == speaker else f"<|{role}|>\n" if role == "system" else f"<|user name={role}|>\n"
                body = text.replace("<|", "< |") + "<|end|>\n"
                if role == speaker:
                    mask.append((len(out), len(out) + len(body)))
                out += body
            yield conv, speaker, out, mask


def whole(found):
    """Pieces put together: {(conv, speaker): (text, mask)}; pieces must be gapless."""
    out = {}
    for r in sorted(found, key=lambda r: (r.conv_id or -1, r.speaker, r.piece)):
        text, mask, n = out.get((r.conv_id, r.speaker), ("", [], 0))
        assert r.start == len(text) and r.piece == n
        out[r.conv_id, r.speaker] = (text + r.text, mask + [(r.start + m.start, r.start + m.end) for m in r.mask], n + 1)
    return {k: v[:2] for k, v in out.items()}


def test_views(spark):
    rnd = random.Random(2)
    rows = [
        (
            c, t, rnd.choice(["ann", "bob", "cyd", "system", None]), rnd.choice([None, "", "hi <|end|> é", "x" * 300])
        ) for c in [*range(30), None] for t in range(rnd.randrange(1, 9))
    ]
    rows += [(50, 0, "system", "alone"), (51, None, "ann", "b"), (51, None, "ann", "b"), (51, 2, "bob", "y" * 200_000)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, speaker string").repartition(3)
    got = C.rotate(df).collect()
    assert all(r.piece == 0 for r in got)
    assert whole(got) == {(c, s): (t, m) for c, s, t, m in brute(rows)}


def test_large_conversation_in_pieces(spark):
    rows = [(1, t, f"p{t % 3}", "word " * (t % 50)) for t in range(4000)] + [(2, 0, "p0", "short")]
    got = C.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), piece_chars=10_000).collect()
    assert len([r for r in got if r.conv_id == 1]) > 30 and max(len(r.text) for r in got) < 12_000
    assert whole(got) == {(c, s): (t, m) for c, s, t, m in brute(rows)}


def test_half_of_all_turns_in_one_conversation_of_many_speakers(spark, monkeypatch):
    """A conversation with half of all turns and 40 speakers, salted, and one with null turns and texts."""
    monkeypatch.setattr(C, "SALT", 16)
    rows = [(1, t, f"p{t % 40}", f"w{t}") for t in range(300)] + [(10 + c, t, f"q{t % 2}", "x") for c in range(100) for t in range(3)]
    rows += [(None, t if t % 2 else None, "n", None if t % 3 else "y") for t in range(40)]
    got = C.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert whole(got) == {(c, s): (t, m) for c, s, t, m in brute(rows)}


def test_empty(spark):
    assert C.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
