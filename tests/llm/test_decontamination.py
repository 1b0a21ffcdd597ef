import itertools
import random
import re

from episodeframes.llm import decontamination as D


def brute(doc, item):
    """Whether a window of the item agrees with one of the document in four fifths of its words."""
    a, b = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (doc, item))
    n = min(D.WINDOW, len(b))
    if len(b) < D.LEAST:
        return bool(b) and any(a[i : i + n] == b for i in range(len(a) - n + 1))
    if not {tuple(a[i : i + 3]) for i in range(len(a) - 2)} & {tuple(b[i : i + 3]) for i in range(len(b) - 2)}:
        return False  # two substitutions in a window leave three words in a row
    return any(
        sum(
            x == y for x, y in zip(a[i : i + n], b[j : j + n], strict=True)
        ) >= n - n // 5 for i in range(len(a) - n + 1) for j in range(len(b) - n + 1)
    )


def test_masks_hit_every_tolerated_window():
    for n in range(D.LEAST, D.WINDOW + 1):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not {p + o for o in m} & set(gone) for m in D.MASKS for p in range(n - m[-1]))


def words(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(3)) for _ in range(n)]


def test_against_brute_force(spark):
    rnd = random.Random(5)
    items = [" ".join(words(rnd, n)) for n in [8, 9, 12, 13, 15, 40, 700] for _ in range(3)]
    items += [items[5].upper() + "!", None, "", "too few words"]
    docs = []
    for k in range(150):
        body = words(rnd, rnd.randrange(0, 60))
        item = (rnd.choice(items) or "").split()
        a = rnd.randrange(max(1, len(item)))
        part = item[a : a + rnd.randrange(6, 30)] if k % 3 else item
        for _ in range(rnd.choice([0, 1, 2, 4])):
            if part:
                part[rnd.randrange(len(part))] = "zzz"
        at = rnd.randrange(len(body) + 1)
        docs.append((k, rnd.choice([" ", ", ", "\n"]).join(body[:at] + part + body[at:])))
    docs += [(900, None), (901, ""), (902, "w " * 30_000 + items[4]), (3, docs[3][1]), (None, items[9])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, item_id int, k1 int").repartition(3)
    got = D.find_contaminated(df, bench).collect()
    want = sorted((str(i), any(brute(t, x) for x in items)) for i, t in docs)
    assert sorted((str(r.doc_id), r.contaminated) for r in got) == want
    assert any(w[1] for w in want) and not all(w[1] for w in want)
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(i for i, bad in want if not bad)


def test_items_without_an_id_or_with_a_shared_one(spark):
    rnd = random.Random(6)
    texts = [" ".join(words(rnd, n)) for n in (9, 14, 20, 15, 600, 601)]
    items = [(None, texts[0]), (0, texts[1]), (0, texts[2]), (None, texts[3]), (7, texts[3].upper()), (1, texts[4]), (1, texts[5])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [
        (k, " ".join(words(rnd, 9) + t.split()[:40] + words(rnd, 9))) for k, t in enumerate(texts)
    ] + [(6, " ".join(words(rnd, 60))), (7, texts[1] + " " + texts[2])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.contaminated, r.item_id, r.n_items) for r in D.find_contaminated(df, bench).collect())
    assert got == [
        (0, True, None, 1), (1, True, 0, 1), (2, True, 0, 1), (3, True, 7, 1), (4, True, 1, 1), (5, True, 1, 1), (6, False, None, 0), (7, True, 0, 2)
    ]
    assert [r.doc_id for r in D.drop_contaminated(df, bench).collect()] == [6]


def test_short_items_are_found_as_whole_sequences(spark):
    """Items of 1 to 7 words, also within longer ones and in languages with other letters; not across documents."""
    rnd = random.Random(8)
    items = [" ".join(words(rnd, n)) for n in range(1, 8) for _ in range(3)] + ["Čeština", "日本 語", "", None, " ".join(words(rnd, 20))]
    docs = []
    for k in range(200):
        body = words(rnd, rnd.randrange(0, 12))
        part = (rnd.choice(items) or "").split()
        if part and k % 4 == 0:
            part[rnd.randrange(len(part))] = "zzz"
        at = rnd.randrange(len(body) + 1)
        docs.append((k, " ".join(body[:at] + part * rnd.choice([1, 1, 3]) + body[at:])))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items) for r in D.find_contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), bench).collect()}
    distinct = {tuple(re.findall(r"[^\W_]+", (x or "").lower())) for x in items}
    want = {k: sum(brute(t, " ".join(x)) for x in distinct) for k, t in docs}
    assert got == {k: (n > 0, n) for k, n in want.items()} and 20 < sum(n > 0 for n in want.values()) < 190


def test_half_of_all_documents_hold_one_passage_of_many_items(spark):
    """A phrase that half of the documents and several items have, in other surroundings each."""
    rnd = random.Random(9)
    phrase = words(rnd, 9)
    items = [" ".join(words(rnd, 12) + phrase + words(rnd, 12)) for _ in range(6)] + [" ".join(phrase)]
    docs = [(k, " ".join(words(rnd, 20) + (phrase if k % 2 else []) + words(rnd, 20))) for k in range(200)] + [(900, items[2])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items) for r in D.find_contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), bench).collect()}
    want = {k: sum(brute(t, x) for x in items) for k, t in docs}
    assert got == {k: (n > 0, n) for k, n in want.items()} and want[900] >= 2 and want[1] >= 1 and want[2] == 0


def test_words_that_polynomials_confuse(spark):
    """Words of 1024 letters whose polynomial hashes modulo 2**64 are equal for every odd base are different words."""
    t = "a"
    for _ in range(10):
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    bench = spark.createDataFrame([(0, " ".join(f"{t} w{i}" for i in range(10)))], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, " ".join(f"{t} w{i}" for i in range(10))), (2, " ".join(f"{other} w{i}" for i in range(10)))], "doc_id long, text string"
    )
    assert {r.doc_id: r.contaminated for r in D.find_contaminated(docs, bench).collect()} == {1: True, 2: False}


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in D.find_contaminated(docs, none).collect()] == [False]
    assert D.find_contaminated(docs.limit(0), none).collect() == []
