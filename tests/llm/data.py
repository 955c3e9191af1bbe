"""Small awkward tables for every operator."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, n long, token long, "
          "id long, shard int, slot long, mark string, `rest` string, `count` string")


def make_texts(seed=1, n=60):
    """Texts with shared passages, near copies, copies, case and white space changes."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "Été", "naïve", "漢字", "A.B"]

    def some(k):
        return [rng.choice(vocabulary) for _ in range(k)]

    passage, line = some(60), some(14)
    out = []
    for i in range(n):
        w = some(rng.choice([3, 4, 5, 12, 13, 14, 40, 90]))
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w = w[:at] + passage + w[at:]
        if i % 4 == 0:
            w = w + line
        if i % 5 == 0 and out:
            w = rng.choice(out).split()
            for _ in range(rng.choice([0, 1, 2, len(w) // 8])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
        text = " ".join(w)
        if i % 7 == 0:
            text = text.upper().replace(" ", "\n\t ", 3)
        out.append(text)
    return out


def awkward(seed=1):
    """(doc_id, text, source): nulls, empty and long texts, ties, repeated rows and ids."""
    texts = make_texts(seed)
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    long = " ".join(f"x{i % 997}y{i % 13}" for i in range(30_000))
    rows += [(100, None, "s0"), (101, "", "s1"), (102, " \n\t ", None), (103, "one", "s1"), (104, "ONE", "s2"),
             (105, long, "s0"), (106, long + " end", "s0"), (107, "a" * 50_000, "s0"), (108, "w1 " * 40, "s0"),
             (109, "w1 " * 41, "s0")]
    rows += [rows[3], rows[3], (5, texts[9], "s1"), (None, texts[2], "s1"), (None, texts[2], None),
             (None, None, None), (110, texts[0], "s0"), (111, texts[0].lower(), "s0")]
    return rows


def frame(spark, rows):
    """The rows as documents, with other columns of names that operators use inside."""
    wide = [(i, t, None, s, None if t is None else len(t), 1, None, 7, None, 3, "m", None, "c")
            for i, t, s in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
