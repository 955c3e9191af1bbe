"""Text expressions against plain Python rules."""

import random
import re

from threadglean import constants as K
from threadglean.functions import text as X


def apply(spark, fn, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r[1] for r in df.select("i", fn("x")).orderBy("i").collect()]


def py_truncate(text, n=500):
    if text is None or len(text) <= n:
        return text
    head = text[:n]
    cut = max(head.rfind(ch) for ch in ".?!")
    if cut >= 0:
        return text[:cut + 1]
    space = head.rfind(" ")
    return (head if space < 0 else head[:space]) + "..."


def test_truncate(spark):
    rng = random.Random(7)
    values = [None, "", "a" * 500, "a" * 501, "." + "a" * 600, "word " * 200, "a b\n" * 200,
              "x" * 499 + ".y", "x" * 500 + ".", "é" * 501, "end? " + "q" * 600, "no\nstop " * 100]
    values += ["".join(rng.choice("ab  .?!\n") for _ in range(rng.randint(490, 520))) for _ in range(50)]
    values += ["".join(rng.choice("abcé \n") for _ in range(rng.randint(495, 530))) for _ in range(50)]
    got = apply(spark, X.truncate_sentences, values)
    assert got == [py_truncate(v) for v in values]
    assert all(v is None or len(v) <= 503 for v in got)


def test_word_counts(spark):
    nbsp, ideographic = " ", "　"
    values = ["", " ", "a", " a  b\n", nbsp.join("ab"), ideographic.join("abc"), "a\x1cb", "a\x85b",
              " ".join("w" * 59), " ".join("w" * 60), nbsp.join("w" * 60), "\n " + " ".join("w" * 60)]
    assert apply(spark, X.word_count, values) == [len(v.split()) for v in values]
    assert apply(spark, X.has_more_words, values) == [len(v.split()) > 59 for v in values]
    blanks = [None, "", " ", "\t\n", nbsp, "\x1f", "a", " a "]
    assert apply(spark, X.is_blank, blanks) == [v is None or v.strip() == "" for v in blanks]


def test_summarize(spark):
    short, limit = " ".join("w" * 59), " ".join("w" * 60)
    long = " ".join(f"w{i}" for i in range(100))
    early_stop = "One two. " + " ".join("w" * 90)
    late_stop = " ".join("w" * 20) + " end. " + " ".join("v" * 80)
    got = apply(spark, X.summarize_text, [None, "", " ", short, limit, long, early_stop, late_stop])
    assert got[:5] == ["", "", " ", short, limit]
    assert got[5] == " ".join(f"w{i}" for i in range(60))
    assert len(got[6].split()) == 60  # the sentence end leaves too few words
    assert got[7] == " ".join("w" * 20) + " end."


def test_masking(spark):
    pattern = X.mask_pattern(["damn", "ass", "asshole", "hell", "floor", "a$$", "bad word"])
    cases = {
        "damn it": "*** it", "DAMN!": "***!", "damnation": "damnation", "asshole ass": "*** ***",
        "the floor": "the floor", "wtf": "***", "what the f*ck": "***", "f.u.c.k off": "*** off",
        "the fck": "***", "bull cr@p": "***", "bullcrap": "***", "fucking hell": "*** ***",
        "éhell": "éhell", "hellé": "hellé", "a bad word.": "a ***.", "a$$": "a$$", "a$$x": "***x",
        None: None, "": "", "frank first": "frank first", "hell_": "hell_", "hell-o": "***-o",
    }
    got = apply(spark, lambda c: X.mask_words(c, pattern), list(cases))
    assert got == list(cases.values())


def test_masking_leaves_no_listed_word(spark):
    words = ["aa", "ab", "abc", "b", "ba"]
    pattern = X.mask_pattern(words)
    rng = random.Random(3)
    values = ["".join(rng.choice("abcAB é._") for _ in range(60)) for _ in range(200)]
    masked = apply(spark, lambda c: X.mask_words(c, pattern), values)
    for text in masked:
        assert not {t.lower() for t in re.findall(r"\w+", text)} & set(words)
    want = [re.sub(r"(?i)\b(abc|aa|ab|ba|b)\b", "***", v) for v in values]
    assert masked == want


def test_masking_of_words_with_other_capitals(spark):
    pattern = X.mask_pattern(["École", "Ärger", "ñu", "Damn"])
    texts = ["une École ici", "école", "viel Ärger.", "ñu", "ÉcoleÄrger", "DAMN", "xÄrger"]
    assert apply(spark, lambda c: X.mask_words(c, pattern), texts) == [
        "une *** ici", "école", "viel ***.", "***", "ÉcoleÄrger", "***", "xÄrger"]


def test_large_lexicon(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(4, 9)))
                    for _ in range(100_000)})
    assert len(words) > 99_000
    texts = [f"{w} {w}x {w.upper() if w.isascii() else w}, xx{w}" for w in words[::997]]
    known, got = set(words), apply(spark, lambda c: X.mask_words(c, X.mask_pattern(words)), texts)
    want = [re.sub(r"\w+", lambda m: "***" if m[0].lower() in known else m[0], t) for t in texts]
    assert got == want


def test_quality_labels(spark):
    bodies = ["", "a", "ab", "x" * 10000, "x" * 10001, None]
    assert apply(spark, X.comment_quality, bodies) == [
        "Too short", "Too short", "Valid", "Valid", "Too long", "Valid"]
    pairs = [(None, "body"), ("", "body"), ("  ", "body"), ("\t", "body"), ("four", "body"),
             ("fives", "body"), ("a", None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s string, b string")
    got = [r[1] for r in df.select("i", X.summary_quality("s", "b")).orderBy("i").collect()]
    assert got == ["Missing", "Missing", "Missing", "Valid", "Valid", "Invalid", "Valid"]


def py_clean(text):
    out = []
    for line in text.split("\n")[: -1 if text.endswith("\n") or text == "" else None]:
        kept = line.replace("```", "").rstrip()
        if kept or line.strip() == "":
            out.append(kept + "\n")
    return "".join(out)


def test_clean_markdown(spark):
    values = ["", "\n", "a", "a\n", "```md\nx  \n```\n", "\n\n```\n\n", "a```b``` \n \n```  ", "  \t\nend"]
    rng = random.Random(5)
    values += ["".join(rng.choice(["```", "a", " ", "\n", "\t"]) for _ in range(30)) for _ in range(100)]
    assert apply(spark, X.clean_markdown, values) == [py_clean(v) for v in values]


def test_tags_links_names(spark):
    titles = ["[D] x", "[D] [R] x", "x [P]", "x", "[]", None]
    assert apply(spark, X.title_tags, titles) == [["D"], ["D", "R"], ["P"], [], [], None]
    assert apply(spark, lambda c: X.markdown_link(c, c), ["[D] x"]) == ["[[D] x]([D] x)"]
    got = apply(spark, X.display_name, ["openai", "LocalLlama", "other"])
    assert got == ["OpenAI Subreddit", "LocalLLaMA Subreddit", "other Subreddit"]


def test_retitle(spark):
    text = 'title: "openai subreddit"\ndescription: "Analysis of top discussions and trends in the openai subreddit"'
    df = spark.createDataFrame([(text, "openai")], "t string, c string")
    assert df.select(X.retitle("t", "c")).first()[0] == text.replace('"openai subreddit"', '"OpenAI Subreddit"')


def test_text_block(spark):
    df = spark.createDataFrame(
        [("p", "s", 1, "u", "c", None, "t", "b", "m", 0.5, None)],
        "post_id string, subreddit string, post_score int, post_url string, comment_id string, "
        "summary_date date, post_content string, comment_body string, comment_summary string, "
        "sentiment_score double, sentiment_label string")
    block = df.select(X.text_block()).first()[0]
    assert block.startswith("~~~\n    post_id: p\n    subreddit: s\n")
    assert "\n    summary_date: None\n" in block
    assert block.endswith("\n    sentiment_score: 0.5\n    sentiment_label: None\n    ")
    assert block.count("\n") == len(K.BLOCK_FIELDS) + 1
