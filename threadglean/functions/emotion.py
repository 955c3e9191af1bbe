"""Emotion labels and the built-in cue-word classifier, as column expressions."""

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import is_blank, truncate_sentences, words_regex

# Cue words of the built-in classifier; pass another mapping to replace them.
DEFAULT_CUES = {
    "admiration": ["impressive", "brilliant", "amazing", "respect"],
    "amusement": ["lol", "haha", "funny", "hilarious"],
    "anger": ["angry", "furious", "outrage", "rage"],
    "annoyance": ["annoying", "annoyed", "irritating", "tedious"],
    "approval": ["agree", "agreed", "exactly", "correct"],
    "caring": ["care", "support", "careful", "comfort"],
    "confusion": ["confused", "confusing", "unclear", "puzzled"],
    "curiosity": ["curious", "wonder", "wondering", "interested"],
    "desire": ["want", "wish", "hoping", "crave"],
    "disappointment": ["disappointed", "disappointing", "letdown", "underwhelming"],
    "disapproval": ["disagree", "wrong", "oppose", "unacceptable"],
    "disgust": ["disgusting", "gross", "awful", "nasty"],
    "embarrassment": ["embarrassed", "embarrassing", "ashamed", "awkward"],
    "excitement": ["excited", "exciting", "thrilled", "hyped"],
    "fear": ["afraid", "scared", "fear", "terrified"],
    "gratitude": ["thanks", "thank", "grateful", "appreciate"],
    "grief": ["grief", "mourning", "loss", "died"],
    "joy": ["happy", "joy", "glad", "delighted"],
    "love": ["love", "loved", "adore", "beloved"],
    "nervousness": ["nervous", "anxious", "worried", "uneasy"],
    "optimism": ["hope", "hopeful", "optimistic", "promising"],
    "pride": ["proud", "pride", "achievement", "accomplished"],
    "realization": ["realize", "realized", "turns", "apparently"],
    "relief": ["relief", "relieved", "finally", "phew"],
    "remorse": ["sorry", "regret", "apologize", "guilty"],
    "sadness": ["sad", "unhappy", "depressed", "miserable"],
    "surprise": ["surprised", "surprising", "unexpected", "wow"],
}


def sentiment_of(emotion):
    """Positive / Negative / Neutral of an emotion; unknown ones are Neutral."""
    mapping = F.create_map(
        *[F.lit(x) for pair in K.EMOTION_SENTIMENT.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, F.lower(emotion)), F.lit("Neutral"))


def emotion_display_name(emotion):
    """The label with a capital; a label outside the classifier's set gives null."""
    label = F.lower(emotion)
    return F.when(label.isin(K.EMOTIONS), F.initcap(label))


def with_sentiment(df, text, cues=None):
    """Add sentiment_label, sentiment_score and emotion by the cue-word rule.

    The emotion is the one with most cue hits in the truncated text, the score
    its share of all hits; no hit is (neutral, 0.0). Ties go to the emotion that
    comes first in the alphabet. Blank text is (Neutral, 0.0, No content).

    The hits are a column of their own, so the text is searched once per row.
    """
    cues = DEFAULT_CUES if cues is None else cues
    by_word = {w.lower(): e for e, ws in cues.items() for w in ws}
    emotion_of = F.create_map(*[F.lit(x) for pair in by_word.items() for x in pair])
    pattern = F.lit("(" + words_regex(list(by_word)) + ")")
    found = F.regexp_extract_all(F.lower(truncate_sentences(text)), pattern, 1)
    hits = F.col("__hits")
    counted = F.transform(
        F.array_sort(F.array_distinct(hits)),
        lambda e: F.struct(F.size(F.filter(hits, lambda h: h == e)).alias("n"), e.alias("emotion")))
    best = F.reduce(
        counted,
        F.struct(F.lit(0).alias("n"), F.lit("neutral").alias("emotion")),
        lambda acc, x: F.when(x["n"] > acc["n"], x).otherwise(acc))
    share = F.when(F.size(hits) > 0, F.col("__best.n") / F.size(hits)).otherwise(F.lit(0.0))
    blank = is_blank(text)
    added = ["sentiment_label", "sentiment_score", "emotion"]
    return (
        df.withColumn("__hits", F.transform(found, lambda w: F.element_at(emotion_of, w)))
        .withColumn("__best", best)
        .withColumns(dict(zip(added, [
            F.when(blank, "Neutral").otherwise(sentiment_of(F.col("__best.emotion"))),
            F.when(blank, 0.0).otherwise(share),
            F.when(blank, "No content").otherwise(F.col("__best.emotion")),
        ])))
        .select(*df.columns, *added)
    )
