"""Column expressions on text. All stay in the JVM; none needs a Python worker."""

import re

from pyspark.sql import functions as F

from threadglean import constants as K

# Python's str.split()/strip() white space, in Java regex terms.
_SPACE = r"[\s\x1c-\x1f]"
_NON_SPACE = r"[^\s\x1c-\x1f]"
_WORD = r"[\p{L}\p{M}\p{Nd}_]"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


# --- masking ------------------------------------------------------------------

def _trie_regex(words):
    """One pattern for many words with shared prefixes, so that a text position
    is tested once per letter and not once per word."""
    root = {}
    for word in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}

    def render(node):
        branches = [re.escape(ch) + render(child)
                    for ch, child in sorted(node.items()) if ch]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        if "" in node:
            body = "(?:" + body + ")?"
        return body

    return render(root)


def words_regex(words):
    """Pattern for any of `words` as a whole word, the longest one first.

    The word boundary is spelled out, so it treats accented letters as letters
    on every Java version.
    """
    words = sorted({w.lower() if w.isascii() else w for w in words if w})
    groups = {}
    for word in words:
        edge = tuple(bool(re.match(r"\w", ch)) for ch in (word[0], word[-1]))
        groups.setdefault(edge, []).append(word)
    parts = []
    for (starts, ends), members in sorted(groups.items(), reverse=True):
        before = f"(?<!{_WORD})" if starts else f"(?<={_WORD})"
        after = f"(?!{_WORD})" if ends else f"(?={_WORD})"
        parts.append(f"{before}(?:{_trie_regex(members)}){after}")
    return "|".join(parts)


def mask_pattern(lexicon=()):
    """Pattern of everything to mask: the lexicon and the fixed extra words,
    without the fixed false positives, then the obfuscated spellings.

    A look at the next character alone rules out most positions of a text
    before any alternative is tried.
    """
    never = set(K.NEVER_MASKED_WORDS)
    words = [w for w in [*lexicon, *K.EXTRA_MASKED_WORDS] if w and w.lower() not in never]
    # The pattern ignores case for ASCII only: other letters stand in the class as given.
    first = {form for w in words for form in ({w[0].lower()} if w[0].isascii() else {w[0]})}
    first |= set(K.OBFUSCATION_FIRST_LETTERS)
    ahead = "(?=[" + "".join(re.escape(ch) for ch in sorted(first)) + "])"
    return f"(?i){ahead}(?:" + "|".join([words_regex(words), *K.OBFUSCATION_PATTERNS]) + ")"


def mask_words(text, pattern):
    return F.regexp_replace(_col(text), F.lit(pattern), F.lit(K.MASK))


def strip_control_chars(text):
    return F.regexp_replace(_col(text), r"[\n\r\t]", "")


# --- lengths and blanks ---------------------------------------------------------

def word_count(text):
    return F.regexp_count(_col(text), F.lit(f"(?U){_NON_SPACE}+"))


def has_more_words(text, limit=K.SHORT_TEXT_MAX_WORDS):
    """Whether there are more than `limit` words; reads no further than that."""
    return _col(text).rlike(
        rf"(?U)\A{_SPACE}*+(?:{_NON_SPACE}++{_SPACE}++){{{limit}}}{_NON_SPACE}")


def is_blank(text):
    text = _col(text)
    return text.isNull() | text.rlike(rf"(?U)\A{_SPACE}*\z")


def comment_quality(body):
    """Too short / Too long / Valid; a null length falls to Valid."""
    size = F.length(_col(body))
    return (
        F.when(size < K.MIN_BODY_CHARS, "Too short")
        .when(size > K.MAX_BODY_CHARS, "Too long")
        .otherwise("Valid")
    )


def summary_quality(summary, body):
    """Missing / Invalid / Valid; only spaces count as blank."""
    summary, body = _col(summary), _col(body)
    return (
        F.when(summary.isNull() | (F.trim(summary) == ""), "Missing")
        .when(F.length(summary) > F.length(body), "Invalid")
        .otherwise("Valid")
    )


# --- truncation and default summary ----------------------------------------------

def _through_last_stop(text):
    return F.regexp_extract(text, r"(?s)^(.*[.?!])", 1)


def truncate_sentences(text, max_chars=K.CLASSIFIER_MAX_CHARS):
    """At most `max_chars`, cut after the last sentence end; without one, cut at
    the last space (or hard) and marked with three dots."""
    text = _col(text)
    head = F.substring(text, 1, max_chars)
    stop = _through_last_stop(head)
    hard = F.concat(F.regexp_replace(head, r"(?s)\A(.*) [^ ]*\z", "$1"), F.lit("..."))
    return (
        F.when(F.length(text) <= max_chars, text)
        .when(stop != "", stop)
        .otherwise(hard)
    )


def lead_summary(text, max_words=K.SUMMARY_MAX_TOKENS, min_words=K.SUMMARY_MIN_TOKENS):
    """The first `max_words` words, ended at the last sentence end if that still
    leaves `min_words`. The built-in stand-in for a summarisation model."""
    text = _col(text)
    lead = F.regexp_extract(
        text,
        rf"(?U)\A{_SPACE}*((?:{_NON_SPACE}++{_SPACE}++){{0,{max_words - 1}}}{_NON_SPACE}++)",
        1,
    )
    ended = _through_last_stop(lead)
    return F.when(word_count(ended) >= min_words, ended).otherwise(lead)


def summarize_text(text, model_summary=None):
    """Empty text gives '', up to 59 words are copied, the rest is summarised."""
    text = _col(text)
    summary = lead_summary(text) if model_summary is None else model_summary
    return (
        F.when(text.isNull() | (text == ""), F.lit(""))
        .when(~has_more_words(text), text)
        .otherwise(F.coalesce(summary, F.lit("")))
    )


# --- Markdown ---------------------------------------------------------------------

def title_tags(title):
    """All `[X]` tags of a title, in order."""
    return F.regexp_extract_all(_col(title), F.lit(r"\[([^\]]+)\]"), 1)


def markdown_link(title, url):
    """`[Title](url)`, tags kept where they are; nulls print as empty."""
    return F.concat(
        F.lit("["), F.coalesce(_col(title), F.lit("")), F.lit("]("),
        F.coalesce(_col(url), F.lit("")), F.lit(")"))


def display_name(community):
    """Printed name of a community; an unknown one prints as it is."""
    community = _col(community)
    name = community
    for key, shown in K.COMMUNITY_DISPLAY_NAMES.items():
        name = F.when(F.lower(community) == key, F.lit(shown)).otherwise(name)
    return F.concat(name, F.lit(K.COMMUNITY_DISPLAY_SUFFIX))


def retitle(text, community):
    """Report text whose title line names the community as displayed."""
    name = _col(community)
    plain = F.concat(F.lit('title: "'), name, F.lit(' subreddit"'))
    return F.replace(_col(text), plain, F.concat(F.lit('title: "'), display_name(name), F.lit('"')))


def right_strip(text):
    return F.regexp_replace(_col(text), rf"(?U){_SPACE}+\z", "")


def clean_line(line):
    """One Markdown line without triple backticks and trailing white space."""
    return right_strip(F.replace(_col(line), F.lit("```"), F.lit("")))


def keeps_line(line):
    """False for a line that only becomes empty through cleaning."""
    return (clean_line(line) != "") | is_blank(line)


def clean_markdown(text):
    """`clean_line` over a whole document; every kept line ends in a newline."""
    text = F.regexp_replace(_col(text), r"\r\n?", "\n")
    lines = F.split(text, "\n")
    unended = F.when(text.endswith("\n") | (text == ""), 1).otherwise(0)
    lines = F.slice(lines, F.lit(1), F.size(lines) - unended)
    kept = F.filter(lines, keeps_line)
    return F.array_join(F.transform(kept, lambda x: F.concat(clean_line(x), F.lit("\n"))), "")


# --- text blocks ---------------------------------------------------------------------

def text_block(fields=tuple(K.BLOCK_FIELDS)):
    """`~~~` and one `name: value` line per field; a null prints as None."""
    indent = "\n    "
    parts = [F.lit(K.BLOCK_PREFIX)]
    for name in fields:
        parts += [F.lit(f"{indent}{name}: "),
                  F.coalesce(F.col(name).cast("string"), F.lit("None"))]
    return F.concat(*parts, F.lit(indent))
