"""Text expressions. Patterns use only syntax that Java and RE2 read alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns, tried in this order.
WORD = r"[\p{L}\p{N}_]"
EMOTICON = r"[:=;][oO\-]?[D\)\]\(/\\OpP]"
URL = r"https?://(?:[a-z]|[0-9]|[$-_@.&;+]|[!*(),]|%[0-9a-f][0-9a-f])+"
MENTION = r"@[\p{L}\p{N}_]+"
HASHTAG = r"#+[\p{L}\p{N}_]+[\p{L}\p{N}_'\-]*[\p{L}\p{N}_]+"
TOKEN = "(?i)(?:" + "|".join([
    EMOTICON,
    r"<[^>]+>",
    MENTION,
    HASHTAG,
    URL,
    r"(?:\p{Nd}+,?)+(?:\.?\p{Nd}+)?",
    r"[a-z][a-z'\-_]+[a-z]",
    r"[\p{L}\p{N}_]+",
    r"[^\s\x0B\p{Z}]",
]) + ")"
LINK = "(?i)" + URL
CURRENCY = r"\p{Sc}"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{1F1E6}-\x{1F1FF}\x{2600}-\x{27BF}\x{2B50}\x{2B55}\x{231A}\x{231B}\x{23E9}-\x{23F3}]"

# Common English words left out of descriptions.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()


def to_list(text: Column) -> Column:
    return F.split(text, ",")


def to_int(text: Column) -> Column:
    return text.try_cast("long")


def to_float(text: Column) -> Column:
    return text.try_cast("double")


def to_bool(text: Column, strict: bool = True) -> Column:
    """true/false text as boolean; other text raises, or is null when not strict."""
    low = F.lower(text)
    other = F.raise_error(F.concat(F.lit("not a boolean: "), text)) if strict else F.lit(None)
    return F.when(text.isNull(), F.lit(None)).when(low == "true", True).when(low == "false", False).otherwise(other.cast("boolean"))


def normal_name(name: Column) -> Column:
    """Lower-case package or category name with joined words."""
    out = F.lower(name)
    for old, new in (("&amp;", "and"), (" ", "_"), ("_y_", "_and_"), ("_e_", "_and_")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def keyword_flags(text: Column, words: Sequence[str]) -> dict[str, Column]:
    low = F.lower(text)
    return {w + "_related": low.contains(w).cast("int") for w in words}


def without_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]", "")


def has_any_com(text: Column) -> Column:
    """1 when any character is followed by ``com``; the dot is a wildcard, case is ignored."""
    return text.rlike("(?i).com").cast("int")


def email_domain(address: Column) -> Column:
    return F.split_part(address, F.lit("@"), F.lit(2))


def tokens(text: Column, lowercase: bool = False) -> Column:
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    if not lowercase:
        return found
    return F.transform(found, lambda t: F.when(t.rlike("^(?i)" + EMOTICON + "$"), t).otherwise(F.lower(t)))


def short_text_features(text: Column) -> dict[str, Column]:
    """Length, link, tag, mention, currency, punctuation and emoji features."""
    return {
        "tweet_length": F.length(text),
        "got_link": text.rlike(LINK).cast("int"),
        "num_of_hashtags": F.regexp_count(text, F.lit(HASHTAG)),
        "num_of_user_tags": F.regexp_count(text, F.lit(MENTION)),
        "got_money_sign": text.rlike(CURRENCY).cast("int"),
        "exclamation_mark_count": F.regexp_count(text, F.lit("!")),
        "question_mark_count": F.regexp_count(text, F.lit(r"\?")),
        "num_of_emojis": F.regexp_count(text, F.lit(EMOJI)),
    }


def clean_description(text: Column) -> Column:
    """Lower case, no stop words, letters only, single blanks. Stop words leave first."""
    words = F.split(F.lower(text), r"\s+")
    kept = F.filter(words, lambda w: ~w.isin(*STOP_WORDS))
    letters = F.regexp_replace(F.array_join(kept, " "), "[^a-z]+", " ")
    return F.trim(letters)
